"""Sharding by fixed virtual slots.

Records are hashed into a fixed number of virtual slots. Rows and bytes are
aggregated per slot, and a slot-to-shard map, not the hash, places the slots.
The map is a small versioned table: version 1 deals the slots round robin, a
rebalancing edits it by the slots' bytes, growing by one shard moves slots
only into the new shard. All steps are DataFrame expressions; the map and the
slot totals have one row per virtual slot whatever the data are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from quarry.session import ensure_checkpoint_dir

SLOTS = 4096


def with_slots(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot per row of docs (doc_id, text).

    The slot is a hash of doc_id; rows without a doc_id are spread by a hash
    of their text. A null text has no bytes and checksum 0.
    """
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(F.coalesce(F.xxhash64("doc_id") if docs.schema["doc_id"].nullable is False else
                          F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")), F.xxhash64(text)), F.lit(slots))
        .cast("int").alias("virtual_slot"))


def slot_totals(slotted: DataFrame) -> DataFrame:
    """virtual_slot, rows, bytes."""
    return slotted.groupBy("virtual_slot").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 1: virtual_slot, shard, version; slots are dealt round robin."""
    return spark.range(slots).select(F.col("id").cast("int").alias("virtual_slot"),
                                     (F.col("id") % shards).cast("int").alias("shard"), F.lit(1).alias("version"))


def rebalanced(slot_map: DataFrame, totals: DataFrame, shards: int) -> DataFrame:
    """The next version of the map, with bytes near equal: slots in falling
    order of bytes go to the shard that has least so far (the lowest shard of
    a tie). Slots without rows keep their shard."""
    known = slot_map.join(F.broadcast(totals), "virtual_slot", "left").withColumn("bytes", F.coalesce("bytes", F.lit(0)))
    order = F.sort_array(F.collect_list(F.when(F.col("bytes") > 0, F.struct((-F.col("bytes")).alias("minus"), "virtual_slot"))))
    start = F.struct(F.array_repeat(F.lit(0).cast("long"), shards).alias("loads"),
                     F.array().cast("array<struct<virtual_slot:int,shard:int>>").alias("placed"))

    def place(state, slot):
        least = (F.array_position(state["loads"], F.array_min(state["loads"])) - 1).cast("int")
        loads = F.transform(state["loads"], lambda load, i: F.when(i == least, load - slot["minus"]).otherwise(load))
        return F.struct(loads.alias("loads"), F.concat(state["placed"], F.array(F.struct(
            slot["virtual_slot"].alias("virtual_slot"), least.alias("shard")))).alias("placed"))

    placed = known.agg(order.alias("order")).select(F.explode(F.aggregate("order", start, place)["placed"]).alias("p")) \
        .select("p.virtual_slot", F.col("p.shard").alias("new_shard"))
    return slot_map.join(F.broadcast(placed), "virtual_slot", "left").select(
        "virtual_slot", F.coalesce("new_shard", "shard").alias("shard"), (F.col("version") + 1).alias("version"))


def grown(slot_map: DataFrame, shards: int) -> DataFrame:
    """The next version for one more shard: every shard gives the new one its
    share of slots (lowest slots first); no slot moves between old shards."""
    place = F.row_number().over(W.Window.partitionBy("shard").orderBy("virtual_slot"))
    have = F.count("*").over(W.Window.partitionBy("shard"))
    return slot_map.withColumn("moves", place <= F.floor(have / (shards + 1) + F.lit(0.5))).select(
        "virtual_slot", F.when(F.col("moves"), shards).otherwise(F.col("shard")).cast("int").alias("shard"),
        (F.col("version") + 1).alias("version"))


def save_map(slot_map: DataFrame, path: str) -> None:
    """Add the map's version to the table at ``path`` (one folder per version; a version is written once)."""
    slot_map.coalesce(1).write.partitionBy("version").mode("append").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A stored version of the map (the latest if none is named)."""
    stored = spark.read.parquet(path).select("virtual_slot", "shard", F.col("version").cast("int").alias("version"))
    latest = version if version is not None else stored.agg(F.max("version")).first()[0]
    return stored.where(F.col("version") == F.lit(latest))


def assign(docs: DataFrame, shards: int, path: str, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot, version per row of docs.

    The law is ``bytes``: version 1 of the map is stored under ``path`` (a
    new folder), edited by the slots' bytes and stored as version 2, by which
    the rows are placed, so shard sizes are near equal. ``slot`` numbers the
    rows of a shard without gaps from 0: rows are numbered within their
    virtual slot and shifted by the rows of the shard's earlier slots, so no
    task holds a shard. grown_shard is null (it belongs to the law ``key``).
    Rows with equal doc_id share a virtual slot; repeated rows each get a slot
    of their own; other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    slotted = with_slots(docs, slots)
    totals = slot_totals(slotted).checkpoint()
    save_map(first_map(spark, shards, slots), path)
    save_map(rebalanced(load_map(spark, path), totals, shards), path)
    placed = load_map(spark, path).join(F.broadcast(totals), "virtual_slot").select(
        "virtual_slot", "shard", "version",
        (F.sum("rows").over(W.Window.partitionBy("shard").orderBy("virtual_slot")) - F.col("rows")).alias("before"))
    within = F.row_number().over(W.Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    return slotted.withColumn("within", within).join(F.broadcast(placed), "virtual_slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("before") + F.col("within") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot", "version")
