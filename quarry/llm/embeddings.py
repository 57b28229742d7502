"""Embedding near-dedup by sorted projection passes.

In each pass every vector gets a key of concatenated random hashes (signs of
random projections) and the vectors are ordered lexicographically by label
and key. The order is cut into blocks of ``BLOCK`` vectors, and each block is
compared with itself and the block before it: the bounded neighbour window.
Where a run of equal leading hashes spans more blocks than that, its further
pairs of blocks are compared too, each as a task of its own, so dense regions
lose nothing to the window. Passes are repeated until a pair at the threshold
shares its leading hashes in at least one of them with probability
``recall``; their number follows from the size of the largest label.

No pairs are written: a pair counts in the first pass in which it meets (each
vector carries its places in all passes), tasks return the number of links of
each vector and the links of a spanning forest, and components are united
across passes. Equal vectors of a label are one class from the start.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.components import connected_components
from quarry.llm.tokens import bounds
from quarry.session import ensure_checkpoint_dir

BLOCK = 256
KEY_BITS = 31


def passes_for(largest: int, threshold: float, recall: float) -> tuple[int, int]:
    """(leading hashes of a run, passes) for a label of ``largest`` vectors:
    runs of evenly spread vectors about fill a block."""
    bits = min(KEY_BITS, max(4, math.ceil(math.log2(max(1, largest) / BLOCK)) if largest > BLOCK else 4))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - meet)))


def unit_rows(rows: list) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors in double precision of rows of one length, and which rows
    have one (finite, not zero); the others are zeros."""
    x = np.array(rows, dtype=np.float64)
    good = np.isfinite(x).all(axis=1) if x.size else np.zeros(len(x), bool)
    x[~good] = 0
    scale = np.abs(x).max(axis=1, initial=0)
    good &= scale > 0
    x = x / np.where(scale > 0, scale, 1)[:, None]  # no overflow in the squares
    norm = np.sqrt((x * x).sum(axis=1))
    return x / np.where(norm > 0, norm, 1)[:, None], good


def _keys(passes: int, seed: int):
    def keys(batches):
        planes: dict = {}
        weights = 1 << np.arange(KEY_BITS - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            vectors, ids, labels = (batch.column(c) for c in ("embedding", "cls", "label"))
            size = np.diff(vectors.offsets.to_numpy())
            for dim in np.unique(size):
                rows = np.flatnonzero(size == dim)
                x, good = unit_rows([v for v in vectors.take(pa.array(rows)).to_pylist()])
                rows, x = rows[good], x[good]
                if not len(rows):
                    continue
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, int(dim)]).standard_normal((int(dim), passes * KEY_BITS))
                bits = ((x @ planes[dim]) > 0).reshape(len(rows), passes, KEY_BITS)
                value = (bits * weights).sum(axis=2)
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(np.repeat(rows, passes))), labels.take(pa.array(np.repeat(rows, passes))),
                    pa.array(np.full(len(rows) * passes, dim, dtype=np.int32)),
                    pa.array(np.tile(np.arange(passes, dtype=np.int32), len(rows))), pa.array(value.ravel())],
                    names=["cls", "label", "dim", "pass", "key"])
    return keys


def _place(batches):
    """Numbers the rows of a sorted partition: its number and the block within it."""
    part, done = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        block = (done + np.arange(n)) // BLOCK
        done += n
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, dtype=np.int32)), pa.array(block)],
                                         names=[*batch.schema.names, "part", "local"])


def _compare(threshold: float, bits: int):
    """One task of a pass: side 1 is the block, side 0 what it meets. A whole
    block also meets itself; a far task compares rows of one run only."""
    def compare(key, table):
        this, low, high = (k.as_py() for k in key)
        ids, members = table.column("cls").to_numpy(), table.column("members").to_numpy()
        label, side = table.column("label").to_numpy(zero_copy_only=False), table.column("side").to_numpy()
        vectors = table.column("embedding").to_pylist()
        blocks = np.array(table.column("blocks").to_pylist(), dtype=np.int64)
        run = np.array(table.column("keys").to_pylist(), dtype=np.int64) >> (KEY_BITS - bits)
        size = np.array([len(v) for v in vectors])
        found_a, found_b = [], []
        for dim in np.unique(size):
            own, other = np.flatnonzero((size == dim) & (side == 1)), np.flatnonzero(size == dim)
            if low != high:
                other = other[side[other] == 0]
            if not len(own) or not len(other):
                continue
            x, _ = unit_rows([vectors[i] for i in own])
            y, _ = unit_rows([vectors[i] for i in other])
            i, j = np.nonzero(x @ y.T >= threshold)
            a, b = own[i], other[j]
            # a pair within the block comes in both orders
            keep = (label[a] == label[b]) & ((side[b] == 0) | (a < b))
            if low != high:
                keep &= run[a, this] == run[b, this]
            a, b = a[keep], b[keep]
            met = (np.abs(blocks[a, :this] - blocks[b, :this]) <= 1) | (run[a, :this] == run[b, :this])
            first = ~met.any(axis=1)
            found_a.append(a[first])
            found_b.append(b[first])
        a = np.concatenate(found_a) if found_a else np.zeros(0, np.int64)
        b = np.concatenate(found_b) if found_b else np.zeros(0, np.int64)
        links = np.bincount(a, members[b], len(ids)) + np.bincount(b, members[a], len(ids))
        some = np.flatnonzero(links)
        parent = np.arange(len(ids))

        def find(v):
            while parent[v] != v:
                parent[v] = parent[parent[v]]
                v = parent[v]
            return v

        tree = []
        for k, (v, w) in enumerate(zip(a.tolist(), b.tolist())):
            v, w = find(v), find(w)
            if v != w:
                parent[v] = w
                tree.append(k)
        nothing = pa.nulls(len(some), pa.int64())
        return pa.table({
            "cls": pa.concat_arrays([pa.array(ids[some], pa.int64()), pa.array(ids[a[tree]], pa.int64())]),
            "to": pa.concat_arrays([nothing, pa.array(ids[b[tree]], pa.int64())]),
            "links": pa.concat_arrays([pa.array(links[some].astype(np.int64)), pa.array(np.zeros(len(tree), np.int64))])})
    return compare


def near_duplicate_vectors(vectors: DataFrame, threshold: float = 0.93, recall: float = 0.9999, seed: int = 3) -> DataFrame:
    """vec_id, n_links, component_id, kept per row of ``vectors`` (vec_id, embedding, label).

    Two rows are linked if their labels are equal and not null, their vectors
    have one length, and the cosine in double precision is at least
    ``threshold``; no pair below it is linked, and a pair at it is found with
    probability ``recall`` (closer pairs with more). n_links counts linked
    rows other than the row itself, component_id is the smallest vec_id
    reachable. Vectors that are null, empty, zero, or hold null or non-finite
    components link with nothing, whatever their copies. Rows that repeat a
    vec_id are judged by their own vectors; a row with a null vec_id takes
    part, isn't kept and names no component. Other columns are ignored; an
    empty table gives no rows.
    """
    spark = vectors.sparkSession
    ensure_checkpoint_dir(spark)
    vectors = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label")
    classes = (vectors.where("label is not null and embedding is not null and size(embedding) > 0 and not exists(embedding, x -> x is null)")
               .groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("members"))
               .withColumn("cls", F.monotonically_increasing_id()).checkpoint())
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, passes = passes_for(largest, threshold, recall)

    # the sort of all passes at once; labels and dimensions never mix in a run
    keyed = classes.select("cls", "label", "embedding").mapInArrow(
        _keys(passes, seed), f"cls long, label {classes.schema['label'].dataType.simpleString()}, dim int, pass int, key long").checkpoint()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["pass", "label", "dim", "key", "cls"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema) + ", part int, local long"
    placed = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_place, schema).checkpoint()
    ends = {r["part"]: r["last"] + 1 for r in placed.groupBy("part").agg(F.max("local").alias("last")).collect()}
    base = bounds(np.array([ends.get(p, 0) for p in range(max(ends, default=-1) + 1)], dtype=np.int64)).tolist()
    bases = F.broadcast(spark.createDataFrame([(p, b) for p, b in enumerate(base)], "part int, base long"))  # a row per partition
    placed = placed.join(bases, "part").select("cls", "label", "dim", "pass", "key", (F.col("base") + F.col("local")).alias("block"))

    run = ["pass", "label", "dim", F.shiftright("key", KEY_BITS - bits).alias("run")]
    placed = placed.select("cls", "key", "block", *run).checkpoint()
    spans = placed.groupBy("pass", "label", "dim", "run").agg(F.min("block").alias("from"), F.max("block").alias("to")) \
        .where(F.col("to") - F.col("from") > 1).checkpoint()
    tasks = placed.join(spans, ["pass", "label", "dim", "run"], "left").select(
        "cls", "pass", F.explode(F.concat(
            F.array(F.struct(F.col("block").alias("low"), F.col("block").alias("high"), F.lit(1).alias("side")),
                    F.struct((F.col("block") + 1).alias("low"), (F.col("block") + 1).alias("high"), F.lit(0).alias("side"))),
            F.when(F.col("to").isNotNull(), F.transform(
                F.filter(F.sequence("from", "to"), lambda k: F.abs(k - F.col("block")) > 1),
                lambda k: F.struct(F.least("block", k).alias("low"), F.greatest("block", k).alias("high"),
                                   F.when(k > F.col("block"), 1).otherwise(0).alias("side"))))
            .otherwise(F.array().cast("array<struct<low:bigint,high:bigint,side:int>>")))).alias("t")).select("cls", "pass", "t.*")
    places = placed.groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("pass", "block", "key"))).alias("p")) \
        .select("cls", F.col("p.block").alias("blocks"), F.col("p.key").alias("keys"))
    carried = classes.join(places, "cls").checkpoint()
    found = tasks.join(carried.drop("rep"), "cls").groupBy("pass", "low", "high").applyInArrow(
        _compare(threshold, bits), "cls long, to long, links long").checkpoint()

    links = found.where("to is null").groupBy("cls").agg(F.sum("links").alias("links"))
    rooted = connected_components(found.where("to is not null").select(F.col("cls").alias("a"), F.col("to").alias("b")))
    named = carried.select("cls", "label", "embedding", "rep", "members") \
        .join(links, "cls", "left").join(rooted.withColumnRenamed("id", "cls"), "cls", "left") \
        .withColumn("component", F.coalesce("component", "cls")).checkpoint()
    least = named.groupBy("component").agg(F.min("rep").alias("component_id")).checkpoint()
    judged = named.join(least, "component").select(
        "label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("n_links"), "component_id").checkpoint()
    out = vectors.join(judged, ["label", "embedding"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
