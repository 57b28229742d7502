"""The corpus pipeline: stages applied one after another to ``documents``.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` and is written as Parquet
to the shared checkpoint folder and read again as the next one's ``docs``.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.bpe import decode, encode, load_ranks
from quarry.llm.decontam import drop_contaminated
from quarry.llm.langid import keep_identified, train
from quarry.llm.minhash import near_duplicates
from quarry.llm.shipping import written
from quarry.llm.substring import remove_passages, repeated_passages
from quarry.operators.relational import with_global_position
from quarry.session import ensure_checkpoint_dir, scratch_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go. The network learns from the
    labelled part of what the stage is given."""
    return keep_identified(docs, train(docs))


def with_row_ids(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows of docs that have a doc_id, once each, and the name of a new
    column that tells them apart: the doc_id, but where rows with different texts
    share one, only one of them keeps it and the others get numbers beyond all."""
    name = next(n for n in (f"row_id_{i}" for i in range(len(docs.columns) + 1)) if n not in {c.lower() for c in docs.columns})
    ensure_checkpoint_dir(docs.sparkSession)
    named = docs.where("doc_id is not null")
    again = named.groupBy("doc_id").count().where("count > 1").select("doc_id").checkpoint()
    if not again.head(1):
        return named.withColumn(name, F.col("doc_id").cast("long")), name
    single = named.join(again, "doc_id", "left_anti").withColumn(name, F.col("doc_id").cast("long"))
    several = named.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).withColumn("text_hash", F.xxhash64("text"))
    texts = several.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).distinct().checkpoint()
    least = texts.groupBy("id").agg(F.min("hash").alias("hash"))
    top = named.agg(F.max("doc_id")).first()[0]
    others = with_global_position(texts.join(least, ["id", "hash"], "left_anti"), [F.col("id"), F.col("hash")], "place")
    numbers = least.select("id", "hash", F.col("id").cast("long").alias(name)).unionByName(
        others.select("id", "hash", (F.col("place") + top).cast("long").alias(name)))
    several = several.join(numbers, (F.col("doc_id") == F.col("id")) & (F.col("text_hash") == F.col("hash"))).select(*docs.columns, name)
    return single.select(*docs.columns, name).unionByName(several), name


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the
    smallest doc_id (once, if its row is repeated). Rows that share a doc_id but
    not the text are documents of their own. Rows without a doc_id stay."""
    rows, name = with_row_ids(docs)
    found = near_duplicates(rows.select(F.col(name).alias("doc_id"), "text"), percent=80)
    gone = found.where("not kept").select(F.col("doc_id").alias(name)).distinct()
    return rows.join(gone, name, "left_anti").select(docs.columns).unionByName(docs.where("doc_id is null"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that repeat an earlier document's are cut
    out. Rows without a doc_id stay as they are; repeated rows stay once."""
    rows, name = with_row_ids(docs)
    cut = remove_passages(rows, repeated_passages(rows.select(F.col(name).alias("doc_id"), "text")), on=name).select(docs.columns)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.unionByName(docs.where("doc_id is null"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover 5 % of the words or more go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers) and the
    digests of ids and of the bytes they decode to."""
    ranks = load_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    # in one task with the encoder, the decoder would take a second Python worker for each core; Spark keeps
    # them all at work from then on, and an executor holds the memory of twice as many
    return decode(written(encode(docs, ranks), "bpe-ids"), ranks).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), "ids")


STAGES = [
    ("language_id", language_id),
    ("minhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_encoding", bpe_encoding),
]

#: A trained network, signatures and a tokenizer are not SQL; each stage is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
