"""The registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm.alignment import align, load_pair
from quarry.llm.bpe import round_trip
from quarry.llm.decontam import contamination
from quarry.llm.embeddings import near_duplicate_vectors
from quarry.llm.html import main_text
from quarry.llm.langid import identify, train
from quarry.llm.lm import score_by_quality
from quarry.llm.minhash import near_duplicates
from quarry.llm.prefixes import prefix_trie
from quarry.llm.quality import score_quality, train as train_quality
from quarry.llm.sharding import assign
from quarry.llm.sql import OP3, OP7, OP9, OP10, OP12
from quarry.llm.substring import repeated_passages
from quarry.llm.urls import Rule, filter_urls
from quarry.session import scratch_path

# The rules of op9.
URL_RULES = [Rule("org/", "allow"), Rule("example.org/es/", "block"), Rule("example.org/en/1", "block"),
             Rule("com/fr/", "allow"), Rule("com/de/", "block")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(_table(spark, sf_dir, "documents"))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(_table(spark, sf_dir, "embeddings"), 0.93)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(_table(spark, sf_dir, "documents"), 24, scratch_path(spark, "slot-map"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return identify(docs, train(docs))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_by_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), percent=85)


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(_table(spark, sf_dir, "pages"))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    pair = load_pair(spark, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN)
    return align(_table(spark, sf_dir, "documents"), pair)


def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(_table(spark, sf_dir, "conversations"))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return score_quality(docs, train_quality(docs, _table(spark, sf_dir, "labels")))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_embedding_near_dedup": op3_embedding_near_dedup,
    "op4_sharding": op4_sharding,
    "op5_language_id": op5_language_id,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_html_extraction": op8_html_extraction,
    "op9_url_filters": op9_url_filters,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_cross_tokenizer_alignment": op11_cross_tokenizer_alignment,
    "op12_conversation_prefix_trie": op12_conversation_prefix_trie,
    "op13_quality_classifier": op13_quality_classifier,
}

#: The others train a model, hash into slots or use a tokenizer: they are tested by brute force.
SQL = {
    "op3_embedding_near_dedup": OP3,
    "op7_minhash_near_dedup": OP7,
    "op9_url_filters": OP9,
    "op10_benchmark_decontamination": OP10,
    "op12_conversation_prefix_trie": OP12,
}
