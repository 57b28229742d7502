"""Queries for types found in raw text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import text_types as T
from quarry.plans.registry import query
from quarry.plans.standins import table
from quarry.session import session_path
from quarry.sources import sinks as SK

# (column, its raw text in SQL): o_code holds words, numbers with a letter and nulls, o_when dates and times
_RAW_SQL = """(SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_orderkey * 4000000000 AS VARCHAR) AS o_wide, o_orderstatus,
  CAST(o_totalprice AS VARCHAR) AS o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
  CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS o_when,
  CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) ELSE CAST(o_totalprice AS VARCHAR) END AS o_mixed,
  CASE WHEN o_orderkey % 5 = 0 THEN 'n/a' WHEN o_orderkey % 7 = 0 THEN concat(o_custkey, 'x') WHEN o_orderkey % 11 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS o_code,
  CAST(o_orderkey % 2 = 0 AS VARCHAR) AS o_even, concat(o_custkey, 'e', o_orderkey % 4) AS o_float FROM orders)"""
# The types of the raw columns, in order.
_RAW_TYPES = [("o_orderkey", "int"), ("o_wide", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "decimal"), ("o_orderdate", "date"),
              ("o_when", "timestamp_ntz"), ("o_mixed", "decimal"), ("o_code", "string"), ("o_even", "boolean"), ("o_float", "double")]


def _class_sql(c: str) -> str:
    return f"""CASE WHEN {c} IS NULL THEN 'null' WHEN lower({c}) IN ('true', 'false') THEN 'boolean'
  WHEN regexp_full_match({c}, '[+-]?[0-9]+') AND TRY_CAST({c} AS INTEGER) IS NOT NULL THEN 'int'
  WHEN regexp_full_match({c}, '[+-]?[0-9]+') AND TRY_CAST({c} AS BIGINT) IS NOT NULL THEN 'long'
  WHEN NOT contains(lower({c}), 'e') AND TRY_CAST({c} AS DECIMAL(38, 10)) IS NOT NULL THEN 'decimal'
  WHEN TRY_CAST({c} AS DOUBLE) IS NOT NULL THEN 'double'
  WHEN length({c}) = 10 AND TRY_CAST({c} AS DATE) IS NOT NULL THEN 'date'
  WHEN TRY_CAST({c} AS TIMESTAMP) IS NOT NULL THEN 'timestamp' ELSE 'text' END"""


def _counts_sql(c: str, i: int, kind: str) -> str:
    counts = ", ".join(f"count(*) FILTER (k = '{k}') AS {k}_rows" for k in T.CLASSES)
    parts = f"regexp_extract({c}, '^[+-]?([0-9]*)[.]?([0-9]*)$', "
    digits = ", ".join(f"CAST(max(CASE WHEN k IN ('int', 'long', 'decimal') THEN length({parts}{g})) END) AS INTEGER) AS {n}_digits"
                       for g, n in ((1, "whole"), (2, "part")))
    named = "concat('decimal(', whole_digits + part_digits, ',', part_digits, ')')" if kind == "decimal" else f"'{kind}'"
    return (f"SELECT *, {named} AS data_type FROM (SELECT '{c}' AS column_name, CAST({i} AS INTEGER) AS ordinal, {counts}, {digits} "
            f"FROM (SELECT {c}, {_class_sql(c)} AS k FROM {_RAW_SQL}))")


def _raw_orders(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    key, text = F.col("o_orderkey"), lambda c: F.col(c).cast("string")
    day, time = F.date_format("o_orderdate", "yyyy-MM-dd"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return o.select(
        text("o_orderkey").alias("o_orderkey"), (key * F.lit(4000000000)).cast("string").alias("o_wide"), "o_orderstatus",
        text("o_totalprice").alias("o_totalprice"), day.alias("o_orderdate"), F.when(key % 3 == 0, day).otherwise(time).alias("o_when"),
        F.when(key % 2 == 0, text("o_custkey")).otherwise(text("o_totalprice")).alias("o_mixed"),
        F.when(key % 5 == 0, "n/a").when(key % 7 == 0, F.concat(text("o_custkey"), F.lit("x"))).when(key % 11 != 0, text("o_custkey")).alias("o_code"),
        (key % 2 == 0).cast("string").alias("o_even"), F.concat(text("o_custkey"), F.lit("e"), (key % 4).cast("string")).alias("o_float"),
        "o_orderpriority")


@query("infer_schema_profile", ops=("S02", "S06"), writes=True, sql="\nUNION ALL\n".join(
    _counts_sql(c, i, k) for i, (c, k) in enumerate(_RAW_TYPES, 1)))
def infer_schema_profile(spark: SparkSession, sf: str) -> DataFrame:
    # counts per priority are stored, then merged to those of the table without reading it again
    parts = T.class_counts(_raw_orders(spark, sf), by=["o_orderpriority"])
    path = SK.write_parquet(parts, session_path(spark, "orders-class-counts"))
    return T.inferred_types(T.merge_counts(spark.read.parquet(path)))
