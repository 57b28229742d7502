"""Queries for table profiling and schema inspection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import profile as P
from quarry.operators import sketches as S
from quarry.plans.registry import fixed_sql, query
from quarry.plans.standins import table
from quarry.session import session_path
from quarry.sources import sinks as SK

# (name, kind) of the customer table, in order; kind: n = numeric, t = text
_CUSTOMER_COLS = [("c_custkey", "n"), ("c_name", "t"), ("c_nationkey", "n"),
                  ("c_acctbal", "n"), ("c_mktsegment", "t")]


def _profile_sql(tbl: str, cols) -> str:
    parts = []
    for i, (c, kind) in enumerate(cols, start=1):
        if kind == "n":
            stats = (f"{fixed_sql(f'avg({c})', 6)} AS mean, {fixed_sql(f'stddev_samp({c})', 6)} AS stddev, "
                     f"CAST(min({c}) AS DOUBLE) AS min_num, CAST(max({c}) AS DOUBLE) AS max_num, "
                     "CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text")
        else:
            stats = ("CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev, "
                     "CAST(NULL AS DOUBLE) AS min_num, CAST(NULL AS DOUBLE) AS max_num, "
                     f"min({c}) AS min_text, max({c}) AS max_text")
        parts.append(f"SELECT '{c}' AS column_name, CAST({i} AS INTEGER) AS ordinal, "
                     f"count({c}) AS non_null, count(*) - count({c}) AS nulls, {stats} FROM {tbl}")
    return "\nUNION ALL\n".join(parts)


@query("column_profile", ops=("G10", "G12", "D07"), sql=_profile_sql("customer", _CUSTOMER_COLS))
def column_profile(spark: SparkSession, sf: str) -> DataFrame:
    return P.column_profile(table(spark, sf, "customer"), digits=6)


# every numeric column of lineitem
_QUARTILE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                  "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("column_quartiles", ops=("G11",), sql="\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, {fixed_sql(f'quantile_cont({c}, 0.25)', 6)} AS q1, "
    f"{fixed_sql(f'quantile_cont({c}, 0.5)', 6)} AS median, "
    f"{fixed_sql(f'quantile_cont({c}, 0.75)', 6)} AS q3 FROM lineitem" for c in _QUARTILE_COLS))
def column_quartiles(spark: SparkSession, sf: str) -> DataFrame:
    return P.column_quartiles(table(spark, sf, "lineitem"), _QUARTILE_COLS, exact=True, digits=6)


_SKETCHED = ["l_quantity", "l_extendedprice"]


@query("quantile_sketches", ops=("G11",), writes=True, sql="\nUNION ALL\n".join(
    f"SELECT {flag} AS return_flag, '{c}' AS column_name, p, count({c}) AS row_count, true AS within_bound "
    f"FROM lineitem, (VALUES (0.25::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE)) t(p) GROUP BY ALL"
    for c in _SKETCHED for flag in ("l_returnflag", "NULL::VARCHAR")))
def quantile_sketches(spark: SparkSession, sf: str) -> DataFrame:
    # sketches per flag and status are stored once; both groupings come from them, not from the rows
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", *_SKETCHED)
    path = SK.write_parquet(S.sketch_groups(li, ["l_returnflag", "l_linestatus"], _SKETCHED), session_path(spark, "lineitem-sketches"))
    stored, out = spark.read.parquet(path), None
    for by in (["l_returnflag"], []):
        found = S.sketch_quantiles(S.merge_sketches(stored, by), [0.25, 0.5, 0.75])
        checked = S.rank_errors(li, found, by, _SKETCHED).select(
            (F.col("l_returnflag") if by else F.lit(None).cast("string")).alias("return_flag"), "column_name", "p",
            F.col("n").alias("row_count"), (F.col("error") <= S.RANK_ERROR).alias("within_bound"))
        out = checked if out is None else out.unionByName(checked)
    return out


# lineitem's columns with their Spark type names, in order.
_LINEITEM_TYPES = [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
                   ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
                   ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
                   ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")]


@query("schema_profile", ops=("D07",), sql="\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST({i} AS INTEGER) AS ordinal, '{t}' AS data_type, "
    f"count(*) - count({c}) AS nulls FROM lineitem"
    for i, (c, t) in enumerate(_LINEITEM_TYPES, start=1)))
def schema_profile(spark: SparkSession, sf: str) -> DataFrame:
    return P.schema_profile(table(spark, sf, "lineitem"))
