"""Queries for joins on ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.interval_join import Alternative, join_alternatives
from quarry.plans.registry import query
from quarry.plans.standins import table


def _orders_and_lines(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")
    return o, li


@query("join_or_range", ops=("J04",), sql="""
SELECT o.o_orderkey, o.o_orderdate, l.l_orderkey, l.l_linenumber, l.l_shipdate
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
  OR (o.o_custkey = l.l_suppkey AND l.l_shipdate BETWEEN o.o_orderdate AND o.o_orderdate + INTERVAL 3 DAY)""")
def join_or_range(spark: SparkSession, sf: str) -> DataFrame:
    # a line belongs to its order, or was shipped by the customer's own supplier number within three days
    o, li = _orders_and_lines(spark, sf)
    out = join_alternatives(o, li, [
        Alternative(keys=[("o_orderkey", "l_orderkey")]),
        Alternative(keys=[("o_custkey", "l_suppkey")], low=F.col("o_orderdate"),
                    high=F.col("o_orderdate") + F.expr("INTERVAL 3 DAY"), point="l_shipdate")])
    return out.select("o_orderkey", "o_orderdate", "l_orderkey", "l_linenumber", "l_shipdate")
