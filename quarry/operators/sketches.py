"""Quantile sketches that are stored per group and merged to any coarser group.

Spark's ``percentile_approx`` has to read the rows again for every grouping.
A KLL sketch of each finest group is kept as a table; the quartiles of any
union of groups follow from merging sketches, without the rows. All of it is
built-in aggregates: no Python sees a value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size of a sketch; the rank of a quantile is off by about 2.3 / K^0.9 of the rows at most (99 of 100).
K = 2000
#: The bound that is promised for K: several times that, so that it holds for every one of many quantiles.
RANK_ERROR = 0.01


def sketch_groups(df: DataFrame, by: Sequence[str], columns: Sequence[str], k: int = K) -> DataFrame:
    """by, column_name, rows, sketch: one sketch per group and numeric column, in one scan.
    Nulls and NaN are left out; ``rows`` counts the others. A group without a value has no row."""
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(f"`{c}`").cast("double")
        x = F.when(~F.isnan(x), x)
        aggs += [F.count(x).alias(f"n{i}"), F.kll_sketch_agg_double(x, F.lit(k)).alias(f"s{i}")]
    entries = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("rows"), F.col(f"s{i}").alias("sketch"))
                                  for i, c in enumerate(columns)]))
    return df.groupBy(*by).agg(*aggs).select(*by, entries.alias("e")).select(*by, "e.*").where("rows > 0")


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The same table for the coarser groups ``by`` (none: over all)."""
    return sketches.groupBy(*by, "column_name").agg(F.sum("rows").alias("rows"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_quantiles(sketches: DataFrame, probs: Sequence[float]) -> DataFrame:
    """One row per sketch and probability: ..., p, value."""
    keys = [c for c in sketches.columns if c not in ("sketch",)]
    entries = F.explode(F.array(*[F.struct(F.lit(float(p)).alias("p"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("value")) for p in probs]))
    return sketches.select(*keys, entries.alias("e")).select(*keys, "e.*")


def rank_errors(df: DataFrame, quantiles: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """quantiles with ``error``: how far p lies from the exact share of rows below
    the value, 0 if it lies between the shares below and up to it. ``quantiles``
    has a few rows per group and is joined as one packed row a group."""
    entry = F.struct("column_name", "p", "value")
    if by:
        rows = df.join(quantiles.groupBy(*by).agg(F.collect_list(entry).alias("q")), list(by))
    else:  # one row per column and probability
        few = quantiles.select("column_name", "p", "value").collect()
        literals = [F.struct(F.lit(r["column_name"]).alias("column_name"), F.lit(r["p"]).alias("p"), F.lit(r["value"]).cast("double").alias("value")) for r in few]
        rows = df.withColumn("q", F.array(*literals) if few else F.array().cast("array<struct<column_name:string,p:double,value:double>>"))
    x = F.lit(None).cast("double")
    for c in columns:
        v = F.col(f"`{c}`").cast("double")
        x = F.when(F.col("e.column_name") == c, F.when(~F.isnan(v), v)).otherwise(x)
    counted = rows.select(*by, *[F.col(f"`{c}`") for c in columns], F.explode("q").alias("e")).select(*by, "e.*", x.alias("x")) \
        .groupBy(*by, "column_name", "p", "value").agg(F.count("x").alias("n"), F.count_if(F.col("x") < F.col("value")).alias("below"),
                                                        F.count_if(F.col("x") <= F.col("value")).alias("upto"))
    low, high = F.col("below") / F.col("n"), F.col("upto") / F.col("n")
    return counted.withColumn("error", F.greatest(low - F.col("p"), F.col("p") - high, F.lit(0.0)))
