"""Stored quantile sketches: merging, the rank bound, edges."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from quarry.operators.sketches import RANK_ERROR, merge_sketches, rank_errors, sketch_groups, sketch_quantiles


def test_merged_sketches_keep_the_rank_bound(spark, tmp_dir):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    many = li.withColumn("part", F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(60)))
    columns = ["l_quantity", "l_extendedprice", "l_orderkey"]
    sketch_groups(many, ["l_returnflag", "part"], columns).write.parquet(tmp_dir)
    stored = spark.read.parquet(tmp_dir)
    for by in (["l_returnflag"], []):
        merged = merge_sketches(stored, by)
        assert merged.agg(F.sum("rows")).first()[0] == 3 * li.count()
        found = sketch_quantiles(merged, [0.0, 0.25, 0.5, 0.9, 1.0])
        errors = rank_errors(li, found, by, columns)
        assert errors.count() == 15 * (li.select(*by).distinct().count() if by else 1)
        assert errors.agg(F.max("error")).first()[0] <= RANK_ERROR


def test_the_error_is_seen(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    wrong = spark.createDataFrame([("x", 1000, 0.5, 700.0), ("x", 1000, 0.25, 249.5)], "column_name string, rows long, p double, value double")
    got = {r.p: round(r.error, 6) for r in rank_errors(df, wrong, [], ["x"]).collect()}
    assert got == {0.5: 0.2, 0.25: 0.0}


def test_nulls_nan_and_empty_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", float("nan")), ("b", None)], "g string, `v.x` double")
    rows = sketch_groups(df, ["g"], ["v.x"]).select("g", "column_name", "rows").collect()
    assert [tuple(r) for r in rows] == [("a", "v.x", 1)]
    assert merge_sketches(sketch_groups(df.limit(0), ["g"], ["v.x"])).count() == 0
