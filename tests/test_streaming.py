"""A stateless batch operator applied unchanged to a file stream."""

from pyspark.sql import functions as F

from quarry.functions.scalar import salary_band
from quarry.sources import sinks as SK
from quarry.streaming import read_stream, run_available


def test_stateless_operator_on_stream(spark, tmp_dir):
    src = tmp_dir + "/in"
    SK.write_parquet(spark.createDataFrame([(1, 23000.0), (2, -57400.0), (3, 1000.0)],
                                           "id int, salary double"), src)

    def cleanse_and_band(df):
        out = df.withColumn("salary", F.abs("salary")).where(F.col("salary") >= 20000)
        return out.withColumn("band", salary_band("salary"))

    stream = read_stream(spark, src, "id int, salary double")
    assert stream.isStreaming
    run_available(spark, stream, cleanse_and_band, tmp_dir + "/out", checkpoint=tmp_dir + "/ckpt")
    got = sorted((r.id, r.band) for r in spark.read.parquet(tmp_dir + "/out").collect())
    assert got == [(1, 2), (2, 6)]


def test_restart_with_checkpoint_processes_only_new_files(spark, tmp_dir):
    src, out, ckpt = tmp_dir + "/in", tmp_dir + "/out", tmp_dir + "/ckpt"
    schema = "id int, salary double"
    SK.write_parquet(spark.createDataFrame([(1, 30000.0)], schema), src + "/a")
    ident = lambda df: df
    run_available(spark, read_stream(spark, src + "/*", schema), ident, out, checkpoint=ckpt)
    SK.write_parquet(spark.createDataFrame([(2, 40000.0)], schema), src + "/b")
    run_available(spark, read_stream(spark, src + "/*", schema), ident, out, checkpoint=ckpt)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2]
