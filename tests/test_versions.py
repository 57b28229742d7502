"""Versioned tables, counts of a write, stored models, functions defined in SQL."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from quarry.functions.udfs import define_minutes_function
from quarry.operators.models import load_model, save_model, versions
from quarry.plans.inspect import plan_text
from quarry.session import session_table
from quarry.sources.versions import create_versioned, drop_versions, location, replace_version, write_counted


def _table(spark, tmp_dir, stem):
    name = session_table(spark, stem)
    create_versioned(spark, name, spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string"), tmp_dir)
    return name


def test_table_made_from_itself(spark, tmp_dir):
    name = _table(spark, tmp_dir, "versions_a")
    first, reader = location(spark, name), spark.read.table(name)
    replace_version(spark, name, lambda t: t.where("k > 1").withColumn("k", F.col("k") * 10), tmp_dir)
    assert sorted(spark.read.table(name).collect()) == [(20, "b"), (30, None)]
    assert reader.count() == 3 and spark.read.parquet(first).count() == 3  # the old version's reader goes on
    replace_version(spark, name, lambda t: t.select("v", F.col("k").cast("string").alias("k2")), tmp_dir)
    assert spark.read.table(name).columns == ["v", "k2"] and spark.read.table(name).count() == 2
    assert len(drop_versions(spark, name, tmp_dir)) == 2
    assert spark.read.table(name).count() == 2


def test_failure_between_write_and_swap_leaves_the_table(spark, tmp_dir, monkeypatch):
    name = _table(spark, tmp_dir, "versions_b")
    before = location(spark, name)
    with pytest.raises(Exception):
        replace_version(spark, name, lambda t: t.withColumn("k", F.raise_error(F.lit("stop")).cast("int")), tmp_dir)  # while writing
    real = type(spark).sql

    def broken(self, text, *a, **b):
        if "SET LOCATION" in text:
            raise RuntimeError("lost before the swap")
        return real(self, text, *a, **b)

    monkeypatch.setattr(type(spark), "sql", broken)
    with pytest.raises(RuntimeError):
        replace_version(spark, name, lambda t: t.where("k = 1"), tmp_dir)
    monkeypatch.undo()
    assert location(spark, name) == before and spark.read.table(name).count() == 3
    replace_version(spark, name, lambda t: t.where("k = 1"), tmp_dir)  # and it can be done again
    assert spark.read.table(name).count() == 1


def test_counts_of_a_write_and_one_scan(spark, tmp_dir):
    src = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    seen = []
    counts = write_counted(src, lambda df: (seen.append(plan_text(df, "simple")), df.write.parquet(tmp_dir)),
                           keep=F.col("o_orderkey") % 4 > 0, top=F.max("o_totalprice"))
    written = spark.read.parquet(tmp_dir)
    assert counts == {"source_rows": src.count(), "written_rows": written.count(), "top": src.agg(F.max("o_totalprice")).first()[0]}
    assert seen[0].count("FileScan") == 1 and seen[0].count("CollectMetrics") == 2
    empty = write_counted(src.limit(0), lambda df: df.write.mode("overwrite").parquet(tmp_dir))
    assert empty == {"source_rows": 0, "written_rows": 0}


def test_models_are_versions(spark, tmp_dir):
    df = spark.createDataFrame([("x",), ("x",), ("y",)], "s string")
    fit = lambda d: Pipeline(stages=[StringIndexer(inputCol="s", outputCol="i", handleInvalid="keep")]).fit(d)
    assert versions(spark, tmp_dir, "m") == []
    with pytest.raises(KeyError):
        load_model(spark, tmp_dir, "m")
    assert save_model(fit(df), spark, tmp_dir, "m") == 1
    assert save_model(fit(df.where("s = 'y'")), spark, tmp_dir, "m") == 2
    assert save_model(fit(df), spark, tmp_dir, "other") == 1
    new = df.unionByName(spark.createDataFrame([("unseen",), (None,)], "s string"))
    index = lambda m: {r.s: r.i for r in m.transform(new).collect()}
    assert index(load_model(spark.newSession(), tmp_dir, "m", 1)) == {"x": 0, "y": 1, "unseen": 2, None: 2}
    assert index(load_model(spark, tmp_dir, "m")) == {"y": 0, "x": 1, "unseen": 1, None: 1}
    with pytest.raises(KeyError):
        load_model(spark, tmp_dir, "m", 3)


def test_function_defined_in_sql_is_inlined(spark):
    define_minutes_function(spark, "minutes_of")
    got = spark.sql("SELECT minutes_of(x) AS m FROM VALUES (90), (NULL), (0), (100) AS t(x)").collect()
    assert [r.m for r in got] == [1.5, None, 0.0, 1.667]
    text = plan_text(E.queries()["duration_minutes_function"](spark, SF_SMALL), "simple")
    assert "Python" not in text and "seconds_in_minutes" not in text.lower()
