"""Physical-plan checks: pushdown, pruning, top-k, join strategies, no
row-at-a-time Python and no all-pairs joins in any registered query."""

import re

import pytest

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from quarry.operators import relational as R
from quarry.plans.inspect import plan_text, pushed_filters, read_schemas
from quarry.plans.queries import REGISTRY

Q = E.queries()
NAMES = list(REGISTRY)


def test_filters_and_range_pushed_to_scan(spark):
    df = Q["select_filter"](spark, SF_SMALL)
    pf = " ".join(pushed_filters(df))
    assert "EqualTo(o_orderstatus,F)" in pf
    assert "GreaterThanOrEqual(o_orderdate,1999-01-01" in pf
    assert "GreaterThanOrEqual(o_orderdate" in " ".join(pushed_filters(Q["year_filter"](spark, SF_SMALL)))


def test_column_pruning(spark):
    schemas = read_schemas(Q["select_filter"](spark, SF_SMALL))
    assert len(schemas) == 1 and schemas[0].count(":") == 5
    (stats,) = read_schemas(Q["salary_stats"](spark, SF_SMALL))
    assert stats == "struct<c_acctbal:double>"


@pytest.mark.parametrize("name", ["top10_names", "first_n_by_key"])
def test_top_k_is_take_ordered(spark, name):
    assert "TakeOrderedAndProject" in plan_text(Q[name](spark, SF_SMALL), "simple")


@pytest.mark.parametrize("name", NAMES)
def test_no_all_pairs_join_no_row_python(spark, name):
    text = plan_text(Q[name](spark, SF_SMALL), "simple")
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text


def test_or_join_is_one_equi_join_over_probe_rows(spark):
    text = plan_text(Q["join_or"](spark, SF_SMALL), "simple")
    assert len(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin)", text)) == 1
    assert "Generate" in text and "NestedLoop" not in text


def test_flagship_pre_aggregates_before_join(spark):
    text = plan_text(E.entry(spark), "simple")
    join_at = min(text.find(j) for j in ("BroadcastHashJoin", "SortMergeJoin") if j in text)
    # an aggregate of orders sits below (printed after) the join
    assert "HashAggregate" in text[join_at:]


def test_udf_query_is_arrow_batched(spark):
    assert "Python" not in plan_text(Q["duration_minutes"](spark, SF_SMALL), "simple")
    text = plan_text(Q["duration_minutes_sql"](spark, SF_SMALL), "simple")
    assert "ArrowEvalPython" in text and "BatchEvalPython" not in text


SKEW = {"spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _executed(df):
    rows = df.collect()  # runs this frame's own plan, so AQE finalises it
    return len(rows), df._jdf.queryExecution().executedPlan().toString()


def _hot(spark, rows=30000):
    return spark.range(rows).select(
        F.col("id").alias("fid"), F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("k"))


@pytest.mark.parametrize("how", ["right", "full"])
@pytest.mark.parametrize("hot", ["left", "right"])
def test_outer_join_splits_a_hot_key_on_either_side(spark, skew_conf, how, hot):
    """One key holds a third of a side: AQE splits it in the inner part."""
    big, dims = _hot(spark), spark.range(1001).select((F.col("id") + 1).alias("dk"), (F.col("id") * 2).alias("v"))
    if hot == "left":
        native, rewrite = big.join(dims, big.k == dims.dk, how), R.outer_join(big, dims, [("k", "dk")], how)
    else:
        native, rewrite = dims.join(big, big.k == dims.dk, how), R.outer_join(dims, big, [("dk", "k")], how)
    rows, plan = _executed(rewrite)
    assert rows == native.count()
    assert "SortMergeJoin(skew=true)" in plan


@pytest.mark.parametrize("how", ["inner", "left", "semi", "anti"])
def test_hot_left_key_is_split(spark, skew_conf, how):
    big, dims = _hot(spark), spark.range(1000).select(F.col("id").alias("dk"))
    assert "skew=true" in _executed(R.join_on(big, dims, big.k == dims.dk, how))[1]


def test_join_with_a_pre_aggregated_side_splits_a_hot_key(spark, skew_conf):
    big = _hot(spark)
    side = R.pre_aggregate(big, ["k"], [F.count("*").alias("n")])
    rows, plan = _executed(R.join_on_names(big, side, ["k"]))
    assert rows == 30000 and "skew=true" in plan


def test_hot_label_is_split_without_a_broadcast(spark, skew_conf):
    from quarry.operators import regression as M
    texts = _hot(spark).select("fid", F.col("k").cast("string").alias("label"))
    rows, plan = _executed(M.index_column(texts, "label", "label_index"))
    assert rows == 30000 and "skew=true" in plan


def test_range_partitioned_sort_spreads_a_hot_leading_key(spark):
    """The total order (hot key, tie-breaker) lets the range partitioner
    split the rows of a key that holds a third of the data."""
    from pyspark.sql import functions as F
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        df = spark.range(30000).select("id", F.when(F.col("id") % 3 == 0, F.lit(0))
                                       .otherwise(F.col("id") % 100).alias("k"))
        parts = (df.orderBy("k", "id").select(F.spark_partition_id().alias("p"), "k")
                   .where(F.col("k") == 0).groupBy("p").count().collect())
        assert len(parts) >= 2  # the hot key's 10,000+ rows span several partitions
        assert max(r["count"] for r in parts) < 10100
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_or_join_probe_side_hot_key_is_split(spark):
    """A third of the left rows share one key: AQE splits it in the single
    join over probe rows that implements the OR join."""
    from pyspark.sql import functions as F

    from quarry.operators.relational import join_any_of
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "16",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        ev = spark.range(30000).select(
            F.col("id").alias("eid"),
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("u"),
            (F.col("id") % 997).alias("p"))
        cu = spark.range(1000).select(F.col("id").alias("ck"))
        df = join_any_of(ev, cu, [("u", "ck"), ("p", "ck")])
        expect = ev.join(cu, (ev.u == cu.ck) | (ev.p == cu.ck)).count()
        assert len(df.collect()) == expect
        assert "SortMergeJoin(skew=true)" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
