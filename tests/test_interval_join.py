"""Range joins and joins on alternatives, against loops over all pairs."""

import datetime as dt
import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from quarry.operators.interval_join import Alternative, join_alternatives, join_between
from quarry.plans.inspect import plan_text
from test_plans import _executed, skew_conf  # noqa: F401


def _pairs(df):
    return sorted(tuple(r) for r in df.select("i", "j").collect())


def _between(lo, x, hi):
    if lo is None or x is None or hi is None:
        return False
    top = lambda v: (isinstance(v, float) and math.isnan(v), 0 if isinstance(v, float) and math.isnan(v) else v)
    return top(lo) <= top(x) <= top(hi)


VALUES = {
    "long": lambda r: r.choice([None, r.randint(-20, 20), r.randint(-10**6, 10**6), 2**63 - 1, -2**63]),
    "double": lambda r: r.choice([None, r.uniform(-3, 3), r.uniform(-1e6, 1e6), math.inf, -math.inf, math.nan, 0.0, 1e-300, 1e300]),
    "date": lambda r: r.choice([None, dt.date(2020, 1, 1) + dt.timedelta(days=r.randint(-400, 400))]),
    "timestamp_ntz": lambda r: r.choice([None, dt.datetime(1969, 12, 31) + dt.timedelta(microseconds=r.randint(0, 10**13))]),
}


@pytest.mark.parametrize("kind", list(VALUES))
def test_intervals_of_any_length_meet_their_points_once(spark, kind):
    rng = random.Random(kind)
    draw = VALUES[kind]
    left = [(i, rng.randint(0, 2), *(draw(rng), draw(rng))) for i in range(60)]
    left += [(i, k, lo, lo) for i, k, lo, _ in left[:20]]  # intervals of length 0, repeated rows
    right = [(j, rng.randint(0, 2), draw(rng)) for j in range(60)]
    right[0] = (0, None, right[0][2])
    ldf = spark.createDataFrame(left, f"i int, k int, lo {kind}, hi {kind}")
    rdf = spark.createDataFrame(right, f"j int, kk int, x {kind}")
    expect = sorted((li[0], r[0]) for li, r in itertools.product(left, right) if _between(li[2], r[2], li[3]))
    assert _pairs(join_between(ldf, rdf, F.col("lo"), F.col("hi"), "x")) == expect
    keyed = sorted((li[0], r[0]) for li, r in itertools.product(left, right) if _between(li[2], r[2], li[3]) and li[1] == r[1])
    assert _pairs(join_between(ldf, rdf, F.col("lo"), F.col("hi"), "x", [("k", "kk")])) == keyed


def test_alternatives_give_every_pair_once(spark):
    rng = random.Random(5)
    left = [(i, rng.choice([None, *range(5)]), rng.choice([None, *range(30)])) for i in range(80)]
    right = [(j, rng.choice([None, *range(5)]), rng.choice([None, *range(30)])) for j in range(80)]
    ldf = spark.createDataFrame(left, "i int, k int, v int")
    rdf = spark.createDataFrame(right, "j int, kk int, x int")
    terms = [Alternative(keys=[("k", "kk")]), Alternative(low=F.col("v") - 1, high=F.col("v") + 2, point="x"),
             Alternative(keys=[("i", "j")])]
    expect = sorted((li[0], r[0]) for li, r in itertools.product(left, right)
                    if (li[1] is not None and li[1] == r[1]) or (li[2] is not None and r[2] is not None and li[2] - 1 <= r[2] <= li[2] + 2) or li[0] == r[0])
    assert _pairs(join_alternatives(ldf, rdf, terms)) == expect
    with pytest.raises(ValueError):
        join_alternatives(ldf, rdf, [Alternative()])


def test_empty_sides(spark):
    ldf, rdf = spark.createDataFrame([], "i int, lo int, hi int"), spark.createDataFrame([(1, 2)], "j int, x int")
    assert join_between(ldf, rdf, F.col("lo"), F.col("hi"), "x").collect() == []
    one = spark.createDataFrame([(1, 5, 3), (2, None, 3)], "i int, lo int, hi int")  # out of order; null
    assert join_between(one, rdf, F.col("lo"), F.col("hi"), "x").collect() == []


def test_query_has_no_nested_loop_and_widths_are_few(spark):
    text = plan_text(E.queries()["join_or_range"](spark, SF_SMALL), "simple")
    assert "NestedLoop" not in text and "Cartesian" not in text and "Generate" in text


def test_a_hot_bucket_is_split(spark, skew_conf):  # noqa: F811
    """A third of all points in one bucket, on the side of many rows."""
    points = spark.range(30000).select(F.col("id").alias("j"), F.when(F.col("id") % 3 == 0, F.lit(500)).otherwise(F.col("id") * 7).alias("x"))
    spans = spark.range(200).select(F.col("id").alias("i"), (F.col("id") * 100).alias("lo"), (F.col("id") * 100 + 50).alias("hi"))
    rows, plan = _executed(join_between(spans, points, F.col("lo"), F.col("hi"), "x"))
    xs = [500 if i % 3 == 0 else i * 7 for i in range(30000)]
    assert rows == sum(1 for x in xs if x // 100 < 200 and x % 100 <= 50)
    assert "SortMergeJoin(skew=true)" in plan
