"""Profiling: exact quantiles against numpy, one-pass profile, reconciliation."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.operators import profile as P

FAST = settings(max_examples=12, deadline=None)


def _np_quantiles(vals, probs):
    v = np.array([x for x in vals if x is not None], dtype=float)
    return [float(np.quantile(v, p, method="linear")) for p in probs]


@FAST
@given(vals=st.lists(st.one_of(st.none(), st.integers(-20, 20), st.floats(-1e6, 1e6, allow_nan=False)),
                     min_size=1, max_size=60).filter(lambda xs: any(x is not None for x in xs)))
def test_exact_quantiles_match_numpy(spark, vals):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in vals], "x double")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    # tiny bucket and final sizes force several narrowing rounds
    got = {r.p_index: r.value for r in P.exact_quantiles(df, ["x"], probs, accuracy=4, final_rows=3).collect()}
    want = _np_quantiles(vals, probs)
    for j, w in enumerate(want):
        assert abs(got[j] - w) <= 1e-9 * max(1.0, abs(w))


def test_exact_quantiles_hot_value(spark):
    # one value holds a third of all rows: it collapses to one (value, count) pair
    vals = [7.0] * 4000 + [float(i) for i in range(8000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(6)
    got = {r.p_index: r.value for r in P.exact_quantiles(df, ["x"], [0.25, 0.5, 0.75]).collect()}
    want = _np_quantiles(vals, [0.25, 0.5, 0.75])
    assert [got[j] for j in range(3)] == want


def test_approx_quartiles_option(spark):
    df = spark.range(0, 1001).selectExpr("cast(id as double) as x")
    row = P.column_quartiles(df, ["x"], exact=False).first()
    assert abs(row.median - 500) <= 1


def test_column_profile_typed(spark):
    df = spark.createDataFrame([(1, "a", 2.5), (3, None, None), (None, "c", 4.5)], "i int, s string, d double")
    rows = {r.column_name: r for r in P.column_profile(df, digits=6).collect()}
    assert rows["i"].non_null == 2 and rows["i"].nulls == 1 and rows["i"].mean == 2.0
    assert rows["i"].min_num == 1.0 and rows["i"].max_num == 3.0 and rows["i"].min_text is None
    assert rows["s"].min_text == "a" and rows["s"].max_text == "c" and rows["s"].mean is None
    assert rows["d"].stddev == round(float(np.std([2.5, 4.5], ddof=1)), 6)
    assert [rows[c].ordinal for c in ("i", "s", "d")] == [1, 2, 3]


def test_schema_profile(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    rows = P.schema_profile(df).collect()
    assert [(r.column_name, r.ordinal, r.data_type, r.nulls) for r in rows] == \
        [("a", 1, "int", 0), ("b", 2, "string", 1)]


def test_count_reconcile(spark):
    r = P.count_reconcile(spark.range(10), spark.range(9)).first()
    assert (r.source_rows, r.copy_rows, r.counts_match) == (10, 9, False)


def test_distinct_counts(spark):
    rows = P.distinct_counts([("a", spark.range(10), "id"),
                              ("b", spark.range(10).selectExpr("id % 3 as id"), "id")]).collect()
    assert {r.source: r.distinct_count for r in rows} == {"a": 10, "b": 3}


def test_profiles_with_awkward_column_names(spark):
    df = spark.createDataFrame([(1, "x")], "`it's` int, `a``b` string")
    names = [r.column_name for r in P.column_profile(df).collect()]
    assert names == ["it's", "a`b"]
    assert [r.column_name for r in P.schema_profile(df).collect()] == ["it's", "a`b"]


def test_quartiles_of_an_all_null_column(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    rows = {r.column_name: r for r in P.column_quartiles(df, ["a", "b"]).collect()}
    assert rows["a"].median == 1.5
    assert rows["b"].q1 is None and rows["b"].median is None and rows["b"].q3 is None


def _spark_percentile(df, col, probs):
    row = df.selectExpr(*[f"percentile({col}, {p}) as p{j}" for j, p in enumerate(probs)]).first()
    return [row[f"p{j}"] for j in range(len(probs))]


def test_quantiles_of_nan_infinities_and_wide_spreads(spark):
    nan, inf = float("nan"), float("inf")
    spread = [10.0 ** (e / 7) for e in range(-2100, 2101)]
    for vals in ([nan] + [float(i) for i in range(1000)], [inf, -inf] + [float(i) for i in range(1000)], [nan] * 300 + [inf] * 300 + [5.0] * 400,
                 spread, [7.0] * 500 + spread, [-0.0, 0.0, 1e-320, -1e-320] * 50):
        df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(3)
        probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
        got = {r.p_index: r.value for r in P.exact_quantiles(df, ["x"], probs, accuracy=20, final_rows=8).collect()}
        for j, w in enumerate(_spark_percentile(df, "x", probs)):
            assert repr(got[j]) == repr(w) or abs(got[j] - w) <= 1e-9 * abs(w), (j, got[j], w)


def test_quantiles_of_big_integers_and_decimals(spark):
    from decimal import Decimal
    base = 2 ** 62
    vals = sorted({base + (i * 7919) % 5003 for i in range(3000)} | {-base})
    df = spark.createDataFrame([(v, Decimal(v) / 100) for v in vals], "x bigint, d decimal(22,2)").repartition(3)
    rank = [0, 1000, len(vals) - 1]
    probs = [r / (len(vals) - 1) for r in rank]
    got = P.exact_quantiles(df, ["x", "d"], probs, buckets=8, final_rows=4).collect()
    for r in got:
        want = vals[rank[r.p_index]]
        assert r.value == float(want if r.column_name == "x" else Decimal(want) / 100)


def test_no_collect_is_larger_than_the_bound(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    sizes, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: sizes.append(len(out := collect(self))) or out)
    spread = spark.range(20_000).selectExpr("pow(10, id / 40.0 - 250) as x", "id * 1000003 as i", "if(id = 3, double('inf'), id) as y", "if(id = 3, double('nan'), id) as z")
    frame = P.exact_quantiles(spread, ["x", "i", "y", "z"], [0.25, 0.5], accuracy=100, buckets=64, final_rows=50)
    assert sizes and max(sizes) <= 4 * 4 * 64
    assert frame.count() == 8


def test_profile_keeps_native_order_and_extremes(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(999, 1, 1), 1e14, float("nan")), (dt.datetime(2001, 1, 1), 1e14, 1.0)], "t timestamp_ntz, big double, odd double")
    rows = {r.column_name: r for r in P.column_profile(df, digits=6).collect()}
    assert rows["t"].min_text.startswith("0999") and rows["big"].mean == 1e14 and np.isnan(rows["odd"].mean)
