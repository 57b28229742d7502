"""Operators on literal edge rows, twin DataFrame/SQL tests and properties."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import Window

import __spark_entry__ as E
from conftest import SF_SMALL
from quarry.functions import scalar as X
from quarry.functions.udfs import minutes_udf, register_minutes_udf
from quarry.operators import relational as R
from quarry.operators import semistructured as S

FAST = settings(max_examples=15, deadline=None)


def test_salary_band_golden_values(spark):
    df = spark.createDataFrame([(23000,), (57400,), (25000,), (35000,)], "salary int")
    assert [r.b for r in df.select(X.salary_band("salary").alias("b")).collect()] == [2, 6, 3, 4]


def test_abs_overflow_raises_under_ansi(spark):
    df = spark.createDataFrame([(-2147483648,)], "salary int")
    with pytest.raises(Exception, match="ARITHMETIC_OVERFLOW|overflow"):
        df.select(F.abs("salary")).collect()


def test_instr_examples(spark):
    df = spark.createDataFrame([("945xx",), ("94501",), ("xx1",)], "zip string")
    assert [r.i for r in df.select(F.instr("zip", "xx").alias("i")).collect()] == [4, 0, 1]


def test_having_resolves_alias_to_aggregate(spark):
    spark.createDataFrame([(3, 1), (5, 2), (1, 2), (9, 3)], "c int, b int").createOrReplaceTempView("hv")
    rows = spark.sql("select avg(c) as c, b from hv group by b having c <> 3").collect()
    assert [(r.b, r.c) for r in rows] == [(3, 9.0)]


def test_distinct_nulls_form_one_group(spark):
    df = spark.createDataFrame([(1,), (None,), (None,)], "v int")
    assert sorted(R.distinct_rows(df).collect(), key=lambda r: (r.v is None, r.v)) == \
        [(1,), (None,)]


def test_drop_unknown_columns_is_noop(spark):
    df = spark.range(3)
    assert df.drop("no_such_column").columns == ["id"]


def test_json_array_first_element_and_explode(spark):
    df = spark.createDataFrame([(1, '["x","y"]'), (2, "[]"), (3, None)], "k int, a string")
    p = S.parse_json_column(df, "a", "array<string>")
    assert [r.f for r in p.orderBy("k").select(S.first_element("a").alias("f")).collect()] == ["x", None, None]
    with pytest.raises(Exception):
        p.select(F.col("a").getItem(5)).collect()  # ANSI: out-of-bounds index raises
    assert S.explode_array(p, "a", "e", ["k"]).count() == 2
    outer = S.explode_array(p, "a", "e", ["k"], outer=True)
    assert outer.count() == 4 and outer.select("k").distinct().count() == 3


def test_json_struct_text_and_already_parsed(spark):
    df = spark.createDataFrame([('{"k": 4}',), ("bad",), (None,)], "props string")
    parsed = S.parse_json_column(df, "props", "k int")
    assert [r.k for r in S.lift_field(parsed, "props", "k").collect()] == [4, None, None]
    # a struct column passes through instead of failing in from_json
    again = S.parse_json_column(parsed, "props", "k int")
    assert again.schema == parsed.schema


def test_timestamp_text(spark):
    df = spark.createDataFrame([("2013-04-01",), ("xx",)], "t string")
    vals = [r.v for r in df.select(X.to_timestamp_text("t").alias("v")).collect()]
    assert vals[0].year == 2013 and vals[1] is None
    with pytest.raises(Exception):
        df.select(F.to_timestamp("t")).collect()


def test_trip_date_and_compact_timestamp(spark):
    df = spark.createDataFrame([("8/31/2015 23:26", "20141013T000000")], "d string, c string")
    r = df.select(X.parse_date_text("d").alias("day"), X.parse_compact_timestamp("c").alias("ts")).first()
    assert str(r.day) == "2015-08-31"
    assert str(r.ts) == "2014-10-13 00:00:00"
    out = df.select(X.format_date_text(X.parse_date_text("d")).alias("t"),
                    X.epoch_seconds(X.parse_compact_timestamp("c")).alias("e")).first()
    assert out.t == "08/31/2015" and out.e == 1413158400


def test_compact_timestamp_independent_of_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([("20141013T000000",)], "c string")
        assert df.select(X.epoch_seconds(X.parse_compact_timestamp("c"))).first()[0] == 1413158400
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_untyped_udf_yields_strings_typed_udf_doubles(spark):
    df = spark.createDataFrame([(100,), (60,), (1800000000,), (None,)], "s long")
    untyped = F.udf(lambda s: round(s / 60, 3))
    no_null = df.where(F.col("s").isNotNull())
    vals = [r[0] for r in no_null.select(untyped("s")).collect()]
    assert vals == ["1.667", "1.0", "3.0E7"]
    with pytest.raises(Exception):  # the untyped UDF fails on a null input
        df.select(untyped("s")).collect()
    typed = [r[0] for r in df.select(minutes_udf("s")).collect()]
    assert typed[:3] == [1.667, 1.0, 3.0e7] and typed[3] is None
    native = [r[0] for r in df.select(X.seconds_to_minutes("s", 3)).collect()]
    assert native == typed


def test_registered_udf_in_sql(spark):
    register_minutes_udf(spark, "to_minutes_t")
    assert spark.sql("select to_minutes_t(100L) as m").first().m == 1.667


def test_year_count_twins(spark):
    q = E.queries()
    a = [tuple(r) for r in q["year_count"](spark, SF_SMALL).collect()]
    b = [tuple(r) for r in q["sql_year_count"](spark, SF_SMALL).collect()]
    assert a == b and len(a) > 0


def test_duration_minutes_twins(spark):
    q = E.queries()
    a = q["duration_minutes"](spark, SF_SMALL).orderBy("Trip_ID").collect()
    b = q["duration_minutes_sql"](spark, SF_SMALL).orderBy("Trip_ID").collect()
    assert [(r.Trip_ID, r.DurationMins) for r in a] == [(r.Trip_ID, r.DurationMins) for r in b]


def test_top_k_tie_break_is_total(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 2), ("d", 1)], "n string, c int")
    top = R.top_k(df, [F.col("c").desc(), F.col("n").asc()], 2).collect()
    assert [(r.n, r["rank"]) for r in top] == [("a", 1), ("b", 2)]


def test_first_n_requires_order(spark):
    with pytest.raises(ValueError):
        R.first_n(spark.range(3), [], 2)


key = st.one_of(st.none(), st.integers(0, 6))
pairs = st.lists(st.tuples(key, key), min_size=0, max_size=25)


@FAST
@given(left=pairs, right=pairs)
def test_or_join_rewrite_equals_or_join(spark, left, right):
    l = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(left)] or [], "lid int, a int, b int")
    r = spark.createDataFrame([(j, k) for j, (k, _) in enumerate(right)] or [], "rid int, k int")
    expect = sorted(tuple(x) for x in l.join(r, (l.a == r.k) | (l.b == r.k)).select("lid", "rid").collect())
    got = sorted(tuple(x) for x in R.join_any_of(l, r, [("a", "k"), ("b", "k")]).select("lid", "rid").collect())
    assert got == expect


@FAST
@given(left=pairs, right=pairs)
def test_or_join_on_two_right_columns(spark, left, right):
    l = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(left)] or [], "lid int, a int, b int")
    r = spark.createDataFrame([(j, x, y) for j, (x, y) in enumerate(right)] or [], "rid int, x int, y int")
    expect = sorted(tuple(v) for v in l.join(r, (l.a == r.x) | (l.b == r.y)).select("lid", "rid").collect())
    got = sorted(tuple(v) for v in R.join_any_of(l, r, [("a", "x"), ("b", "y")]).select("lid", "rid").collect())
    assert got == expect


@FAST
@given(left=st.lists(st.one_of(st.none(), st.integers(0, 5)), max_size=20),
       right=st.lists(st.one_of(st.none(), st.integers(0, 5)), max_size=20))
def test_semi_plus_anti_is_left(spark, left, right):
    l = spark.createDataFrame([(i, v) for i, v in enumerate(left)], "i int, k int")
    r = spark.createDataFrame([(v,) for v in right], "k2 int")
    semi = R.join_on(l, r, l.k == r.k2, "semi").collect()
    anti = R.join_on(l, r, l.k == r.k2, "anti").collect()
    assert sorted(x.i for x in semi + anti) == list(range(len(left)))


@FAST
@given(vals=st.lists(st.tuples(st.integers(0, 3), st.integers(-50, 50)), min_size=1, max_size=40),
       parts=st.integers(1, 5))
def test_global_position_equals_row_number(spark, vals, parts):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(vals)], "id int, a int, b int") \
        .repartition(parts)
    order = [F.col("a").desc(), F.col("b").asc(), F.col("id").asc()]
    got = {r.id: r.position for r in R.with_global_position(df, order).collect()}
    want = {r.id: r.rn for r in df.select("id", F.row_number().over(Window.orderBy(*order)).alias("rn")).collect()}
    assert got == want


def test_year_at_least_matches_year(spark):
    df = spark.sql("select explode(array(timestamp_ntz'1990-12-31 23:59:59', "
                   "timestamp_ntz'1991-01-01 00:00:00', null)) as d")
    got = [r.k for r in df.select(X.year_at_least("d", 1991).alias("k")).collect()]
    assert got == [False, True, None]


def test_wall_clock_text_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        # 02:14:47 on 2025-03-09 does not exist in Los Angeles (DST gap)
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.sql("select timestamp_ntz'2025-03-09 02:14:47' as t, '3/9/2025 2:14' as s, 'bad' as b")
        r = df.select(X.wall_text("t", X.ISO_SECONDS_FORMAT).alias("iso"),
                      X.wall_text("t", X.TRIP_TEXT_FORMAT).alias("trip"),
                      X.wall_text("t", X.COMPACT_TS_FORMAT).alias("compact"),
                      X.parse_timestamp_text("s", X.TRIP_TEXT_FORMAT).alias("p"),
                      X.parse_timestamp_text("b", X.TRIP_TEXT_FORMAT).alias("bad"),
                      X.to_timestamp_text(F.lit("2025-03-09T02:14:47")).alias("c")).first()
        assert r.iso == "2025-03-09T02:14:47" and r.trip == "3/9/2025 2:14"
        assert r.compact == "20250309T021447"
        assert (r.p.hour, r.p.minute) == (2, 14) and r.bad is None and r.c.hour == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@FAST
@given(left=pairs, right=pairs)
def test_full_outer_rewrite_equals_full_join(spark, left, right):
    l = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(left)] or [], "lid int, a int")
    r = spark.createDataFrame([(j, k) for j, (k, _) in enumerate(right)] or [], "rid int, k int")
    expect = sorted(map(tuple, l.join(r, l.a == r.k, "full").select("lid", "a", "rid", "k").collect()),
                    key=repr)
    got = sorted(map(tuple, R.outer_join(l, r, [("a", "k")]).select("lid", "a", "rid", "k").collect()),
                 key=repr)
    assert got == expect


def test_select_expr_needs_backticks_for_spaced_names(spark):
    df = spark.createDataFrame([("a", 5)], "`Start Station` string, `Bike #` int")
    with pytest.raises(Exception):  # parsed as `Start AS Station`: unresolved column
        df.selectExpr("Start Station").collect()
    r = df.selectExpr("`Start Station`", "`Bike #` between 1 and 100 as premium_bike").first()
    assert r["Start Station"] == "a" and r.premium_bike is True


@FAST
@given(vals=st.lists(st.floats(0, 1e7, allow_nan=False), min_size=1, max_size=30))
def test_bands_are_monotone(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "s double")
    rows = sorted((r.s, r.b) for r in df.select("s", X.salary_band("s").alias("b")).collect())
    bands = [b for _, b in rows]
    assert bands == sorted(bands)


@FAST
@given(arrays=st.lists(st.one_of(st.none(), st.lists(st.sampled_from(["x", "y", None]), max_size=3)),
                       min_size=1, max_size=15))
def test_explode_outer_keeps_every_parent(spark, arrays):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(arrays)], "k int, a array<string>")
    out = S.explode_array(df, "a", "e", ["k"], outer=True)
    assert sorted({r.k for r in out.collect()}) == list(range(len(arrays)))
    assert out.count() == sum(max(1, len(a or [])) for a in arrays)
    inner = S.explode_array(df, "a", "e", ["k"])
    assert inner.count() == sum(len(a or []) for a in arrays)


def test_fixed_round_keeps_what_has_no_such_digits(spark):
    import math
    vals = [float("nan"), float("inf"), float("-inf"), 1e14, -1e300, 1.23456749, None]
    got = [r.v for r in spark.createDataFrame([(v,) for v in vals], "x double").select(X.fixed_round("x", 6).alias("v")).collect()]
    assert math.isnan(got[0]) and got[1:] == [float("inf"), float("-inf"), 1e14, -1e300, 1.234567, None]


def test_epoch_round_trip_in_any_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([(1413158400,), (-1,), (None,)], "s long").select("s", X.epoch_to_timestamp("s").alias("t"))
        assert [str(r.t) for r in df.collect()] == ["2014-10-13 00:00:00", "1969-12-31 23:59:59", "None"]
        assert df.select(X.epoch_seconds("t").alias("b")).collect() == df.select(F.col("s").alias("b")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
