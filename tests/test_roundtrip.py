"""Round trip of every file format on generated rows (Hypothesis)."""

from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.session import scratch_path
from quarry.sources import readers as RD
from quarry.sources import sinks as SK

SCHEMA = "k INT, s STRING, d DOUBLE"
FAST = settings(max_examples=10, deadline=None)

text = st.text(alphabet=st.characters(blacklist_categories=("Cs",), blacklist_characters="\x00\r"),
               min_size=0, max_size=12)
rows = st.lists(st.tuples(st.integers(-10**6, 10**6),
                          st.one_of(st.none(), text),
                          st.one_of(st.none(), st.floats(-1e12, 1e12, allow_nan=False, width=64))),
                min_size=0, max_size=20)


def _canon(rs):
    return sorted((r[0], r[1], r[2]) for r in rs)


def _frame(spark, data):
    return spark.createDataFrame([(i, s, d) for i, (_, s, d) in enumerate(data)], SCHEMA)


@FAST
@given(data=rows)
def test_parquet_round_trip(spark, data):
    df = _frame(spark, data)
    path = SK.write_parquet(df, scratch_path(spark, "rt-parquet"))
    assert _canon(RD.read_parquet(spark, path).collect()) == _canon(df.collect())


@FAST
@given(data=rows)
def test_json_lines_round_trip(spark, data):
    df = _frame(spark, data)
    path = SK.write_json(df, scratch_path(spark, "rt-json"))
    assert _canon(RD.read_json(spark, path, schema=SCHEMA).collect()) == _canon(df.collect())


@FAST
@given(data=rows)
def test_json_array_round_trip(spark, data):
    df = _frame(spark, data)
    path = SK.write_json(df, scratch_path(spark, "rt-jsonarr"), layout="array")
    assert _canon(RD.read_json(spark, path, schema=SCHEMA, layout="array").collect()) == _canon(df.collect())


@FAST
@given(data=rows)
def test_csv_round_trip(spark, data):
    df = _frame(spark, data)
    path = SK.write_csv(df, scratch_path(spark, "rt-csv"))
    back = RD.read_csv(spark, path, schema=SCHEMA, multi_line=True)
    assert _canon(back.collect()) == _canon(df.collect())
