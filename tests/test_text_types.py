"""Types of raw text: classes, the lattice, merging of parts."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.operators.text_types import CLASSES, class_counts, inferred_schema, inferred_types, merge_counts, typed, value_class

EXAMPLES = {
    "null": [None], "boolean": ["true", "FALSE"], "int": ["0", "-5", "+7", "2147483647", "007"],
    "long": ["2147483648", "-9223372036854775808"], "decimal": ["1.5", ".5", "5.", "9223372036854775808", "-0.00"],
    "double": ["1e5", "1.5E-3", "1" * 39], "date": ["2020-02-29"], "timestamp": ["2020-01-01 00:00:00", "2020-01-01T23:59:59.123456"],
    "text": ["", " ", " 1", "1x", "2021-02-29", "2020-1-1", "2020-01-01 24:00:00", "NaN", "1,5", "--1", ".", "e5"],
}


def test_classes(spark):
    rows = [(k, t) for k, texts in EXAMPLES.items() for t in texts]
    got = spark.createDataFrame(rows, "k string, t string").select("k", "t", value_class("t").alias("c")).collect()
    assert [(r.t, r.c) for r in got] == [(t, k) for k, t in rows]


def _type(spark, texts):
    return inferred_schema(spark.createDataFrame([(t,) for t in texts], "t string"))[0].dataType.simpleString()


def test_least_type_above_what_occurs(spark):
    assert _type(spark, ["1", None, "-3"]) == "int"
    assert _type(spark, ["1", "3000000000"]) == "bigint"
    assert _type(spark, ["1", "2.25", "1000"]) == "decimal(6,2)"
    assert _type(spark, ["9" * 30, "0." + "1" * 30]) == "double"
    assert _type(spark, ["1.5", "1e3"]) == "double"
    assert _type(spark, ["2020-01-01", "2020-01-01 10:00:00"]) == "timestamp_ntz"
    assert _type(spark, ["2020-01-01"]) == "date"
    assert _type(spark, ["true", "1"]) == "string"
    assert _type(spark, ["2020-01-01", "1"]) == "string"
    assert _type(spark, [None]) == "string" and _type(spark, []) == "string"


def test_typed_rows_lose_nothing(spark):
    df = spark.createDataFrame([("1", "1.50", "2020-01-01", "x"), (None, "22", None, "")], "a string, `b.c` string, d string, e string")
    out = typed(df, inferred_schema(df))
    assert [f.dataType.simpleString() for f in out.schema] == ["int", "decimal(4,2)", "date", "string"]
    assert out.select(*[F.count(F.col(f"`{c}`")) for c in out.columns]).first() == df.select(*[F.count(F.col(f"`{c}`")) for c in df.columns]).first()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from([t for texts in EXAMPLES.values() for t in texts])), max_size=40))
def test_parts_merge_to_the_whole(spark, rows):
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "part int, t string")
    whole = inferred_types(class_counts(df, ["t"])).collect()
    parts = class_counts(df, ["t"], by=["part"])
    merged = inferred_types(merge_counts(parts)).collect()
    if rows:
        assert [r.asDict() for r in merged] == [r.asDict() for r in whole]
        assert sum(whole[0][f"{k}_rows"] for k in CLASSES) == len(rows)
    else:
        assert merged == []
