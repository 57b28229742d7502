"""Language identification: held-out accuracy, defined edge cases, convolution against plain loops."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm.langid import FILTERS, WIDTHS, WINDOW, ByteNetwork, identify, normalise, train, windows

SF = "/root/testdata/sf0.01/documents.parquet"


@pytest.fixture(scope="module")
def network(spark):
    return train(spark.read.parquet(SF), documents=1200)


def test_held_out_accuracy(spark, network):
    docs = spark.read.parquet(SF)
    out = identify(docs, network).join(docs.select("doc_id", "lang"), "doc_id").where("lang is not null").collect()
    held = [r for r in out if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    assert len(held) > 200 and sum(r.lang == r.lang_pred for r in held) / len(held) >= 0.95
    assert all(0 <= r.score <= 1 for r in out)


def test_labels_and_names_of_the_judged_rows_play_no_part(spark, network):
    docs = spark.read.parquet(SF).limit(50)
    changed = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("y")).withColumn("doc_id", F.col("doc_id") + 10_000_000)
    same = lambda df: sorted((r.doc_id % 10_000_000, r.lang_pred, r.score) for r in identify(df, network).collect())
    assert same(docs) == same(changed)


def test_edge_cases(spark, network):
    long = "the quick answer and the end " * 20_000
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, "é"), (5, "日本"), (6, "½ — ٣"), (7, long), (7, long), (None, "x"), (8, "A\x00b")]
    df = spark.createDataFrame([(d, t, 1.0, True) for d, t in rows], "doc_id long, text string, score double, held_out boolean").repartition(3)
    out = sorted(((r.doc_id, r.lang_pred, r.score) for r in identify(df, network).collect()), key=str)
    assert len(out) == len(rows)
    assert [r[0] for r in out if r[1] == "und"] == [1, 2, 3, 6] and all(r[2] == 0 for r in out if r[1] == "und")
    assert all(r[1] in network.languages for r in out if r[1] != "und")
    assert identify(df.limit(0), network).collect() == []


def test_without_labels_or_with_one_language(spark):
    df = spark.createDataFrame([(i, "some text", None) for i in range(9)], "doc_id long, text string, lang string")
    assert train(df) is None and {r.lang_pred for r in identify(df, None).collect()} == {"und"}
    only = train(df.withColumn("lang", F.lit("qq")))
    assert {(r.lang_pred, r.score) for r in identify(df, only).collect()} == {("qq", 1.0)}


def test_look_ups_equal_plain_convolution():
    texts = ["Ab ÉÈ!!", "x", "", "the end " * 80, "\t12"]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    data, at = normalise(np.frombuffer(b"".join(raw), np.uint8), offsets)
    assert data[at[0]:at[1]].tobytes().decode() == "ab éè "
    grid, row, length = windows(data, at)
    assert row.tolist() == [0, 1, 3, 3, 3, 4]
    network = ByteNetwork(["a", "b"], 5)
    for got, line, n in zip(network.pooled(grid), grid, length):
        for k, w in enumerate(WIDTHS):
            answers = [sum(network.filters[w][j][line[p + j]] for j in range(w)) for p in range(n - w + 1)]
            want = np.maximum(np.max(answers, axis=0), 0) if answers else np.zeros(FILTERS)
            assert np.allclose(got[k * FILTERS:(k + 1) * FILTERS], want, atol=1e-5)
    assert grid.shape[1] == WINDOW + 3
