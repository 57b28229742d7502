"""Compression classifier: curve and sizes by brute force, quality by held-out accuracy."""

import zlib

import numpy as np
import zstandard
from pyspark.sql import functions as F

from quarry.llm.quality import WINDOW, QualityModel, fit_curve, score_quality, size_difference, train

from tests.conftest import SF_ORACLE

#: The table with over a hundred held-out rows of label 0 (there are eleven in the next smaller one).
SF_LARGE = "/root/testdata/sf0.1"


def test_held_out_accuracy_and_folds(spark):
    docs, labels = (spark.read.parquet(f"{SF_LARGE}/{t}.parquet") for t in ("documents", "labels"))
    scored = score_quality(docs, train(docs, labels))
    assert scored.count() == docs.count()
    rows = scored.join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["predicted"] == r["quality"] for r in held]) >= 0.93
    good, bad = ([r["score"] for r in held if r["quality"] == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) >= 0.95


def test_held_out_labels_are_never_learned(spark):
    """Turning all held-out labels around changes nothing."""
    docs, labels = (spark.read.parquet(f"{SF_ORACLE}/{t}.parquet") for t in ("documents", "labels"))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert train(docs, labels, sample=60) == train(docs, turned, sample=60)


def test_size_difference_counts_every_window():
    good, bad = b"the quick brown fox jumps over the lazy dog. " * 20, b"BUY!! NOW!! CHEAP!! PILLS!! " * 20
    texts = [b"", b"the quick brown fox", b"x" * 10_000, (b"NOW!! CHEAP!! " * 1000)]
    expected = []
    for t in texts:
        size = [0, 0]
        for k, d in enumerate((good, bad)):
            c = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False)
            size[k] = sum(len(c.compress(t[i:i + WINDOW])) for i in range(0, len(t), WINDOW))
        expected.append((size[1] - size[0]) / max(len(t), 1))
    assert np.allclose(size_difference(texts, good, bad), expected)
    assert expected[1] > 0 > expected[3]


def test_curve_is_isotonic_and_weighted():
    x = np.array([0.0, 1.0, 2.0, 3.0, 4.0])
    knots, chances = fit_curve(x, np.array([0.0, 1.0, 0.0, 1.0, 1.0]), np.ones(5))
    assert list(chances) == sorted(chances) and np.allclose(np.interp([0, 1.5, 4], knots, chances), [0, 0.5, 1])
    _, heavy = fit_curve(x[:2], np.array([1.0, 0.0]), np.array([3.0, 1.0]))
    assert np.allclose(heavy, [0.75])


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (2, "", "b"), (None, "text ü", "c"), (3, "y" * 300_000, "d")],
                                 "doc_id long, text string, held_out string").withColumn("score", F.lit(9)).withColumn("label", F.lit(0))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = train(docs, none)
    assert model == QualityModel(b"", b"", (0.0,), (0.5,))
    rows = score_quality(docs, model).collect()
    assert len(rows) == 5 and all(r["score"] == 0.5 and r["predicted"] == 1 for r in rows)
    one = spark.createDataFrame([(3, 1), (3, None), (1, 1), (None, 0), (5, 7)], "doc_id long, quality int")
    assert train(docs, one).chances == (1.0,)
    both = spark.createDataFrame([(3, 1), (4, 0), (2, 0), (6, 1), (7, 0), (8, 1)], "doc_id long, quality int")
    some = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(i, f"word {i} " * i) for i in range(4, 9)], "doc_id long, text string"))
    assert all(0 <= r["score"] <= 1 for r in score_quality(some, train(some, both)).collect())
    assert score_quality(docs.limit(0), model).count() == 0
