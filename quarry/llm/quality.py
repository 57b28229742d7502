"""Quality classifier by compression.

Two zstandard dictionaries are trained, one on pieces of good and one on
pieces of bad labelled texts. A text is compressed window by window under
each; the difference of the two sizes, divided by the bytes of the text, is
the one feature, and an isotonic curve turns it into the probability of label
1. The curve is fitted on labelled texts under dictionaries that have not seen
them: those of the other half of the sample.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled rows of each class that are sampled.
SAMPLE = 3000
#: Of a sampled text, so many pieces at even distances, of so many characters each.
PIECES, PIECE_CHARS = 4, 2048
DICTIONARY_BYTES = 1 << 18
#: Texts are compressed whole, in windows of this many bytes: a dictionary only reaches so far.
WINDOW = 2048
LEVEL = 3


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries (empty: none could be made) and the curve over the size difference per byte."""
    good: bytes
    bad: bytes
    knots: tuple[float, ...]
    chances: tuple[float, ...]


def held_out(doc_id, folds: int = 5):
    """The documents whose labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(False))


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    options = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if not dictionary:
        return zstandard.ZstdCompressor(**options)
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=data, **options)


def size_difference(texts, good: bytes, bad: bytes) -> np.ndarray:
    """Per text (bytes): size under the bad dictionary less that under the good one, per byte; 0 for empty texts."""
    one, two = _compressor(good), _compressor(bad)
    out = np.zeros(len(texts))
    for i, text in enumerate(texts):
        gap = 0
        for at in range(0, len(text), WINDOW):
            piece = text[at:at + WINDOW]
            gap += len(two.compress(piece)) - len(one.compress(piece))
        out[i] = gap / max(len(text), 1)
    return out


def _dictionary(pieces: list[bytes]) -> bytes:
    """A trained dictionary; the plain end of the pieces where they are too few to train one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-DICTIONARY_BYTES:]


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[tuple[float, ...], tuple[float, ...]]:
    """The calibration curve as knots (x, probability): the weighted isotonic
    regression of y on x, by pooling adjacent violators. Pools hold at least a
    fiftieth of the rows where there are more than that, so that a knot is not
    one row's label; between knots the curve is a straight line."""
    least = max(len(x) // 50, 1)
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # weight, weighted x, weighted y
    for part in np.array_split(order, max(len(x) // least, 1)):
        w = weight[part]
        pools.append([w.sum(), (w * x[part]).sum(), (w * y[part]).sum()])
        while len(pools) > 1 and pools[-2][2] / pools[-2][0] >= pools[-1][2] / pools[-1][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return tuple(wx / w for w, wx, _ in pools), tuple(wy / w for w, _, wy in pools)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> QualityModel:
    """A model from at most ``sample`` labelled rows of each class (those least
    by a hash of doc_id), never from held-out ones. Of a text,
    PIECES pieces of PIECE_CHARS characters, spread over its whole length, come
    to the driver: at most 2 x sample x 8,192 characters whatever the tables
    hold. Labels other than 0 and 1, null labels and null or empty texts teach
    nothing. The share of label 1 is counted over all labels that may be
    learned. A class with fewer than two rows: every score is that share (0.5 without labels)."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")) \
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).where(~held_out("doc_id"))
    shares = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    total = sum(shares.values())
    prior = shares.get(1, 0) / total if total else 0.5
    order = F.xxhash64("doc_id", F.lit(13))
    chosen = None
    for value in (0, 1):
        part = usable.where(F.col("label") == value).distinct().orderBy(order, "doc_id").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    step = (F.length("text") - PIECE_CHARS) / F.lit(float(PIECES - 1))
    pieces = F.when(F.length("text") <= PIECES * PIECE_CHARS, F.array("text")).otherwise(F.array(
        *[F.substring(F.col("text"), F.floor(step * i).cast("int") + 1, F.lit(PIECE_CHARS)) for i in range(PIECES)]))
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("length(text) > 0") \
        .join(F.broadcast(chosen), "doc_id").select("doc_id", "label", pieces.alias("pieces"))
    rows = []
    for value in (0, 1):  # a repeated doc_id may bring many rows
        rows += found.where(F.col("label") == value).orderBy(order, F.xxhash64("pieces")).limit(sample).collect()
    texts = {v: [[p.encode("utf-8") for p in r["pieces"]] for r in rows if r["label"] == v] for v in (0, 1)}
    if min(len(t) for t in texts.values()) < 2:
        return QualityModel(b"", b"", (0.0,), (prior,))
    x, y, weight = [], [], []
    for half in (0, 1):  # each half's differences under dictionaries of the other half
        bad, good = (_dictionary([p for t in texts[v][1 - half::2] for p in t]) for v in (0, 1))
        for v, share in ((0, 1 - prior), (1, prior)):
            seen = [b"".join(t) for t in texts[v][half::2]]
            x.append(size_difference(seen, good, bad))
            y.append(np.full(len(seen), float(v)))
            weight.append(np.full(len(seen), share / len(texts[v])))
    bad, good = (_dictionary([p for t in texts[v] for p in t]) for v in (0, 1))
    return QualityModel(good, bad, *fit_curve(*map(np.concatenate, (x, y, weight))))


def _score(good: bytes, bad: bytes, knots: tuple, chances: tuple):
    def score(batches):
        for batch in batches:
            texts = [t.encode("utf-8") if t else b"" for t in batch.column("text").to_pylist()]
            p = np.interp(size_difference(texts, good, bad), knots, chances)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(p)],
                                             names=["doc_id", "held_out", "score"])
    return score


def score_quality(docs: DataFrame, model: QualityModel, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted (1
    from ``threshold`` on) per row of docs (doc_id, text).

    Whole texts are read, window by window; nothing is shuffled. Null and
    empty texts have a size difference of 0 and get the curve's value there.
    Repeated rows give repeated rows; a null doc_id is not held out; other
    columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id").alias("held_out"), "text")
    scored = rows.mapInArrow(_score(model.good, model.bad, model.knots, model.chances), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
