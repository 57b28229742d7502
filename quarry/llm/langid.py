"""Language identification with a byte convolutional network in numpy.

Texts are normalised byte by byte (letters lower-cased, other ASCII to one
space) and cut into windows of fixed length. Filters of several widths run
over the bytes of a window, each filter's largest answer is pooled, and a
softmax layer gives the languages. As the input bytes are one-hot, a filter
is a table of byte weights; for prediction the tables of neighbouring bytes
are added up to tables of byte pairs, so a filter is one or two look-ups.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.shipping import Shipped
from quarry.llm.tokens import bounds, flat, ranges, row_ids, slices

WINDOW, FILTERS, WIDTHS = 256, 16, (2, 3, 4)
PAD = np.float32(-1000)
MAX_LANGUAGES = 500

_FOLD = np.full(256, 0x20, dtype=np.uint8)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def normalise(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case ASCII letters and the capitals of U+00C0 to U+00DE; all
    other ASCII is a space, and of a run of spaces one stays."""
    out = _FOLD[data]
    if len(out):
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][capital] += 0x20
    keep = out != 0x20
    keep[1:] |= out[:-1] != 0x20
    keep[offsets[:-1][np.diff(offsets) > 0]] = True  # rows don't depend on the row before
    places = np.concatenate([[0], np.cumsum(keep)])
    return out[keep], places[offsets]


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """uint8[windows, WINDOW + 3] with zeros after the end, row of each window, its bytes."""
    size = np.diff(offsets)
    count = -(-size // WINDOW)
    row = row_ids(count)
    place = (np.arange(len(row)) - bounds(count)[row]) * WINDOW
    length = np.minimum(size[row] - place, WINDOW)
    out = np.zeros((len(row), WINDOW + 3), dtype=np.uint8)
    column = np.arange(WINDOW)
    inside = column < length[:, None]
    out[:, :WINDOW][inside] = data[ranges(offsets[row] + place, length)]
    return out, row, length


class ByteNetwork:
    """Weights and prediction. filters[w]: float32[w, 256, FILTERS]; byte 0 pads."""

    def __init__(self, languages: list[str], seed: int = 0):
        self.languages = languages
        rng = np.random.default_rng(seed)
        self.filters = {w: (rng.standard_normal((w, 256, FILTERS)) * 0.3).astype(np.float32) for w in WIDTHS}
        self.bias = np.zeros(FILTERS * len(WIDTHS), dtype=np.float32)
        self.out = (rng.standard_normal((FILTERS * len(WIDTHS), len(languages))) * 0.1).astype(np.float32)
        self.shift = np.zeros(len(languages), dtype=np.float32)

    def _tables(self):
        if getattr(self, "pairs", None) is None:
            f = {w: x.copy() for w, x in self.filters.items()}
            for x in f.values():
                x[:, 0] = PAD
            pair = lambda a, b: (a[:, None] + b[None]).reshape(65536, FILTERS)
            self.pairs = pair(f[2][0], f[2][1]), pair(f[3][0], f[3][1]), f[3][2], pair(f[4][0], f[4][1]), pair(f[4][2], f[4][3])
        return self.pairs

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "pairs"}

    def pooled(self, grid: np.ndarray) -> np.ndarray:
        """float32[windows, all filters]: each filter's largest answer, plus bias, negative ones cut."""
        two, three, third, four, last = self._tables()
        out = np.empty((len(grid), FILTERS * len(WIDTHS)), dtype=np.float32)
        for lo in range(0, len(grid), 256):
            part = grid[lo:lo + 256].astype(np.int32)
            pair = (part[:, :-1] << 8) | part[:, 1:]
            here, ahead = pair[:, :WINDOW], pair[:, 2:WINDOW + 2]
            for k, answer in enumerate((two[here], three[here] + third[part[:, 2:WINDOW + 2]], four[here] + last[ahead])):
                half = WINDOW
                while half > 1:
                    half //= 2
                    answer = np.maximum(answer[:, :half], answer[:, half:])
                out[lo:lo + 256, k * FILTERS:(k + 1) * FILTERS] = answer[:, 0]
        return np.maximum(out + self.bias, 0)

    def probabilities(self, grid: np.ndarray) -> np.ndarray:
        logits = self.pooled(grid) @ self.out + self.shift
        logits = np.exp(logits - logits.max(axis=1, keepdims=True))
        return logits / logits.sum(axis=1, keepdims=True)

    def fit(self, grid: np.ndarray, target: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.05, seed: int = 1) -> None:
        """Adagrad on cross-entropy; a filter learns at the place of its
        largest answer. Windows are cut to random lengths, for short texts."""
        rng = np.random.default_rng(seed)
        params = [*self.filters.values(), self.bias, self.out, self.shift]
        sums = [np.full_like(p, 1e-3) for p in params]
        column = np.arange(WINDOW + 3)
        for _ in range(epochs):
            order = rng.permutation(len(grid))
            for lo in range(0, len(order), batch):
                pick = order[lo:lo + batch]
                x, y = grid[pick].astype(np.int64), target[pick]
                cut = np.where(rng.random(len(pick)) < 0.5, WINDOW, rng.integers(6, WINDOW + 1, len(pick)))
                x = np.where(column < cut[:, None], x, 0)
                best, value = [], []
                for w, f in self.filters.items():
                    answer = sum(np.where(x[:, j:j + WINDOW, None] == 0, PAD, f[j][x[:, j:j + WINDOW]]) for j in range(w))
                    at = answer.argmax(axis=1)
                    best.append(at)
                    value.append(np.take_along_axis(answer, at[:, None], axis=1)[:, 0])
                raw = np.concatenate(value, axis=1) + self.bias
                hidden = np.maximum(raw, 0)
                logits = hidden @ self.out + self.shift
                p = np.exp(logits - logits.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                p[np.arange(len(pick)), y] -= 1
                p /= len(pick)
                back = (p @ self.out.T) * (raw > 0)
                grads = []
                for k, (w, f) in enumerate(self.filters.items()):
                    g = np.zeros_like(f)
                    for j in range(w):
                        byte = np.take_along_axis(x, best[k] + j, axis=1)
                        np.add.at(g[j], (byte, np.arange(FILTERS)[None]), back[:, k * FILTERS:(k + 1) * FILTERS])
                    g[:, 0] = 0
                    grads.append(g)
                grads += [back.sum(axis=0), hidden.T @ p, p.sum(axis=0)]
                for param, total, g in zip(params, sums, grads):
                    total += g * g
                    param -= rate * g / np.sqrt(total)
        self.pairs = None


def learnable(docs: DataFrame) -> DataFrame:
    """held_out (crc32 of doc_id as text leaves 1 modulo 3) with the columns of docs."""
    return docs.withColumn("held_out", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1)


def train(docs: DataFrame, documents: int = 4000, piece: int = 2048, seed: int = 0) -> ByteNetwork | None:
    """The network, fitted on documents that aren't held out and have a lang.

    The sample is bounded: about ``documents`` documents (at most 1.5 times
    that), in equal shares of the languages, picked by a hash, and of each a
    piece of at most ``piece`` characters at a hashed place. None without any
    labelled text.
    """
    spark = docs.sparkSession
    known = learnable(docs.select("doc_id", "text", "lang")).where("not held_out and lang is not null and length(text) > 0")
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if not counts:
        return None
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    per_language = max(1, documents // len(counts))
    shares = F.broadcast(spark.createDataFrame([(k, min(1.0, 1.2 * per_language / n)) for k, n in counts.items()], "lang string, share double"))
    hashed = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1_000_003)) / 1_000_003
    place = F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.greatest(F.length("text") - piece, F.lit(1))) + 1
    rows = (known.join(shares, "lang").where(hashed < F.col("share")).orderBy(hashed, "doc_id", "lang")
            .select("lang", F.substring("text", place.cast("int"), F.lit(piece)).alias("text"))
            .limit(int(1.5 * documents)).collect())
    languages = sorted(counts)
    grid, row, length = windows(*normalise(*flat(pa.array([r["text"] for r in rows], pa.string()))))
    target = np.array([languages.index(r["lang"]) for r in rows], dtype=np.int64)
    network = ByteNetwork(languages, seed)
    if len(row) and len(languages) > 1:
        use = length >= 8
        network.fit(grid[use], target[row[use]])
    return network


def judge(column: pa.Array, network: ByteNetwork | None) -> tuple[list, np.ndarray]:
    """(language, score) of each text of a column."""
    data, offsets = flat(column)
    folded, at = normalise(data, offsets)
    letters = np.concatenate([[0], np.cumsum((folded >= 0x61) & (folded <= 0x7A))])
    has_letter = letters[at[1:]] > letters[at[:-1]]
    high = np.concatenate([[0], np.cumsum(folded >= 0x80)])
    for i in np.flatnonzero(~has_letter & (high[at[1:]] > high[at[:-1]])):
        has_letter[i] = any(map(str.isalpha, column[int(i)].as_py()))
    lang, score = ["und"] * len(column), np.zeros(len(column))
    if network is not None:
        grid, row, length = windows(folded, at)
        p = network.probabilities(grid) * length[:, None]
        total = np.zeros((len(column), len(network.languages)))
        np.add.at(total, row, p)
        total /= np.maximum(np.bincount(row, length, len(column)), 1)[:, None]
        best = total.argmax(axis=1)
        for i in np.flatnonzero(has_letter):
            lang[i] = network.languages[best[i]]
            score[i] = min(1.0, total[i, best[i]])
    return lang, score


def _predict(shared):
    def predict(batches):
        network = shared.value
        for batch in slices(batches, "text"):
            lang, score = judge(batch.column("text"), network)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()), pa.array(score)],
                                             names=["doc_id", "held_out", "lang_pred", "score"])
    return predict


def _keep(shared, min_score: float):
    def keep(batches):
        network = shared.value
        for batch in slices(batches, "text"):
            lang, score = judge(batch.column("text"), network)
            yield batch.filter(pa.array((np.array(lang) != "und") & (score >= min_score)))
    return keep


def keep_identified(docs: DataFrame, network: ByteNetwork | None, min_score: float = 0.35) -> DataFrame:
    """The rows of docs whose text has a language: those that identify() calls
    ``und`` go, and those whose best language has less than ``min_score``."""
    shared = Shipped(docs.sparkSession, network)
    return docs.mapInArrow(_keep(shared, min_score), docs.schema)


def identify(docs: DataFrame, network: ByteNetwork | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score per row of docs (doc_id, text).

    The whole text is judged, window by window; the windows' probabilities
    are averaged by their length and score is that of the best language. A
    null text or one without a letter is ``und`` with score 0, and so is all
    if there is no network. Only the text is an input. Repeated rows give
    repeated rows; other columns are ignored; an empty table gives no rows.
    """
    shared = Shipped(docs.sparkSession, network)
    return learnable(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).mapInArrow(
        _predict(shared), "doc_id long, held_out boolean, lang_pred string, score double")
