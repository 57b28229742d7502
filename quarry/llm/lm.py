"""Cross-entropy difference scoring with two n-gram models.

A target model and a background model have one vocabulary, order and
smoothing; only their counts differ. All documents are counted for the
background, those of the target (by their labels) for the target. A document's
score is the mean over its words of the target's loss less the background's.

The vocabulary is every word of the documents. Documents are filed in blocks;
a block's words and bigrams are counted before they are shuffled, added up over
all blocks by ranges of their hashes, and the sums return to the blocks, so
neither model is ever gathered in one place. Given a ``size``, the
vocabulary is that many of the most frequent words instead and every other word
is one unknown word; both models are then dense tables held by each task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.shipping import Shipped, written
from quarry.llm.tokens import ALNUM, bounds, mix, slices, words
from quarry.session import ensure_checkpoint_dir

WORDS = 2046
START = 0
STRENGTH = 100.0
FLUSH = 1 << 21
FAN_IN = 256
PARTS = 16
#: Of the whole vocabulary: bytes of text in a block, words in a key range, ids of target documents that are broadcast.
BLOCK_BYTES = 16 << 20
PART_WORDS = 3_000_000
MAX_FLAGS = 4_000_000


def _word_counts(batches):
    """(word hash, count) of pieces of about FLUSH words."""
    held, size = [], 0

    def emit():
        found, count = np.unique(np.concatenate(held), return_counts=True)
        for lo in range(0, len(found), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(found[lo:lo + (1 << 16)].view(np.int64)), pa.array(count[lo:lo + (1 << 16)])], names=["word", "n"])

    for batch in slices(batches, "text"):
        hashes = words(batch.column("text"), ALNUM)[0]
        held.append(hashes)
        size += len(hashes)
        if size >= FLUSH:
            yield from emit()
            held, size = [], 0
    if size:
        yield from emit()


def vocabulary(docs: DataFrame, size: int = WORDS) -> np.ndarray:
    """Sorted hashes of the ``size`` most frequent words of all texts (ties by hash)."""
    rows = docs.select("text").mapInArrow(_word_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")) \
        .orderBy(F.desc("n"), "word").limit(size).collect()
    return np.sort(np.array([r["word"] for r in rows], dtype=np.int64).view(np.uint64))


def _cells(column, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cell of each bigram, words per row). Ids: the place in the vocabulary,
    then unknown, then the start of a text."""
    hashes, _, _, counts, _ = words(column, ALNUM)
    unknown, start, side = len(known), len(known) + 1, len(known) + 2
    ids = np.full(len(hashes), unknown, dtype=np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        ids = np.where(known[at] == hashes, at, unknown)
    before = np.concatenate([[start], ids[:-1]]) if len(ids) else ids
    first = bounds(counts)[:-1][counts > 0]
    before[first] = start
    return before * side + ids, counts


def _bigram_counts(shared):
    def run(batches):
        known = shared.value
        side = len(known) + 2
        table = np.zeros(side * side, dtype=np.int64)
        for batch in slices(batches, "text"):
            cells, _ = _cells(batch.column("text"), known)
            table += np.bincount(cells, minlength=side * side)
        yield from _packed(table, TaskContext.get().partitionId())
    return run


def _packed(table: np.ndarray, chunk: int):
    """The cells that aren't empty, in PARTS rows."""
    edges = np.linspace(0, len(table), PARTS + 1).astype(np.int64)
    for part in range(PARTS):
        cells = np.flatnonzero(table[edges[part]:edges[part + 1]]) + edges[part]
        if len(cells):
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([chunk], pa.int64()), pa.array([cells.tobytes()], pa.binary()),
                                              pa.array([table[cells].tobytes()], pa.binary())], names=["part", "chunk", "cells", "counts"])


def _merge(table: pa.Table) -> pa.Table:
    cells = np.frombuffer(b"".join(table.column("cells").to_pylist()), np.int64)
    counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.int64)
    found, which = np.unique(cells, return_inverse=True)
    total = np.zeros(len(found), dtype=np.int64)
    np.add.at(total, which, counts)
    return pa.table({"part": table.column("part").slice(0, 1), "chunk": pa.array([table.column("chunk")[0].as_py() // FAN_IN], pa.int64()),
                     "cells": pa.array([found.tobytes()], pa.binary()), "counts": pa.array([total.tobytes()], pa.binary())})


def bigram_table(docs: DataFrame, known: np.ndarray) -> np.ndarray:
    """Counts of all bigram cells over all texts. Each task counts its own;
    the tables are merged FAN_IN at a time, so no task reads more than that."""
    spark = docs.sparkSession
    schema = "part int, chunk long, cells binary, counts binary"
    shared = spark.sparkContext.broadcast(known)
    parts = docs.select("text").mapInArrow(_bigram_counts(shared), schema).checkpoint()
    last = parts.agg(F.max("chunk")).first()[0] or 0
    while True:
        parts = parts.groupBy("part", F.floor(F.col("chunk") / FAN_IN).alias("group")).applyInArrow(_merge, schema)
        last //= FAN_IN
        if not last:
            break
        parts = parts.checkpoint()
    table = np.zeros((len(known) + 2) ** 2, dtype=np.int64)
    for row in parts.collect():  # at most one row per part, cells bounded by the vocabulary
        table[np.frombuffer(row["cells"], np.int64)] = np.frombuffer(row["counts"], np.int64)
    return table


def log_probabilities(table: np.ndarray, side: int, strength: float = STRENGTH) -> np.ndarray:
    """Natural log of p(word | word before) per cell: counts with a Dirichlet
    prior of ``strength`` on unigram probabilities, those with add-one smoothing."""
    counts = table.reshape(side, side).astype(np.float64)
    single = counts.sum(axis=0) + 1
    single[-1] = 0  # the start is no word
    single /= single.sum()
    p = (counts + strength * single) / (counts.sum(axis=1, keepdims=True) + strength)
    p[:, -1] = 1
    return np.log(p).ravel()


class Scorer:
    """The vocabulary and both models' losses per cell (nats)."""

    def __init__(self, known: np.ndarray, target: np.ndarray, background: np.ndarray):
        self.known = known
        self.target = -log_probabilities(target, len(known) + 2).astype(np.float32)
        self.background = -log_probabilities(background, len(known) + 2).astype(np.float32)


def fit(docs: DataFrame, target: DataFrame, size: int = WORDS) -> Scorer:
    """Both models: ``docs`` (text) for vocabulary and background, ``target`` (text) for the target."""
    ensure_checkpoint_dir(docs.sparkSession)
    known = vocabulary(docs, size)
    return Scorer(known, bigram_table(target, known), bigram_table(docs, known))


def _score(shared):
    def run(batches):
        scorer = shared.value
        for batch in slices(batches, "text"):
            cells, counts = _cells(batch.column("text"), scorer.known)
            row = np.repeat(np.arange(len(counts)), counts)
            some = counts > 0
            means = [np.bincount(row, loss[cells].astype(np.float64), len(counts)) / np.maximum(counts, 1) for loss in (scorer.target, scorer.background)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(counts), *(pa.array(m, mask=~some) for m in (*means, means[0] - means[1]))],
                names=["doc_id", "n_words", "target_loss", "background_loss", "score"])
    return run


def score(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """doc_id, n_words, target_loss, background_loss, score per row of docs
    (doc_id, text); score is target_loss - background_loss, in nats a word:
    the lower, the more like the target. Words are runs of ASCII letters (A-Z
    lower-cased), digits and non-ASCII characters. A null or wordless text has
    null losses and score. Without target texts the target model is uniform.
    Repeated rows give repeated rows; other columns are ignored; an empty
    table gives no rows."""
    shared = Shipped(docs.sparkSession, scorer)  # two tables of (WORDS + 2) ** 2 numbers
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _score(shared), "doc_id long, n_words long, target_loss double, background_loss double, score double")


def _squeezed(values: np.ndarray) -> bytes:
    """Whole numbers as compressed byte planes: all lowest bytes first, so that small numbers cost little."""
    raw = np.ascontiguousarray(values).ravel()
    raw = raw.view(np.uint8).reshape(len(raw), -1)
    return zstandard.ZstdCompressor(level=1, write_checksum=False).compress(np.ascontiguousarray(raw.T).tobytes())


def _opened(data: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _gaps(values: np.ndarray) -> bytes:
    """Sorted numbers by their differences."""
    return _squeezed(np.diff(values, prepend=np.uint64(0)))


def _ungapped(data: bytes) -> np.ndarray:
    return np.cumsum(_opened(data, np.uint64), dtype=np.uint64)


BLOCKS = "block long, n_words long, words binary, places binary, counts binary, good binary, doc_ids array<long>"


def _file_blocks(block_bytes: int):
    """Texts to blocks, one row each: the distinct word hashes, the place in them of every word in
    text order, words per document, whether it is of the target, and doc_ids."""
    def file(batches):
        task, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def row():
            hashes, counts, good = (np.concatenate([h[i] for h in held]) for i in range(3))
            ids = [i for h in held for i in h[3]]
            distinct, place = np.unique(hashes, return_inverse=True)
            values = [[(task << 32) + number], [len(hashes)], [_gaps(distinct)], [_squeezed(place.astype(np.uint32))],
                      [_squeezed(counts.astype(np.uint32))], [_squeezed(good)], [ids]]
            kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 4, pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)],
                                              names=["block", "n_words", "words", "places", "counts", "good", "doc_ids"])

        for batch in slices(batches, "text", 1 << 20):
            if size >= block_bytes:
                yield row()
                number, held, size = number + 1, [], 0
            hashes, _, _, counts, data = words(batch.column("text"), ALNUM)
            held.append((hashes, counts, batch.column("good").to_numpy().astype(np.uint8), batch.column("doc_id").to_pylist()))
            size += len(data)
        if held:
            yield row()
    return file


class _Block:
    """An opened block: distinct words (START first), and per word of the texts the
    places of itself and of the word before it, its document and that one's flag."""

    def __init__(self, row: dict):
        self.words = np.concatenate([np.zeros(1, np.uint64), _ungapped(row["words"])])
        self.counts = _opened(row["counts"], np.uint32).astype(np.int64)
        self.good = _opened(row["good"], np.uint8)
        self.word = _opened(row["places"], np.uint32).astype(np.int64) + 1
        self.before = np.concatenate([[0], self.word[:-1]])
        self.before[bounds(self.counts)[:-1][self.counts > 0]] = 0
        self.row = np.repeat(np.arange(len(self.counts)), self.counts)
        scattered = mix(self.words + np.uint64(0x9E3779B97F4A7C15))
        self.keys = mix(scattered[self.before] * np.uint64(0xD6E8FEB86659FD93) + scattered[self.word])

    def tallies(self, kind: str):
        """(sorted keys, counts: one column per number) of the bigrams or of the words."""
        own = self.good[self.row].astype(np.float64)
        if kind == "bigram":
            keys, which = np.unique(self.keys, return_inverse=True)
            columns = [np.bincount(which, own, len(keys)), np.bincount(which, minlength=len(keys))]
            return keys, np.stack(columns, axis=1).astype(np.int64)
        n = len(self.words)
        columns = [np.bincount(at, w, n) for at in (self.word, self.before) for w in (own, None)]
        return self.words, np.stack(columns, axis=1).astype(np.int64)  # word hashes are sorted, START is 0


def _tally(kind: str, parts: int):
    """A block's tallies cut at the borders of equal key ranges: one row per block and range."""
    def tally(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts = _Block(row).tallies(kind)
                part = ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
                cuts = bounds(np.bincount(part.astype(np.int64), minlength=parts))
                some = [(int(k), row["block"], _gaps(keys[lo:hi]), _squeezed(counts[lo:hi].astype(np.uint32)))
                        for k, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])) if hi > lo]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), (pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                                                 names=["part", "block", "keys", "counts"])
    return tally


def _add_up(table: pa.Table) -> pa.Table:
    """All blocks' tallies of one key range, added up: per block the sums for its keys, and in a row without
    a block the range's totals: distinct keys but START, and the first two columns' sums."""
    rows = table.to_pylist()
    keys = [_ungapped(r["keys"]) for r in rows]
    counts = [_opened(r["counts"], np.uint32).reshape(len(k), -1) for r, k in zip(rows, keys)]
    known, which = np.unique(np.concatenate(keys), return_inverse=True)
    flat = np.concatenate(counts).astype(np.float64)
    sums = np.stack([np.bincount(which, column, len(known)) for column in flat.T], axis=1).astype(np.int64)
    at = bounds(np.array([len(k) for k in keys], dtype=np.int64))
    part = rows[0]["part"]
    packed = [_squeezed(sums[which[lo:hi]]) for lo, hi in zip(at[:-1], at[1:])]
    total = [int((known != 0).sum()), int(sums[:, 0].sum()), int(sums[:, 1].sum())]
    return pa.table({"part": pa.array([part] * (len(rows) + 1), pa.int64()), "block": pa.array([r["block"] for r in rows] + [None], pa.int64()),
                     "sums": pa.array(packed + [None], pa.binary()), "totals": pa.array([None] * len(rows) + [total], pa.list_(pa.int64()))})


def _score_blocks(size: dict):
    def losses(block: _Block, sums: dict):
        keys, which = np.unique(block.keys, return_inverse=True)
        pairs = np.concatenate(sums["bigram"]).reshape(-1, 2)[which]
        single = np.concatenate(sums["word"]).reshape(-1, 4)
        for i, m in enumerate(("target", "background")):
            prior = (single[block.word, i] + 1) / float(size[m] + size["words"] + 1)
            yield -np.log((pairs[:, i] + STRENGTH * prior) / (single[block.before, 2 + i] + STRENGTH))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        block, sums = _Block(row), {"bigram": [], "word": []}
        for r in sorted(right.select(["kind", "part", "sums"]).to_pylist(), key=lambda r: r["part"]):
            sums[r["kind"]].append(_opened(r["sums"], np.int64))
        n = block.counts
        means = [np.zeros(len(n))] * 2
        if len(block.word):
            means = [np.bincount(block.row, loss, len(n)) / np.maximum(n, 1) for loss in losses(block, sums)]
        none = n == 0
        return pa.table([pa.array(row["doc_ids"], pa.int64()), pa.array(n), *(pa.array(m, mask=none) for m in (*means, means[0] - means[1]))],
                        names=["doc_id", "n_words", "target_loss", "background_loss", "score"])
    return run


def score_whole(docs: DataFrame, good: DataFrame, block_bytes: int = BLOCK_BYTES, part_words: int = PART_WORDS) -> DataFrame:
    """score() over the whole vocabulary: docs is the background, its rows
    whose doc_id is in ``good`` are the target. Smoothed as in
    log_probabilities(), whose unknown word has a count of zero here.

    Texts are filed in blocks of bounded size as places in the block's list of
    words. A block adds up its own bigrams and words and sends each key range's
    sorted hashes and counts as one packed row; a task per range adds up
    the blocks and returns each one the sums for its keys, in their order. So a
    frequent word or bigram is one number per block, a text is moved once (as
    places), and nothing is gathered but the totals. A block is a bounded
    number of texts, and a range holds about ``part_words`` keys."""
    spark = docs.sparkSession
    flags = good.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(1).alias("good")).distinct()
    # a few million ids fit every executor; beyond that the texts are shuffled to meet their labels
    flags = F.broadcast(flags) if flags.count() <= MAX_FLAGS else flags.hint("merge")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(flags, "doc_id", "left") \
        .select("doc_id", F.coalesce("good", F.lit(0)).alias("good"), "text")
    blocks = written(texts.mapInArrow(_file_blocks(block_bytes), BLOCKS), "lm-blocks")
    parts = max(1, -(-int(blocks.agg(F.sum("n_words")).first()[0] or 0) // part_words))
    merged = {}
    for kind in ("word", "bigram"):
        tallies = blocks.where("n_words > 0").mapInArrow(_tally(kind, parts), "part long, block long, keys binary, counts binary")
        merged[kind] = tallies.groupBy("part").applyInArrow(_add_up, "part long, block long, sums binary, totals array<long>")
    words_of = written(merged["word"], "lm-words")
    totals = words_of.where("block is null").agg(*[F.coalesce(F.sum(F.col("totals")[i]), F.lit(0)).alias(n)
                                                   for i, n in enumerate(("words", "target", "background"))]).first().asDict()
    sums = words_of.withColumn("kind", F.lit("word")).unionByName(merged["bigram"].withColumn("kind", F.lit("bigram"))).where("block is not null") \
        .select(F.col("block").alias("home"), "kind", "part", "sums")
    return blocks.groupBy("block").cogroup(sums.groupBy("home")).applyInArrow(
        _score_blocks(totals), "doc_id long, n_words long, target_loss double, background_loss double, score double")


def score_by_quality(docs: DataFrame, labels: DataFrame, size: int | None = None) -> DataFrame:
    """score() with the documents that labels (doc_id, quality) gives quality 1
    as the target, over every word of docs or the ``size`` most frequent ones."""
    # a shuffle join whatever the labels' size: texts meet labels that grow with them
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id")
    if size is None:
        return score_whole(docs, good)
    return score(docs, fit(docs, docs.join(good.hint("merge"), "doc_id", "left_semi"), size))
