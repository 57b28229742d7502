"""Benchmark decontamination with a generalised suffix automaton.

The automaton is built over the words of all benchmark items (the items are
the bounded side: their size is checked before they are collected), in several
parts if they are many. Training
texts stream through it word by word while the longest matching length is
tracked. Before that, vectorised look-ups cut each text at every word, and at
every pair of neighbouring words, that no item has: there the automaton would
fall back to its root, so only the stretches in between are streamed.
"""

from __future__ import annotations

import hashlib
from array import array
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.shipping import Shipped
from quarry.llm.tokens import ALNUM, bounds, flat, row_ids, slices, words

#: The flat arrays of that many bytes of text take some 150 MB in each Python worker.
MAX_BENCHMARK_BYTES = 16 << 20
#: Words of one automaton: while it is built it takes some 0.7 KB a word.
PART_WORDS = 400_000


class SuffixAutomaton:
    """All word runs of all items. ``window`` is the length of a window; an
    item with fewer words is one window as a whole.

    vocabulary     sorted word hashes; a word's id is its place
    pairs          sorted hashes of the neighbouring words of the items
    edges, target  sorted (state, word) numbers and the states they lead to
    longest, link  length of the longest run of a state; its suffix link
    found          (state, item) numbers, sorted: items with the window-long run that the state's runs end with
    whole[state]   (length, item) of short items that the state's runs end with

    Everything that grows with the items is a flat array: some 60 bytes a word.
    """

    def __init__(self, items: list[tuple[int, np.ndarray]], window: int):
        self.window = window
        items = [(key, hashes) for key, hashes in items if len(hashes)]
        self.keys = [key for key, _ in items]
        self.vocabulary = np.unique(np.concatenate([h for _, h in items])) if items else np.zeros(0, np.uint64)
        coded = [np.searchsorted(self.vocabulary, h) for _, h in items]
        self.pairs = np.unique(np.concatenate([c[:-1] * len(self.vocabulary) + c[1:] for c in coded])) if items else np.zeros(0, np.int64)
        self.shortest = min([window, *(len(c) for c in coded)])
        built = _Builder()
        for code in coded:
            built.extend(code.tolist())
        self.longest, self.link = array("i", built.longest), array("i", built.link)
        keys = np.fromiter((state << 32 | word for state, step in enumerate(built.step) for word in step), np.int64)
        ends = np.fromiter((to for step in built.step for to in step.values()), np.int32)
        order = np.argsort(keys)
        self.edges, self.target = array("q", keys[order].tobytes()), array("i", ends[order].tobytes())
        del built
        self._mark([c.tolist() for c in coded])

    def _next(self, state: int, word: int) -> int:
        """The state after one more word, or -1."""
        key = state << 32 | word
        at = bisect_left(self.edges, key)
        return self.target[at] if at < len(self.edges) and self.edges[at] == key else -1

    def _mark(self, coded: list[list[int]]) -> None:
        found, short = array("q"), {}
        for item, code in enumerate(coded):
            state, length = 0, 0
            for word in code:  # every run of an item is in the automaton
                state, length = self._next(state, word), length + 1
                if length >= self.window:
                    found.append(self._window_state(state) << 32 | item)
            if len(code) < self.window:
                short.setdefault(state, []).append((len(code), item))
        self.found = array("q", np.unique(np.frombuffer(found, np.int64)).tobytes()) if len(found) else found
        self.whole: dict[int, list] = {}
        if short:
            for state in np.argsort(np.frombuffer(self.longest, np.int32), kind="stable").tolist():
                got = self.whole.get(self.link[state], []) + short.get(state, []) if state else short.get(0, [])
                if got:
                    self.whole[state] = got

    def _window_state(self, state: int) -> int:
        """The state that holds the window-long end of the state's runs."""
        while self.longest[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def stream(self, code: list[int], at: int, hit: np.ndarray, items: set) -> None:
        """Run words code (placed from ``at`` in their text) through the
        automaton; mark the words of every window in ``hit``, collect its items."""
        state, length, seen = 0, 0, set()
        for place, word in enumerate(code, at):
            after = self._next(state, word)
            while state and after < 0:
                state = self.link[state]
                length = self.longest[state]
                after = self._next(state, word)
            state = max(after, 0)
            length = length + 1 if state else 0
            if length >= self.window:
                hit[place - self.window + 1:place + 1] = True
                ends = self._window_state(state)
                if ends not in seen:
                    seen.add(ends)
                    for i in range(bisect_left(self.found, ends << 32), bisect_left(self.found, ends + 1 << 32)):
                        items.add(self.found[i] & 0xFFFFFFFF)
            for size, item in self.whole.get(state, ()):
                if size <= length:
                    hit[place - size + 1:place + 1] = True
                    items.add(item)


class _Builder:
    """The automaton while it grows: the edges of each state in a dictionary."""

    def __init__(self):
        self.step: list[dict] = [{}]
        self.longest, self.link = [0], [-1]

    def _state(self, longest: int, step: dict, link: int) -> int:
        self.step.append(step)
        self.longest.append(longest)
        self.link.append(link)
        return len(self.step) - 1

    def _split(self, parent: int, word: int, child: int) -> int:
        """The state for the runs of ``child`` that are one longer than ``parent``'s longest."""
        clone = self._state(self.longest[parent] + 1, dict(self.step[child]), self.link[child])
        self.link[child] = clone
        while parent >= 0 and self.step[parent].get(word) == child:
            self.step[parent][word] = clone
            parent = self.link[parent]
        return clone

    def extend(self, code: list[int]) -> None:
        last = 0
        for word in code:
            at = self.step[last].get(word)
            if at is not None:
                last = at if self.longest[at] == self.longest[last] + 1 else self._split(last, word, at)
                continue
            new, at = self._state(self.longest[last] + 1, {}, 0), last
            while at >= 0 and word not in self.step[at]:
                self.step[at][word] = new
                at = self.link[at]
            if at >= 0:
                child = self.step[at][word]
                self.link[new] = child if self.longest[child] == self.longest[at] + 1 else self._split(at, word, child)
            last = new


def build_automata(benchmark: DataFrame, window: int = 13, part_words: int = PART_WORDS) -> list[SuffixAutomaton]:
    """The automata of a benchmark (item_id, text), each over items of about
    ``part_words`` words, so that building one stays within some 300 MB; null
    and wordless texts add nothing."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > MAX_BENCHMARK_BYTES:
        raise ValueError(f"the benchmark has {size} bytes of text; the automata are for at most {MAX_BENCHMARK_BYTES}: judge it in parts")
    rows = benchmark.select(F.col("item_id").cast("string"), "text").orderBy("item_id", "text").collect()
    parts, held = [[]], 0
    for lo in range(0, len(rows), 1000):
        some = rows[lo:lo + 1000]
        hashes, _, _, counts, _ = words(pa.array([r[1] for r in some], pa.string()), ALNUM)
        at = bounds(counts)
        for r, a, b in zip(some, at[:-1], at[1:]):
            if held and held + b - a > part_words:
                parts.append([])
                held = 0
            parts[-1].append((r[0], hashes[a:b].copy()))
            held += b - a
    return [SuffixAutomaton(items, window) for items in parts]


def _judge_rows(machines: list[SuffixAutomaton], column):
    """Per row: words, hit words, items, digest of the items; spans of hit words; word offsets in bytes."""
    hashes, start, end, counts, _ = words(column, ALNUM)
    at, row = bounds(counts), row_ids(counts)
    hit = np.zeros(len(hashes), dtype=bool)
    keys: list[set] = [set() for _ in counts]
    for machine in machines if len(hashes) else ():
        if not len(machine.vocabulary):
            continue
        code = np.minimum(np.searchsorted(machine.vocabulary, hashes), len(machine.vocabulary) - 1)
        known = machine.vocabulary[code] == hashes
        joined = known[1:] & known[:-1] & (row[1:] == row[:-1])
        pair = code[:-1] * len(machine.vocabulary) + code[1:]
        joined &= machine.pairs[np.minimum(np.searchsorted(machine.pairs, pair), len(machine.pairs) - 1)] == pair if len(machine.pairs) else False
        opens = known.copy()
        opens[1:] &= ~joined
        first = np.flatnonzero(opens)
        closes = known.copy()
        closes[:-1] &= ~joined
        last = np.flatnonzero(closes) + 1
        for lo, hi in zip(first[last - first >= machine.shortest].tolist(), last[last - first >= machine.shortest].tolist()):
            items: set = set()
            machine.stream(code[lo:hi].tolist(), lo, hit, items)
            keys[int(row[lo])].update(machine.keys[i] for i in items)
    n_hit = np.add.reduceat(np.append(hit, False).astype(np.int64), at[:-1]) * (counts > 0) if len(counts) else np.zeros(0, np.int64)
    return counts, n_hit, [sorted(k) for k in keys], hit, at, start, end


def _judge(shared, with_spans: bool):
    def judge(batches):
        machines = shared.value
        for batch in slices(batches, "text"):
            counts, n_hit, keys, hit, at, start, end = _judge_rows(machines, batch.column("text"))
            columns = [batch.column("doc_id"), pa.array(counts), pa.array(n_hit), pa.array([len(k) for k in keys], pa.int64()),
                       pa.array([hashlib.sha256(",".join(k).encode()).hexdigest() for k in keys], pa.string()),
                       pa.array((n_hit > 0) & (20 * n_hit >= counts))]
            names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
            if with_spans:
                spans = []
                for lo, hi in zip(at[:-1], at[1:]):
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit[lo:hi].view(np.int8), [0]])))
                    base = [] if not len(edge) else edge.reshape(-1, 2).tolist()
                    spans.append([{"first_word": a, "last_word": b - 1} for a, b in base])
                columns += [pa.array(keys, pa.list_(pa.string())),
                            pa.array(spans, pa.list_(pa.struct([("first_word", pa.int64()), ("last_word", pa.int64())])))]
                names += ["items", "spans"]
            yield pa.RecordBatch.from_arrays(columns, names=names)
    return judge


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, with_spans: bool = False) -> DataFrame:
    """Per row of docs (doc_id, text): n_words, n_hit, n_items, items_sha256, contaminated.

    Words are runs of ASCII digits and letters (A-Z lower-cased) and non-ASCII
    characters. A window is ``window`` consecutive words of an item, or the
    whole of a shorter item; a word of a document is hit if any window covers
    it. contaminated: at least one hit and at least 5 % of the words.
    ``with_spans`` adds the items and the spans of hit words. A null or
    wordless text has zero words and is not contaminated; equal items count
    once per item_id; a null item_id is the empty string. Repeated rows give
    repeated rows; other columns of either table are ignored; an empty
    benchmark hits nothing and an empty table gives no rows.
    """
    spark = docs.sparkSession
    shared = Shipped(spark, build_automata(
        benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text"), window))
    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    if with_spans:
        schema += ", items array<string>, spans array<struct<first_word: long, last_word: long>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_judge(shared, with_spans), schema)


def _drop(shared):
    def drop(batches):
        machines = shared.value
        for batch in slices(batches, "text"):
            counts, n_hit, *_ = _judge_rows(machines, batch.column("text"))
            yield batch.filter(pa.array((n_hit == 0) | (20 * n_hit < counts)))
    return drop


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 13) -> DataFrame:
    """The rows of docs that contamination() doesn't call contaminated, with all
    their columns; null and wordless texts stay, repeated rows stay or go together."""
    shared = Shipped(docs.sparkSession, build_automata(benchmark.select("item_id", "text"), window))
    return docs.mapInArrow(_drop(shared), docs.schema)


def _cut(shared, names: list[str], max_share: float):
    def cut(batches):
        machines = shared.value
        for batch in slices(batches, "text"):
            counts, n_hit, _, hit, at, start, end = _judge_rows(machines, batch.column("text"))
            texts, keep = batch.column("text").to_pylist(), n_hit < max_share * counts
            offset = flat(batch.column("text"))[1]
            for r in np.flatnonzero((n_hit > 0) & ~keep):
                data, lo = texts[r].encode(), at[r]
                base = start[lo:at[r + 1]], end[lo:at[r + 1]]
                shift = int(offset[r])
                edge = np.flatnonzero(np.diff(np.concatenate([[0], hit[lo:at[r + 1]].view(np.int8), [0]]))).reshape(-1, 2)
                pieces, done = [], 0
                for a, b in edge.tolist():
                    pieces.append(data[done:base[0][a] - shift])
                    done = base[1][b - 1] - shift
                texts[r] = b"".join([*pieces, data[done:]]).decode()
            columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)
    return cut


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = 13, max_share: float = 0.05) -> DataFrame:
    """docs with every hit span cut out of the texts whose hit words reach
    ``max_share`` of their words; other texts, nulls and all other columns stay as
    they are; repeated rows are treated alike."""
    spark = docs.sparkSession
    shared = Shipped(spark, build_automata(benchmark.select("item_id", "text"), window))
    return docs.mapInArrow(_cut(shared, docs.columns, max_share), docs.schema)
