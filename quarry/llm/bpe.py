"""Byte-level BPE encoding and decoding.

Pre-tokenisation without regex: every codepoint gets a symbol from class
arrays (letter, digit, space, other, ... with a look-ahead of at most two
codepoints), each symbol is a transition function on the few states of the
split pattern, and the functions are composed by an associative scan over
blocks of the text. The distinct slices of a piece of the input are then
merged pair by pair, all slices of about one length at once, and the merged
ids are cached for the slices that come again.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.shipping import Shipped
from quarry.llm.tokens import binary_array, bounds, flat, ranges, run_hashes, slices

# The code points of White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# What follows an apostrophe in a contraction.
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")

# States of the pattern: in letters, in digits, in other signs, after a space
# that belongs to what follows, in white space, with one or two letters of a
# contraction to come, at the start of a slice.
IN_L, IN_N, IN_O, SPACE, BLANK, ONE, TWO, START = range(8)
# Symbols: letter, digit, other, apostrophe of a contraction with one or two
# letters, last space or other blank before a sign, blank before a blank or
# the end, start of a text.
L, N, O, A1, A2, LAST_SPACE, LAST_BLANK, MORE_BLANK, NEW = range(9)


def _transitions() -> np.ndarray:
    """next state, plus 8 if a slice starts: [symbol, state]."""
    table = np.zeros((9, 8), dtype=np.uint8)
    for symbol in range(9):
        for state in range(8):
            if symbol != NEW and state in (ONE, TWO):
                table[symbol, state] = START if state == ONE else ONE
                continue
            inside = {L: (IN_L, (IN_L, SPACE)), N: (IN_N, (IN_N, SPACE)), O: (IN_O, (IN_O, SPACE)),
                      A1: (IN_O, (IN_O, SPACE)), A2: (IN_O, (IN_O, SPACE)), LAST_SPACE: (SPACE, ()),
                      LAST_BLANK: (START, ()), MORE_BLANK: (BLANK, (BLANK,)), NEW: (START, ())}[symbol]
            if state in inside[1]:
                table[symbol, state] = inside[0]
            else:
                table[symbol, state] = {A1: ONE, A2: TWO}.get(symbol, inside[0]) + 8
    return table


def _monoid(table: np.ndarray):
    """The symbols' functions closed under composition: (composition table
    [function, symbol that follows], functions [f, state]); 0 is the identity."""
    steps = [tuple(int(x) for x in row & 7) for row in table]
    functions = list(dict.fromkeys([tuple(range(8)), *steps]))
    place = {f: i for i, f in enumerate(functions)}
    todo = list(functions)
    while todo:
        f = todo.pop()
        for g in steps:
            made = tuple(g[x] for x in f)
            if made not in place:
                place[made] = len(functions)
                functions.append(made)
                todo.append(made)
    compose = np.array([[place[tuple(g[x] for x in f)] for g in steps] for f in functions], dtype=np.uint16)
    return compose, np.array(functions, dtype=np.uint8)


TABLE = _transitions()
COMPOSE, FUNCTIONS = _monoid(TABLE)


def char_classes() -> np.ndarray:
    """uint8[0x110000]: 0 letter, 1 digit, 2 other, 5 white space (by general category)."""
    import regex
    kinds = np.full(0x110000, O, dtype=np.uint8)
    everything = "".join(chr(c) if not 0xD800 <= c < 0xE000 else " " for c in range(0x110000))
    for pattern, kind in ((r"\p{L}+", L), (r"\p{N}+", N)):
        for m in regex.finditer(pattern, everything):
            kinds[m.start():m.end()] = kind
    kinds[WHITE_SPACE] = LAST_SPACE
    return kinds


def _symbols(points: np.ndarray, first: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Symbols of the codepoints; ``first`` are the places where texts start."""
    n = len(points)
    symbol = kinds[points]
    ahead = np.zeros(n + 2, dtype=np.uint32)
    ahead[:n] = points
    blank = symbol == LAST_SPACE
    next_blank = np.ones(n, dtype=bool)
    next_blank[:-1] = blank[1:]
    ends = first[first > 0] - 1
    next_blank[ends] = True
    symbol[blank & (points != 0x20)] = LAST_BLANK
    symbol[blank & next_blank] = MORE_BLANK
    quote = np.flatnonzero(points == 0x27)
    if len(quote):
        text_end = np.append(first[1:], n)[np.searchsorted(first, quote, side="right") - 1]
        one, two = ahead[quote + 1], ahead[quote + 2]
        is_one = np.isin(one, [ord(c) for c in ONE_LETTER]) & (quote + 1 < text_end)
        is_two = np.zeros(len(quote), dtype=bool)
        for a, b in TWO_LETTERS:
            is_two |= (one == ord(a)) & (two == ord(b))
        symbol[quote[is_one]] = A1
        symbol[quote[is_two & (quote + 2 < text_end)]] = A2
    return symbol


def slice_starts(points: np.ndarray, first: np.ndarray, kinds: np.ndarray, block: int = 256) -> np.ndarray:
    """bool per codepoint: a slice of the split pattern starts here.

    The codepoints are laid out in rows of ``block``; the functions of each
    row are composed column by column (all rows at once), the rows' functions
    from row to row, and the states replayed from each row's entry state.
    """
    n = len(points)
    if not n:
        return np.zeros(0, dtype=bool)
    symbol = _symbols(points, first, kinds)
    rows = -(-n // block)
    grid = np.full(rows * block, O, dtype=np.uint8)
    grid[:n] = symbol
    fresh = np.zeros(rows * block, dtype=bool)
    fresh[first] = True
    grid, fresh = np.ascontiguousarray(grid.reshape(rows, block).T), np.ascontiguousarray(fresh.reshape(rows, block).T)
    whole = np.zeros(rows, dtype=np.uint16)
    for j in range(block):
        whole = COMPOSE[np.where(fresh[j], COMPOSE[0, NEW], whole), grid[j]]
    entry = np.empty(rows, dtype=np.uint8)
    state = START
    for r, f in enumerate(whole.tolist()):
        entry[r] = state
        state = FUNCTIONS[f, state]
    starts = np.empty((block, rows), dtype=bool)
    state = entry
    for j in range(block):
        got = TABLE[grid[j], np.where(fresh[j], START, state)]
        starts[j] = got >= 8
        state = got & 7
    return np.ascontiguousarray(starts.T).ravel()[:n]


class Ranks:
    """The vocabulary of a rank file: byte strings by id, and the pairs that merge."""

    @classmethod
    def of_file(cls, path: str) -> Ranks:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())})

    def __init__(self, ranks: dict[bytes, int]):
        self.size = max(ranks.values()) + 1
        self.strings = [b""] * self.size
        for data, rank in ranks.items():
            self.strings[rank] = data
        self.ranks = ranks
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = {(ranks[d[:i]] * self.size + ranks[d[i:]]): r for d, r in ranks.items() for i in range(1, len(d))
                 if d[:i] in ranks and d[i:] in ranks}
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], dtype=np.int64)
        lengths = np.array([len(d) for d in self.strings], dtype=np.int64)
        self.flat, self.at = np.frombuffer(b"".join(self.strings), np.uint8), bounds(lengths)
        self.kinds = char_classes()

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each merged pair; ``size`` if the pair doesn't merge. An end is -1."""
        key = np.where((left < 0) | (right < 0), -1, left * self.size + right)
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], self.size)

    def merge_grid(self, grid: np.ndarray) -> np.ndarray:
        """Merge rows of ids (-1 after the end): always the leftmost pair of least rank."""
        out = grid.copy()
        live = np.arange(len(grid))
        rank = self.pair_rank(grid[:, :-1], grid[:, 1:])
        while len(live):
            best = rank.argmin(axis=1)
            value = rank[np.arange(len(live)), best]
            go = value < self.size
            out[live[~go]] = grid[~go]
            live, grid, rank, best, value = live[go], grid[go], rank[go], best[go], value[go]
            if not len(live):
                break
            column = np.arange(grid.shape[1])
            grid[np.arange(len(live)), best] = value
            take = np.minimum(column + (column > best[:, None]), grid.shape[1] - 1)
            grid = np.take_along_axis(grid, take, axis=1)
            grid[:, -1] = -1
            take = np.minimum(column[:-1] + (column[:-1] >= best[:, None]), rank.shape[1] - 1)
            rank = np.take_along_axis(rank, take, axis=1)
            rank[:, -1] = self.size
            rows = np.arange(len(live))
            padded = np.concatenate([np.full((len(live), 1), -1), grid, np.full((len(live), 1), -1)], axis=1)
            here = padded[rows, best + 1]
            left = best > 0
            rank[rows[left], best[left] - 1] = self.pair_rank(padded[rows, best], here)[left]
            right = best < rank.shape[1]
            rank[rows[right], best[right]] = self.pair_rank(here, padded[rows, best + 2])[right]
        return out

    def merge_long(self, data: bytes) -> list[int]:
        """The same for one long slice, with a heap of its pairs."""
        ids = [int(self.of_byte[b]) for b in data]
        strings = [data[i:i + 1] for i in range(len(data))]
        after, before = [*range(1, len(ids)), -1], [-1, *range(len(ids) - 1)]
        heap = []

        def push(i):
            j = after[i]
            if i >= 0 and j >= 0 and (r := self.ranks.get(strings[i] + strings[j])) is not None:
                heapq.heappush(heap, (r, i, len(strings[i]), len(strings[j])))

        for i in range(len(ids) - 1):
            push(i)
        while heap:
            rank, i, one, two = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j < 0 or len(strings[i]) != one or len(strings[j]) != two:
                continue
            strings[i] += strings[j]
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return [x for x in ids if x >= 0]


class Encoder:
    """Encodes slices of texts; keeps the ids of the slices it has merged."""

    LIMIT = 1 << 19  # cached slices; beyond that the cache starts anew

    def __init__(self, ranks: Ranks):
        self.ranks = ranks
        self._forget()

    def _forget(self):
        self.hashes, self.at, self.ids = np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.int32)

    def _merge(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids of the slices, and how many each has."""
        parts: list = [None] * len(size)
        raw = data.tobytes()
        todo = []
        for i, (lo, n) in enumerate(zip(start.tolist(), size.tolist())):
            whole = self.ranks.ranks.get(raw[lo:lo + n])
            if whole is not None:
                parts[i] = (whole,)
            elif n > 64:
                parts[i] = self.ranks.merge_long(raw[lo:lo + n])
            else:
                todo.append(i)
        todo = np.array(todo, dtype=np.int64)
        for lo, hi in ((1, 8), (9, 16), (17, 32), (33, 64)):
            group = todo[(size[todo] >= lo) & (size[todo] <= hi)]
            for piece in np.array_split(group, -(-len(group) // 32768)) if len(group) else ():
                width = np.arange(hi)
                inside = width < size[piece][:, None]
                grid = np.where(inside, self.ranks.of_byte[data[np.minimum(start[piece][:, None] + width, len(data) - 1)]], -1)
                merged = self.ranks.merge_grid(grid)
                count = (merged >= 0).sum(axis=1)
                ids = merged[merged >= 0].tolist()
                at = bounds(count).tolist()
                for k, i in enumerate(piece.tolist()):
                    parts[i] = ids[at[k]:at[k + 1]]
        count = np.array([len(p) for p in parts], dtype=np.int64)
        return np.array([x for p in parts for x in p], dtype=np.int32), count

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """UTF-8 texts (bytes, offsets) to (ids, ids per text, end of each id's bytes within the data)."""
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        begins = offsets[:-1][np.diff(offsets) > 0]
        first = np.searchsorted(lead, begins)
        start = lead[slice_starts(points, first, self.ranks.kinds)]
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(len(offsets) - 1, np.int64), np.zeros(0, np.int64)
        end = np.append(start[1:], len(data))
        found, one, which = np.unique(run_hashes(data, start, end), return_index=True, return_inverse=True)
        place = np.minimum(np.searchsorted(self.hashes, found), max(len(self.hashes) - 1, 0))
        new = self.hashes[place] != found if len(self.hashes) else np.ones(len(found), dtype=bool)
        if new.any():
            if len(self.hashes) + new.sum() > self.LIMIT and len(self.hashes):
                self._forget()
                new[:] = True
            ids, count = self._merge(data, start[one[new]], (end - start)[one[new]])
            hashes = np.concatenate([self.hashes, found[new]])
            counts = np.concatenate([np.diff(self.at), count])
            starts = np.concatenate([self.at[:-1], bounds(count)[:-1] + len(self.ids)])
            pool = np.concatenate([self.ids, ids])
            order = np.argsort(hashes, kind="stable")
            self.hashes, self.at = hashes[order], bounds(counts[order])
            self.ids = pool[ranges(starts[order], counts[order])]
            place = np.searchsorted(self.hashes, found)
        count = np.diff(self.at)[place][which]
        ids = self.ids[ranges(self.at[place][which], count)]
        per_text = np.diff(bounds(count)[np.searchsorted(start, offsets)])
        ends = np.cumsum(np.diff(self.ranks.at)[ids])
        return ids, per_text, ends


def decode_ids(ranks: Ranks, ids: np.ndarray) -> np.ndarray:
    size = np.diff(ranks.at)[ids]
    return ranks.flat[ranges(ranks.at[ids], size)]


def _encode(shared, with_offsets: bool):
    def encode(batches):
        encoder = Encoder(shared.value)
        for batch in slices(batches, "text", 1 << 20):
            data, offsets = flat(batch.column("text"))
            ids, count, ends = encoder.encode(data, offsets)
            at = bounds(count)
            columns = [batch.column("doc_id"), binary_array(ids.astype("<u4").view(np.uint8), at * 4)]
            if with_offsets:
                ends = ends - np.repeat(offsets[:-1], count)
                columns.append(binary_array(ends.astype("<u4").view(np.uint8), at * 4))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "ends"][:len(columns)])
    return encode


def _decode(shared):
    def decode(batches):
        ranks = shared.value
        for batch in slices(batches, "ids"):
            data, offsets = flat(batch.column("ids"))
            ids = np.frombuffer(data.tobytes(), "<u4")
            size = np.diff(ranks.at)[ids]
            text = decode_ids(ranks, ids)
            at = bounds(size)[offsets // 4]
            columns = [binary_array(text, at) if n == "decoded" else batch.column(n) for n in [*batch.schema.names, "decoded"]]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "decoded"])
    return decode


def load_ranks(spark, path: str):
    """The vocabulary of a rank file on the driver, sent to the executors once (a few MB, fixed by the file)."""
    return Shipped(spark, Ranks.of_file(path))


def encode(docs: DataFrame, ranks, with_offsets: bool = False) -> DataFrame:
    """doc_id, ids per row of docs (doc_id, text): ids as little-endian unsigned
    32-bit integers, with_offsets also ``ends`` (where each id's bytes end in
    the UTF-8 text, same layout). ``ranks`` comes from load_ranks. A null or
    empty text has no ids; special tokens are ordinary text; texts of any
    length are encoded whole; repeated rows give repeated rows; other columns
    are ignored; an empty table gives no rows."""
    schema = "doc_id long, ids binary" + ", ends binary" * with_offsets
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_encode(ranks, with_offsets), schema)


def decode(encoded: DataFrame, ranks) -> DataFrame:
    """encoded with one more column ``decoded``: the bytes of the ids. Null ids decode to nothing."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema) + ", decoded binary"
    return encoded.mapInArrow(_decode(ranks), schema)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: the digests of both directions per row of docs."""
    ranks = load_ranks(docs.sparkSession, path)
    out = decode(encode(docs, ranks), ranks)
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
