"""Substring dedup with compact windows.

A token is a run of five words. For a hash function, a compact window
(l, c, r) of a text stands for all its subsequences that start in l..c and
end in c..r: their min-hash is that of token c. The windows that hold a
subsequence of at least the wanted length are the upper nodes of the
Cartesian tree over the token hashes. Sliding minima find their centres, all
of them at once; a stack pass over these few links them into the tree.

Windows with the same min-hash meet. Windows of one group whose tokens around
the centre (its core, as far as a passage of the least length can reach) are
equal are a star around the first document that has them; the first ones of up to
FEW cores are compared with each other. More cores under one key are a crowd: all
of it is settled on the tokens, in two ways. Every run of the least length in one
function's crowds meets the first document that has the same run, so no exact
repeat is lost and a passage that thousands of documents share makes a few links
for each. And each different core of a crowd is compared with all earlier ones that
have enough tokens in common, whatever these share with others, until passages
hold all of its tokens that another core could hold, too; in a large crowd first in
blocks, and then what is open yet with the blocks of all. The colliding windows of two
documents are joined where their intervals overlap, over all hash functions; one
function makes a candidate, which is verified on the tokens themselves.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from quarry.llm.shipping import Shipped, written
from quarry.llm.tokens import NOT_SPACE, _powers, binary_array, bounds, mix, ranges, row_ids, seeds, shingles, slices, words
from quarry.session import ensure_checkpoint_dir

K = 5
FUNCTIONS = 4
FLUSH = 1 << 18
#: Cores of one key that are all paired at once; the key of more is a crowd's.
FEW = 4
#: Different cores of a crowd that are compared at once, tasks that those of a larger crowd are dealt over
#: first, and blocks from which it pays to count their tokens before the blocks meet.
BLOCK, SALTS, WIDE = 768, 16, 1
#: Blocks of a crowd for each part in which its tokens are counted: a part has as many tokens as these blocks.
PART_BLOCKS = 16
#: Of a crowd's core: earlier ones that it meets first, those with most tokens in common, and then each time; and cores for which these are looked up at once.
NEAREST, FURTHER, TOGETHER = 8, 32, 64
#: Cores, and those of the last crowd among them, from which it pays to settle their crowds.
SETTLED = 256
#: Bits of a map of crowds' keys for each key, and its least and largest size (powers of two): beyond the largest some windows are looked at in vain.
MAP_BITS, MAP_LEAST, MAP_MOST, MAP_PART = 64, 20, 28, 19
#: Targets that one copy of a source's stretch is compared with.
TARGETS = 2000
#: Of a token's hash, when two stretches or the cores of a crowd are compared: a crowd of a million tokens has one by chance once in 4,000.
TOKEN_BYTES = 4


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over x[i:i + width] for each i that has them all."""
    have = 1
    while 2 * have <= width:
        x = pick(x[:-have], x[have:])
        have *= 2
    rest = width - have
    return pick(x[:len(x) - rest], x[rest:]) if rest else x


def window_centres(values: np.ndarray, counts: np.ndarray, width: int) -> np.ndarray:
    """Places whose value is the least of at least one run of ``width`` places of their row."""
    n = len(values)
    if n < width:
        return np.zeros(0, dtype=np.int64)
    least = _sliding(values, width, np.minimum)
    ends = np.repeat(np.cumsum(counts), counts)[:len(least)]
    least = np.where(np.arange(len(least)) + width <= ends, least, np.uint64(0))  # not over the end of a row
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    return np.flatnonzero((_sliding(padded, width, np.maximum) == values) & (values > 0))


def compact_windows(values: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, l, c, r) of the compact windows that hold a run of ``width``; l, c
    and r count within the row. A run with equal least values is in the window of
    the first one of them, as its copy in another text is."""
    at = bounds(counts)
    centre = window_centres(values, counts, width)
    row = np.searchsorted(at, centre, side="right") - 1
    if not len(centre):
        return row, centre, centre, centre
    # the next centres with an equal or smaller value to the left, a smaller one to the right: zeros stand between the rows
    rank = np.cumsum(_first_of(row)) + np.arange(len(row))
    value = np.zeros(rank[-1] + 2, dtype=np.uint64)
    value[rank] = values[centre]
    left, right = np.arange(len(value)) - 1, np.arange(len(value)) + 1
    for link, larger in ((left, np.greater), (right, np.greater_equal)):
        todo = rank
        while len(todo := todo[larger(value[link[todo]], value[todo])]):
            link[todo] = link[link[todo]]
    place = np.zeros(len(value), dtype=np.int64)
    place[rank] = centre
    left, right = left[rank], right[rank]
    low = np.where(value[left] > 0, place[left] + 1, at[row])
    high = np.where(value[right] > 0, place[right] - 1, at[row + 1] - 1)
    keep = high - low + 1 >= width
    base = at[row]
    return row[keep], (low - base)[keep], (centre - base)[keep], (high - base)[keep]


def _sums(tokens: np.ndarray) -> np.ndarray:
    """Prefix polynomial sums: of them, _span_hashes makes the hash of any run."""
    sums = np.zeros(len(tokens) + 1, dtype=np.uint64)
    np.cumsum(mix(tokens) * _powers(len(tokens) + 1)[0][:len(tokens)], out=sums[1:])
    return sums


def _span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[end] - sums[start]) * _powers(len(sums))[1][start] + (end - start).astype(np.uint64))


def core_hashes(sums: np.ndarray, start: np.ndarray, centre: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 32-bit hash of the tokens from start to end and the centre's place among them."""
    both = mix(_span_hashes(sums, start, end) + (centre - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (both >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _first_of(*columns) -> np.ndarray:
    """bool per row of sorted columns: the first one of its values."""
    out = np.zeros(len(columns[0]), dtype=bool)
    out[:1] = True
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def _starred(key, core, doc, span):
    """Rows of one piece: windows under their keys, but of those with one key and
    core only the first document's. Each other one makes a group of two with it,
    under a key of its own."""
    order = np.lexsort((span, doc, core, key))
    key, core, doc, span = key[order], core[order], doc[order], span[order]
    lead = _first_of(key, core)
    of_core = np.maximum.accumulate(np.where(lead, np.arange(len(key)), 0))
    one, two = np.flatnonzero(~lead), of_core[~lead]
    pairs = doc[one] != doc[two]
    one, two = one[pairs], two[pairs]
    own = mix(key[one] ^ mix(doc[one].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + span[one].astype(np.uint64))
              + mix(doc[two].view(np.uint64) + span[two].astype(np.uint64)))
    take = np.concatenate([np.flatnonzero(lead), one, two])
    return np.concatenate([key[lead], own, own]), core[take], doc[take], span[take]


def _tokens_of(batch) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of the texts and their number in each."""
    hashes, _, _, counts, _ = words(batch.column("text"), NOT_SPACE)
    return _long_rows(hashes, counts)


def without_repeats(tokens: np.ndarray, sums: np.ndarray, base: np.ndarray, low: np.ndarray, centre: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of the windows that stay, their low) of sorted windows; base: where their rows begin
    among the tokens. Where equal least tokens come again and again with the same tokens between, at
    most width / 2 apart, a run that begins in the middle has the same set of tokens as the longer one
    from the first of them on. So the windows of the middle ones are one with the last one's, whose core
    holds each shortest run that ends beyond the repeats; one that does not is like that of the first
    ones, which stay."""
    at, first = base + centre, base + low
    prior = np.minimum(np.searchsorted(at, first - 1), max(len(at) - 1, 0))
    tie = np.flatnonzero((low > 0) & (at[prior] == first - 1) & (tokens[first - 1] == tokens[at]))
    prior = prior[tie]
    gap, size = np.zeros(len(at), dtype=np.uint64), np.zeros(len(at), dtype=np.int64)
    gap[tie], size[tie] = _span_hashes(sums, at[prior], at[tie]), at[tie] - at[prior]
    again = (size[tie] == size[prior]) & (gap[tie] == gap[prior])  # the gap before the prior one is this one's
    follows = np.zeros(len(at), dtype=bool)
    follows[tie[again]] = True
    middle = np.zeros(len(at), dtype=bool)
    inner = prior[again & (2 * size[tie] <= width)]
    middle[inner] = follows[inner] | (size[inner] == 1)
    start = np.arange(len(at))  # the first of the windows that are one
    start[tie] = np.where(middle[prior], prior, tie)
    while not np.array_equal(start, further := start[start]):
        start = further
    stay = np.flatnonzero(~middle)
    return stay, low[start[stay]]


def _windows_of(tokens: np.ndarray, per_row: np.ndarray, width: int):
    """For each function: key, row, low and high within the row, and the places among all tokens of
    centre, core's start and core's end of the windows."""
    salt, ends, sums = seeds(FUNCTIONS, 41), bounds(per_row), _sums(tokens)
    for k in range(FUNCTIONS):
        values = mix(tokens ^ salt[k])
        row, low, centre, high = compact_windows(values, per_row, width)
        stay, low = without_repeats(tokens, sums, ends[row], low, centre, width)
        row, centre, high = row[stay], centre[stay], high[stay]
        at = ends[row] + centre
        key = values[at] & ~np.uint64(FUNCTIONS - 1) | np.uint64(k)
        yield key, row, low, high, at, np.maximum(at - width + 1, ends[row]), np.minimum(at + width, ends[row + 1])


def _windows(width: int):
    def emit(parts):
        key, core, doc, span = _starred(*(np.concatenate(p) for p in zip(*parts)))
        for lo in range(0, len(key), 1 << 16):
            hi = lo + (1 << 16)
            yield pa.RecordBatch.from_arrays([pa.array(key[lo:hi].view(np.int64)), pa.array(core[lo:hi]), pa.array(doc[lo:hi]), pa.array(span[lo:hi])],
                                             names=["key", "core", "doc", "span"])

    def run(batches):
        parts, held = [], 0
        for batch in slices(batches, "text"):
            tokens, per_row = _tokens_of(batch)
            ids, sums = batch.column("doc").to_numpy(), _sums(tokens)
            for key, row, low, high, at, start, end in _windows_of(tokens, per_row, width):
                parts.append((key, core_hashes(sums, start, at, end), ids[row], (low << 32) | high))
                held += len(row)
            if held >= FLUSH:
                yield from emit(parts)
                parts, held = [], 0
        if parts:
            yield from emit(parts)
    return run


def _map_place(bits: int):
    """A key's place in a map of 2 ** bits bits: the bits above the function's."""
    return F.shiftrightunsigned("key", 2).bitwiseAND(F.lit((1 << bits) - 1))


def _map_parts(batches):
    """Bits of a map, packed by part of it (the table is dealt by part)."""
    parts = {}
    for batch in batches:
        place, large = batch.column("place").to_numpy(), batch.column("large").to_numpy(zero_copy_only=False)
        for kind in (False, True):
            own = place[large] if kind else place
            for p in np.unique(own >> MAP_PART).tolist():
                parts.setdefault((p, kind), np.zeros(1 << MAP_PART, bool))[own[own >> MAP_PART == p] & ((1 << MAP_PART) - 1)] = True
    for (p, kind), bits in parts.items():
        yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([kind]), pa.array([zlib.compress(np.packbits(bits).tobytes(), 1)])], names=["part", "large", "bits"])


def _crowd_map(crowds: DataFrame, bits: int) -> dict:
    """{large: bits} of the keys of crowds, 2 ** bits of them: a bounded map, whatever the number of keys."""
    rows = crowds.select(_map_place(bits).alias("place"), "large").withColumn("part", F.shiftright("place", MAP_PART)) \
        .repartition(8, "part").mapInArrow(_map_parts, "part long, large boolean, bits binary").collect()
    out = {kind: np.zeros(1 << max(bits - 3, MAP_PART - 3), np.uint8) for kind in (False, True)}
    for r in rows:
        out[r.large][r.part * (1 << MAP_PART - 3):(r.part + 1) * (1 << MAP_PART - 3)] |= np.frombuffer(zlib.decompress(r.bits), np.uint8)
    return out


def _crowd_rows(width: int, bits: int, shipped: Shipped):
    """Windows whose key is in the map, with the 32-bit tokens of their cores
    (salt 0, or 1 to SALTS in a large crowd), and the runs of ``width``
    tokens that the first function's windows among them stand for (salt -1)."""
    def run(batches):
        known = shipped.value
        has = lambda kind, key: (known[kind][(place := (key >> np.uint64(2) & np.uint64((1 << bits) - 1)).astype(np.int64)) >> 3] >> (7 - (place & 7)) & 1).astype(bool)
        for batch in slices(batches, "text"):
            tokens, per_row = _tokens_of(batch)
            small = np.ascontiguousarray(tokens.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :TOKEN_BYTES]
            ids, ends, sums = batch.column("doc").to_numpy(), bounds(per_row), _sums(tokens)
            for k, found in enumerate(_windows_of(tokens, per_row, width)):
                key, row, low, high, at, start, end = (x[has(False, found[0])] for x in found)
                doc, span = ids[row], (low << 32) | high
                salt = np.where(has(True, key), 1 + mix(doc.view(np.uint64)) % np.uint64(SALTS), np.uint64(0)).astype(np.int32)
                for lo in range(0, len(key), 1 << 13):
                    cut = slice(lo, lo + (1 << 13))
                    size = end[cut] - start[cut]
                    part = binary_array(small[ranges(start[cut], size)].ravel(), bounds(size * TOKEN_BYTES))
                    yield pa.RecordBatch.from_arrays([pa.array(key[cut].view(np.int64)), pa.array(salt[cut]), pa.array(doc[cut]), pa.array(span[cut]), part], names=CROWD)
                if k == 0 and len(key):
                    first, last = np.maximum(low + ends[row], at - width + 1), np.minimum(at, high + ends[row] - width + 1)
                    size = last - first + 1
                    begin, of = ranges(first, size), row_ids(size)
                    run_key = _span_hashes(sums, begin, begin + width).view(np.int64)
                    for lo in range(0, len(begin), 1 << 16):
                        own = of[lo:lo + (1 << 16)]
                        yield pa.RecordBatch.from_arrays([pa.array(run_key[lo:lo + (1 << 16)]), pa.array(np.full(len(own), -1, np.int32)), pa.array(doc[own]), pa.array(span[own]),
                                                          pa.nulls(len(own), pa.binary())], names=CROWD)
    return run


CROWD = ["key", "salt", "doc", "span", "tokens"]
CROWD_TYPE = "key long, salt int, doc long, span long, tokens binary"


def _common(sizes: np.ndarray, every: np.ndarray, row: np.ndarray, token: np.ndarray, wanted: np.ndarray, crowd: np.ndarray, width: int, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of cores with these sizes, all their tokens, and the different ones (row, token, sorted;
    crowd << 32 is in a token): places (rising) of those that may have a passage in common with
    another one of their crowd; which of them are wanted, and the first ones of these ones' crowds;
    the tokens that they have in common with each from that one on, 0 if too few for a passage; and
    the tokens as a table of bits and as its columns (0: in no other core). Two passages have ``similarity`` of the tokens of the larger
    one in common, and a passage of a core has ``width`` tokens less those that come
    again."""
    need = needed(sizes, np.bincount(row, minlength=len(sizes)), width, similarity)
    known, column = np.unique(token, return_inverse=True)
    while len(row):
        often = np.bincount(column, minlength=len(known))[column] > 1
        keep = often & (np.bincount(row[often], minlength=len(sizes)) >= need)[row]
        if keep.all():
            break
        row, column = row[keep], column[keep]
    left, row = np.unique(row, return_inverse=True)
    used = np.zeros(len(known), dtype=bool)
    used[column] = True
    known, column = known[used], (np.cumsum(used) - 1)[column]
    own = np.flatnonzero(wanted[left])
    if not len(own):
        return left, own, own, np.zeros((0, 0)), np.zeros((0, 0), dtype=bool), []
    begin = np.flatnonzero(_first_of(crowd[left]))  # the crowds' first cores, and their first tokens
    base, some = np.repeat(begin, np.diff(np.append(begin, len(left)))), np.append(begin, len(left)).tolist()
    of = known >> np.uint64(32)
    starts = np.searchsorted(of, np.append(crowd[left[begin]].astype(np.uint64), of[-1] + np.uint64(1)))
    place = np.arange(len(known)) - np.repeat(starts[:-1], np.diff(starts)) + 1
    bits = np.zeros((len(left), int(place.max()) + 1), dtype=bool)
    bits[row, place[column]] = True
    shared = np.zeros((len(own), int(np.diff(some).max())), dtype=np.float32)
    at = np.searchsorted(own, some).tolist()
    for i, size in enumerate(np.diff(starts).tolist()):
        mine = slice(at[i], at[i + 1])
        for lo in range(1, size + 1 if at[i] < at[i + 1] else 0, 4096):
            part = bits[some[i]:some[i + 1], lo:min(lo + 4096, size + 1)].astype(np.float32)
            shared[mine, :some[i + 1] - some[i]] += part[own[mine] - some[i]] @ part.T
    other = np.minimum(base[own][:, None] + np.arange(shared.shape[1]), len(left) - 1)
    shared[shared < np.maximum(need[left][own][:, None], need[left][other])] = 0
    at = np.minimum(np.searchsorted(known, every), len(known) - 1)
    at, ends = np.where(known[at] == every, place[at], 0), bounds(sizes)
    return left, own, base[own], shared, bits, [at[lo:hi] for lo, hi in zip(ends[left].tolist(), ends[left + 1].tolist())]


def needed(sizes: np.ndarray, distinct: np.ndarray, width: int, similarity: float) -> np.ndarray:
    """Different tokens that a core has at least in common with one that shares a passage with it."""
    return np.ceil(similarity * np.maximum(width - (sizes - distinct), 1) - 1e-9).astype(np.int64)


def _longest_segments(hit: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) for each row of hits: the first one of the longest segments of dense_segments, (0, -1) without a hit."""
    n, size = hit.shape
    edge = np.zeros((n, size + 2), dtype=np.int8)
    edge[:, 1:-1] = hit
    edge = np.diff(edge, axis=1)
    above = np.zeros((n, size + 1))  # hits less the wanted ones
    np.cumsum(hit, axis=1, out=above[:, 1:])
    above -= share * np.arange(size + 1)
    least = np.minimum.accumulate(np.where(edge == 1, above, np.inf), axis=1)
    row, end = np.nonzero(edge == -1)
    most = above[row, end] + 1e-9
    low, high = np.zeros(len(end), dtype=np.int64), end.astype(np.int64)
    for _ in range(size.bit_length()):  # the first run from which the share is met
        middle = (low + high) >> 1
        met = least[row, middle] <= most
        low, high = np.where(met | (low >= high), low, middle + 1), np.where(met, middle, high)
    out = np.zeros((2, n), dtype=np.int64)
    out[1] = -1
    if len(row):
        lead = np.flatnonzero(_first_of(row))
        length = end - low
        longest = np.flatnonzero(length == np.repeat(np.maximum.reduceat(length, lead), np.diff(np.append(lead, len(row)))))
        longest = longest[_first_of(row[longest])]
        out[:, row[longest]] = low[longest], end[longest] - 1
    return out[0], out[1]


def _coverable(hit: np.ndarray, share: float, width: int) -> np.ndarray:
    """bool per row of hits and token: if a run of at least ``width`` that begins and ends with a hit
    and has enough of them may hold it (no token of a row without such a run). Columns past the end
    of a row are no hits. In less than twice the width there is one segment at most, as dense_segments
    has it, and no other token is held."""
    size = hit.shape[1]
    if size < width or not len(hit):
        return np.zeros(hit.shape, dtype=bool)
    if size < 2 * width:
        first, last = _longest_segments(hit, share)
        place = np.arange(size)
        return (last - first + 1 >= width)[:, None] & (place >= first[:, None]) & (place <= last[:, None])
    above = np.zeros((len(hit), size + 1), dtype=np.float32)  # hits less the wanted ones
    np.cumsum(hit - np.float32(share), axis=1, out=above[:, 1:])
    least = np.minimum.accumulate(above, axis=1)
    most = np.maximum.accumulate(above[:, ::-1], axis=1)[:, ::-1]
    holds = (above[:, width:] - least[:, :-width]).max(axis=1) > -1e-3
    place, first, last = np.arange(size), hit.argmax(axis=1)[:, None], size - 1 - hit[:, ::-1].argmax(axis=1)[:, None]
    return holds[:, None] & (most[:, 1:] - least[:, :-1] > -1e-3) & (place >= first) & (place <= last)


def _core(tokens: np.ndarray) -> tuple[list, dict]:
    """A core's tokens as a list, and the first place of each."""
    listed = tokens.tolist()
    return listed, dict(zip(reversed(listed), range(len(listed) - 1, -1, -1)))


def _core_segments(hit: list, lo: int, hi: int, share: float, width: int) -> list[tuple[int, int]]:
    """dense_segments of hit[lo:hi]: mostly one, from the first hit to the last one."""
    while lo < hi and not hit[lo]:
        lo += 1
    while lo < hi and not hit[hi - 1]:
        hi -= 1
    if hi - lo < width:
        return []
    if sum(hit[lo:hi]) - share * (hi - lo) >= -1e-9:
        return [(lo, hi - 1)]
    return [(lo + a, lo + b) for a, b in dense_segments(np.array(hit[lo:hi], dtype=bool), share, width)]


def core_passages(source: tuple[list, dict], target: tuple[list, dict], width: int, similarity: float, segment: tuple[int, int] | None = None) -> list[tuple[int, int]]:
    """(first, last) of verified_passages, for two cores as _core gives them: so few tokens are
    compared sooner as sets than as arrays. segment: the only dense one, if that is known."""
    (tokens, places), goal = source, target[0]
    at = list(map(places.get, goal))
    hit = [x is not None for x in at]
    share = 2 * similarity / (1 + similarity)
    if sum(hit) < share * width - 1e-9:
        return []
    out, todo = [], [(0, len(goal), 0)]
    while todo:
        lo, hi, level = todo.pop()
        for first, last in [segment] if segment and not level else _core_segments(hit, lo, hi, (share, (1 + share) / 2, 1.0)[level], width):
            spots = [x for x in at[first:last + 1] if x is not None]
            a, b = set(goal[first:last + 1]), set(tokens[min(spots):max(spots) + 1])
            common = len(a & b)
            if common / (len(a) + len(b) - common) >= similarity:  # mostly so: all that is hit
                out.append((first, last))
                continue
            shift = [x - i for i, x in enumerate(at[first:last + 1]) if x is not None]
            middle, half = sorted(shift), len(shift) // 2
            median = middle[half] if len(middle) % 2 else int((middle[half - 1] + middle[half]) / 2)
            for start, slack in ((median, width), (shift[0], 0), (shift[-1], 0)):
                near = [x for x in spots if start - slack <= x <= start + last - first + slack]
                if near:
                    low, high = min(near), max(near)
                    if slack == 0:
                        low, high = max(start, 0), min(start + last - first, len(tokens) - 1)
                    b = set(tokens[low:high + 1])
                    common = len(a & b)
                    if common / (len(a) + len(b) - common) >= similarity:
                        out.append((first, last))
                        break
            else:
                if level < 2:  # a part of it may do
                    todo.append((first, last + 1, level + 1))
    return sorted(out)


def _settled(rows: list[tuple], crowd: np.ndarray, sources: np.ndarray, opens: list, width: int, similarity: float) -> list[tuple[int, int]]:
    """rows: (doc, span, tokens, ...), sorted, of one crowd after another. (earlier, later) of those that share
    a passage: each row with ``opens``, bool per token, against all sources of its crowd before it,
    whatever these share with others, as long as a passage may hold a token that is
    open yet; what it holds is open no more."""
    cores, docs = [_tokens(r[2]) for r in rows], np.array([r[0] for r in rows])
    sizes = np.array([len(c) for c in cores], dtype=np.int64)
    of, every, own = row_ids(sizes), np.concatenate(cores).astype(np.uint64), crowd.astype(np.uint64) << np.uint64(32)
    both = np.unique(of.astype(np.uint64) << np.uint64(32) | every)
    of_row, every = (both >> np.uint64(32)).astype(np.int64), own[of] | every
    token = own[of_row] | both & np.uint64(0xFFFFFFFF)
    # what a core's passages hold is one run (two do not fit side by side): one that goes on ends with an open token that the other core has, too
    known, often = np.unique(token[sources[of_row]], return_counts=True)
    open_ = np.concatenate([o if o is not None else np.zeros(n, dtype=bool) for o, n in zip(opens, sizes.tolist())])
    of, free = of[open_], every[open_]
    at = np.minimum(np.searchsorted(known, free), max(len(known) - 1, 0))
    again = (known[at] == free) & (often[at] > sources[of]) if len(known) else np.zeros(len(free), dtype=bool)
    wanted = np.bincount(of[again], minlength=len(rows)) > 0
    if not wanted.any():
        return []
    places, own, base, shared, bits, columns = _common(sizes, every, of_row, token, wanted, crowd, width, similarity)
    links, share, ready = [], 2 * similarity / (1 + similarity), {}
    core = lambda i: ready[i] if i in ready else ready.setdefault(i, _core(cores[i]))
    is_source, doc = sources[places], docs[places]
    for lo in range(0, len(own), TOGETHER):
        some, begin = own[lo:lo + TOGETHER], base[lo:lo + TOGETHER, None]
        size, row = max(len(columns[j]) for j in some.tolist()), shared[lo:lo + TOGETHER, :int((some - begin[:, 0]).max())]
        other = np.minimum(begin + np.arange(row.shape[1]), len(places) - 1)
        may = (row > 0) & is_source[other] & (doc[other] != doc[some][:, None]) & (other < some[:, None])
        order = begin + np.argsort(np.where(may, -row, 1).astype(np.int16 if width < 1 << 14 else np.int64), axis=1, kind="stable")
        near = [x[:n] for x, n in zip(order, may.sum(axis=1).tolist())]
        wide, open_wide = np.zeros((len(some), size), dtype=np.int64), np.zeros((len(some), size), dtype=bool)
        for i, j in enumerate(some.tolist()):
            wide[i, :len(columns[j])] = columns[j]
            open_wide[i, :len(columns[j])] = opens[places[j]]
        going, most = list(range(len(some))), NEAREST
        while going:
            # the next ones that each of these targets meets, all at once: which do not depend on what is open
            first = [near[i][:most] for i in going]
            at = bounds(np.array([len(f) for f in first], dtype=np.int64))
            met, of = np.concatenate(first), np.repeat(going, np.diff(at))
            cover = _coverable(bits[met[:, None], wide[of]], share, width)
            useful = np.flatnonzero((cover & open_wide[of]).any(axis=1))
            head, use = cover[useful].argmax(axis=1).tolist(), useful.tolist()
            tail = (cover[useful].sum(axis=1) + head - 1).tolist()
            to, on = np.searchsorted(useful, at).tolist(), []
            for n, i in enumerate(going):
                j = int(some[i])
                b = int(places[j])
                open_, closed = opens[b], False
                for x in range(to[n], to[n + 1]):
                    if closed and not open_[head[x]:tail[x] + 1].any():
                        continue
                    a = int(places[met[use[x]]])
                    found = core_passages(core(a), core(b), width, similarity, (head[x], tail[x]))
                    if any(open_[begin:end + 1].any() for begin, end in found):
                        links.append((a, b))
                    for begin, end in found:
                        open_[begin:end + 1] = False
                    closed |= bool(found)
                near[i] = near[i][most:]
                if len(near[i]):
                    still = columns[j][open_]
                    still = still[still > 0]
                    near[i] = near[i][bits[near[i][:, None], still].any(axis=1)]
                    if len(near[i]):
                        open_wide[i, :len(open_)] = open_
                        on.append(i)
            going, most = on, FURTHER
    return links


def _links(pairs: list[tuple]) -> list:
    """Columns src, dst, s_span and d_span of pairs of windows (doc, span)."""
    pairs = [(a, b) if a < b else (b, a) for a, b in pairs]
    return [pa.array([p[i][f] for p in pairs], pa.int64()) for f in (0, 1) for i in (0, 1)]


def _meet(width: int, similarity: float):
    """Rows of _crowd_rows sorted by salt, key, doc and span: links (src, dst, s_span, d_span), and the
    cores of a large crowd's part (key, src and s_span its window's, tokens, and which of them are open)."""
    def settle(crowds):
        rows, of = [r for _, own in crowds for r in own], np.repeat(np.arange(len(crowds)), [len(own) for _, own in crowds])
        opens = [np.ones(len(r[2]) // TOKEN_BYTES, dtype=bool) for r in rows]
        links = _settled(rows, of, np.ones(len(rows), dtype=bool), opens, width, similarity)
        own = [(crowds[i][0][0], r, np.packbits(o).tobytes() if o.any() else None) for i, r, o in zip(of.tolist(), rows, opens) if crowds[i][0][1]]
        if not links and not own:
            return
        columns = _links([(rows[a][:2], rows[b][:2]) for a, b in links])
        none = pa.nulls(len(own), pa.int64())
        extra = [pa.array([r[0] for _, r, _ in own], pa.int64()), none, pa.array([r[1] for _, r, _ in own], pa.int64()), none]
        yield pa.RecordBatch.from_arrays([pa.concat_arrays([c, e]) for c, e in zip(columns, extra)] + [
            pa.array([None] * len(links) + [k for k, _, _ in own], pa.int64()), pa.array([None] * len(links) + [r[2] for _, r, _ in own], pa.binary()),
            pa.array([None] * len(links) + [o for _, _, o in own], pa.binary())], names=MET)

    def run(batches):
        now, rows, seen, run_key, first = None, [], set(), None, None
        crowds, held = [], 0  # small ones are settled together
        for batch in batches:
            salts = batch.column("salt").to_numpy()
            runs = int(np.searchsorted(salts, 0))
            if runs:
                key, doc, span = (batch.column(c).to_numpy()[:runs] for c in ("key", "doc", "span"))
                lead = _first_of(key)
                lead[0] = run_key is None or key[0] != run_key
                of = np.maximum.accumulate(np.where(lead, np.arange(runs), -1))
                src = np.where(of >= 0, doc[of], first[0] if first else 0)
                s_span = np.where(of >= 0, span[of], first[1] if first else 0)
                run_key, first = key[-1], (int(src[-1]), int(s_span[-1]))
                pair = np.stack([src, doc, s_span, span])[:, src != doc]
                if pair.shape[1]:
                    yield pa.RecordBatch.from_arrays([*(pa.array(p) for p in pair), pa.nulls(pair.shape[1], pa.int64()),
                                                      pa.nulls(pair.shape[1], pa.binary()), pa.nulls(pair.shape[1], pa.binary())], names=MET)
            for key, salt, doc, span, tokens in zip(*(batch.slice(runs).column(c).to_pylist() for c in CROWD)):
                if now != (key, salt) or salt and len(rows) >= BLOCK:
                    if len(rows) > 1 or rows and now[1]:
                        crowds.append((now, rows))
                        held += len(rows)
                    if held >= SETTLED:
                        yield from settle(crowds)
                        crowds, held = [], 0
                    now, rows, seen = (key, salt), [], set()
                if tokens not in seen:  # a copy of the core has its link already
                    seen.add(tokens)
                    rows.append((doc, span, tokens))
        if len(rows) > 1 or rows and now[1]:
            crowds.append((now, rows))
        if crowds:
            yield from settle(crowds)
    return run


MET = ["src", "dst", "s_span", "d_span", "key", "tokens", "open"]
LINK_TYPE = "src long, dst long, s_span long, d_span long"
MET_TYPE = LINK_TYPE + ", key long, tokens binary, open binary"


def _core_parts(width: int, similarity: float):
    """The different tokens of each core dealt over its crowd's parts, which of them are open, and how many it must share."""
    def run(batches):
        for batch in batches:
            full = [_tokens(t) for t in batch.column("tokens").to_pylist()]
            cores = [np.unique(c) for c in full]
            opens = [np.isin(u, c[np.unpackbits(np.frombuffer(o, np.uint8), count=len(c)).astype(bool)]) if o else np.zeros(len(u), dtype=bool)
                     for u, c, o in zip(cores, full, batch.column("open").to_pylist())]
            size = np.array([len(c) for c in cores], dtype=np.int64)
            need = needed(np.array([len(c) for c in full], dtype=np.int64), size, width, similarity)
            of, token, free = row_ids(size), np.concatenate([*cores, np.zeros(0, np.uint32)]), np.concatenate([*opens, np.zeros(0, bool)])
            part = token % (-(-batch.column("blocks").to_numpy() // PART_BLOCKS)).astype(np.uint32)[of]
            order = np.lexsort((part, of))
            of, part, token, free = of[order], part[order], token[order], free[order]
            lead = np.flatnonzero(_first_of(of, part))
            at, own = np.append(lead, len(of)), of[lead]
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(own) for c in ("key", "src", "s_span")), pa.array(need[own]), pa.array(part[lead].astype(np.int32)),
                                              binary_array(token.astype("<u4").view(np.uint8), at * 4), binary_array(free.view(np.uint8), at)],
                                             names=["key", "src", "s_span", "need", "part", "token", "free"])
    return run


def _again(table):
    """For each core of a crowd, of one part's tokens: those that come again, if an open one is among them, and if one is open in another core."""
    token, free = (np.frombuffer(b"".join(table.column(c).to_pylist()), kind) for c, kind in (("token", "<u4"), ("free", bool)))
    of = row_ids(np.array([len(f) for f in table.column("free").to_pylist()], dtype=np.int64))
    _, at, often = np.unique(token, return_inverse=True, return_counts=True)
    targets, n = np.bincount(at, weights=free), table.num_rows
    more = often[at] > 1
    count = lambda x: np.bincount(of[x], minlength=n)
    return pa.table([*(table.column(c) for c in ("key", "src", "s_span", "need")), pa.array(count(more)), pa.array(count(more & free) > 0), pa.array(count(more & (targets[at] > free)) > 0)],
                    names=["key", "src", "s_span", "need", "have", "is_target", "is_source"])


def _across(width: int, similarity: float):
    """Links of a block of cores with open tokens to a block of its crowd's cores, all of them."""
    def run(table):
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("src", "s_span", "tokens", "target", "open"))), key=lambda r: r[:4])
        opens = [np.unpackbits(np.frombuffer(r[4], np.uint8), count=len(r[2]) // TOKEN_BYTES).astype(bool) if r[3] else None for r in rows]
        links = _settled(rows, np.zeros(len(rows), dtype=np.int64), np.array([not r[3] for r in rows]), opens, width, similarity)
        return pa.table(_links([(rows[a][:2], rows[b][:2]) for a, b in links]), names=MET[:4])
    return run


def _crowd_links(texts: DataFrame, crowds: DataFrame, width: int, similarity: float) -> DataFrame | None:
    """Pairs of windows (src, dst, s_span, d_span) of crowds: keys, and if they are large."""
    spark = texts.sparkSession
    n, many = int(spark.conf.get("spark.sql.shuffle.partitions")), crowds.count()
    if not many:
        return None
    bits = min(max((MAP_BITS * many).bit_length(), MAP_LEAST), MAP_MOST)
    shipped = Shipped(spark, _crowd_map(crowds, bits))
    rows = texts.mapInArrow(_crowd_rows(width, bits, shipped), CROWD_TYPE).repartition(n, "key", "salt").sortWithinPartitions("salt", "key", "doc", "span")
    met = written(rows.mapInArrow(_meet(width, similarity), MET_TYPE), "crowd-links")
    links = met.where("dst is not null").select(*MET[:4])
    if not crowds.where("large").head(1):
        return links
    # equal cores of several parts are one: the others have their link already
    cores = met.where("dst is null").groupBy("key", "tokens").agg(F.min(F.struct("src", "s_span", "open")).alias("first")).select("key", "tokens", "first.*")
    count = lambda c: F.ceil(F.count(c) / BLOCK).cast("int")
    blocks = lambda cores: written(cores.join(cores.groupBy("key").agg(count("*").alias("blocks"), count("open").alias("open_blocks")), "key"), "crowd-cores")
    cores = blocks(cores)
    wide = cores.where(F.col("blocks") > WIDE)
    if wide.head(1):
        # what has too few tokens that come again among all of its crowd is like none of it; with no open one among
        # them it is no target, and without one that is open in another core no source. They are counted in parts
        parts = wide.mapInArrow(_core_parts(width, similarity), "key long, src long, s_span long, need long, part int, token binary, free binary")
        again = parts.groupBy("key", "part").applyInArrow(_again, "key long, src long, s_span long, need long, have long, is_target boolean, is_source boolean")
        may = again.groupBy("key", "src", "s_span").agg(F.sum("have").alias("have"), F.first("need").alias("need"), F.max("is_target").alias("is_target"),
                                                        F.max("is_source").alias("is_source")).where("have >= need and (is_target or is_source)")
        wide = wide.drop("blocks", "open_blocks")
        kept = wide.join(may.drop("have", "need"), ["key", "src", "s_span"]).withColumn("open", F.when(F.col("is_target"), F.col("open")))
        cores = cores.where(F.col("blocks") <= WIDE).unionByName(blocks(kept.drop("is_target", "is_source")))
    # every block of those with open tokens meets every block of all
    side = lambda n: F.pmod(F.xxhash64("src"), n).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    kept = cores.where("open_blocks > 0")
    sides = kept.withColumns({"target": F.lit(False), "one": side("blocks"), "open": F.lit(None).cast("binary")}).withColumn("two", each("open_blocks")) \
        .unionByName(kept.where("open is not null").withColumns({"target": F.lit(True), "two": side("open_blocks")}).withColumn("one", each("blocks")))
    return links.unionByName(sides.drop("blocks", "open_blocks").groupBy("key", "one", "two").applyInArrow(_across(width, similarity), LINK_TYPE))


def _long_rows(hashes, counts):
    """Shingles of the rows with at least K words; the others have none."""
    keep = np.repeat(counts >= K, counts)
    return shingles(hashes[keep], np.where(counts >= K, counts, 0), K)


def _pieces(batches):
    """32-bit tokens of the listed stretches of each text: a source's once for
    each of its ``copies`` (salts 0, 1, ...), a target's under its own salt."""
    for batch in slices(batches, "text"):
        hashes, _, _, counts, _ = words(batch.column("text"), NOT_SPACE)
        tokens, per_row = _long_rows(hashes, counts)
        small, at = np.ascontiguousarray(tokens.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :TOKEN_BYTES], bounds(per_row)
        rows, data = [], []
        for i, (d, listed) in enumerate(zip(batch.column("doc").to_pylist(), batch.column("listed").to_pylist())):
            for w in listed:
                piece = small[at[i] + w["low"]:min(at[i] + w["high"] + 1, at[i + 1])]
                if w["dst"] is None:
                    rows += [(d, w["low"], salt, None, w["low"], None, None) for salt in range(w["salt"])]
                    data += [piece] * w["salt"]
                else:
                    rows.append((w["src"], w["s_start"], w["salt"], d, w["low"], w["s_low"], w["s_high"]))
                    data.append(piece)
        flat = np.concatenate(data).ravel() if data else np.zeros(0, np.uint8)
        size = bounds(np.array([x.size for x in data], dtype=np.int64))
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        for lo in range(0, len(rows), 2000):
            some = rows[lo:lo + 2000]
            columns = [pa.array([r[j] for r in some], k) for j, k in enumerate(kinds)]
            part = binary_array(flat[size[lo]:size[lo + len(some)]], size[lo:lo + len(some) + 1] - size[lo])
            yield pa.RecordBatch.from_arrays([*columns, part], names=["src", "s_start", "salt", "dst", "low", "s_low", "s_high", "tokens"])


def dense_segments(hit: np.ndarray, share: float, width: int) -> list[tuple[int, int]]:
    """Segments (first, last) of at least ``width`` that begin and end with a
    hit and have a share of hits of at least ``share``: the longest one first,
    then the longest ones to its left and right."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))).reshape(-1, 2)
    first, end = edge[:, 0], edge[:, 1]
    hits = np.cumsum(end - first)
    after = hits - share * end  # hits less the wanted ones, up to the end of a run of hits
    before = hits - (end - first) - share * first
    out, todo = [], [(0, len(first))]
    while todo:
        lo, hi = todo.pop()
        if lo >= hi or end[hi - 1] - first[lo] < width:
            continue
        least = np.minimum.accumulate(before[lo:hi])
        start = np.searchsorted(-least, -(after[lo:hi] + 1e-9), side="left")  # the first run from which the share is met
        start = np.minimum(start, np.arange(hi - lo))
        size = end[lo:hi] - first[lo:hi][start]
        m = int(size.argmax())
        if size[m] >= width:
            k = int(start[m])
            out.append((int(first[lo + k]), int(end[lo + m]) - 1))
            todo += [(lo, lo + k), (lo + m + 1, hi)]
    return sorted(out)


def verified_passages(source: np.ndarray, target: np.ndarray, width: int, similarity: float) -> list[tuple[int, int, int, int, float]]:
    """(first, last, source first, source last, similarity) of the target's
    token runs of at least ``width`` that resemble a run of the source."""
    known, where = np.unique(source, return_index=True)
    at = np.minimum(np.searchsorted(known, target), max(len(known) - 1, 0))
    hit = known[at] == target if len(known) else np.zeros(len(target), bool)
    share = 2 * similarity / (1 + similarity)
    if np.count_nonzero(hit) < share * width - 1e-9:
        return []
    out, todo = [], [(0, len(target), 0)]
    while todo:
        lo, hi, level = todo.pop()
        for first, last in dense_segments(hit[lo:hi], (share, (1 + share) / 2, 1.0)[level], width):
            first, last = first + lo, last + lo
            own = np.arange(first, last + 1)[hit[first:last + 1]]
            spots = where[at[own]]
            a, best = np.unique(target[first:last + 1]), (0.0, 0, 0)
            # the run of the source that most of the tokens point to; where tokens
            # come again and again, that of the first or last one, or all between
            shift = spots - (own - first)
            for start, slack in ((int(np.median(shift)), width), (int(shift[0]), 0), (int(shift[-1]), 0), (0, len(source))):
                near = spots[(spots >= start - slack) & (spots <= start + last - first + slack)]
                if len(near):
                    low, high = int(near.min()), int(near.max())
                    if slack == 0:
                        low, high = max(start, 0), min(start + last - first, len(source) - 1)
                    b = np.unique(source[low:high + 1])
                    common = len(a) + len(b) - len(np.union1d(a, b))
                    best = max(best, (common / (len(a) + len(b) - common), low, high))
                if best[0] >= similarity:
                    break
            if best[0] >= similarity:
                out.append((first, last, best[1], best[2], best[0]))
                continue
            if level < 2:  # a part of it may do
                todo.append((first, last + 1, level + 1))
    return sorted(out)


def _tokens(data: bytes) -> np.ndarray:
    if TOKEN_BYTES == 4:
        return np.frombuffer(data, "<u4")
    out = np.zeros((len(data) // TOKEN_BYTES, 4), dtype=np.uint8)
    out[:, :TOKEN_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, TOKEN_BYTES)
    return out.view("<u4").ravel()


def _verify(width: int, similarity: float):
    """Rows sorted by source stretch, the source's own first: it is held while its targets are compared with it."""
    def run(batches):
        now, source = None, None
        for batch in batches:
            rows = []
            columns = [batch.column(c).to_pylist() for c in ("src", "s_start", "salt", "dst", "low", "s_low", "s_high", "tokens")]
            for src, s_start, salt, dst, low, s_low, s_high, tokens in zip(*columns):
                if dst is None:
                    now, source = (src, s_start, salt), _tokens(tokens)
                    continue
                if now != (src, s_start, salt):
                    raise ValueError(f"no source stretch for {(src, s_start, salt)}")
                own = source[s_low - s_start:s_high - s_start + 1]
                for first, last, a, b, score in verified_passages(own, _tokens(tokens), width, similarity):
                    rows.append((dst, low + first, last - first + K, src, s_low + a, b - a + K, score))
            kinds = [pa.int64()] * 6 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=NAMES)
    return run


NAMES = ["doc_id", "first_word", "n_words", "source_id", "source_first_word", "source_n_words", "similarity"]


def repeated_passages(docs: DataFrame, min_words: int = 50, similarity: float = 0.8) -> DataFrame:
    """Passages of docs (doc_id, text) that repeat a passage of a document with
    a smaller doc_id: doc_id, first_word, n_words, source_id,
    source_first_word, source_n_words, similarity.

    Words are what stands between white space, A-Z lower-cased. A passage has
    at least ``min_words`` words, and its set of five-word shingles has a
    Jaccard similarity of at least ``similarity`` with that of its source.
    Every run of ``min_words`` words that an earlier document has, too, is in a
    passage. Others need the same min-hash under one of the FUNCTIONS hash
    functions. They are compared with all different surroundings of the min-hash;
    if there are more than FEW, until passages hold all words around it that may
    repeat. Equal surroundings, which hold every passage of the least length around
    the min-hash, are compared once, as the first document's. Repeats within one
    document are no passages here.
    Null, empty and short texts have none; rows with a null doc_id take no
    part; rows that repeat a doc_id count as one document if they are equal
    and should not differ. Other columns are ignored; an empty table gives no
    rows.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    width = min_words - K + 1
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc"), "text")
    found = texts.mapInArrow(_windows(width), "key long, core int, doc long, span long")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = F.struct("doc", "span")
    of_core, of_key = W.Window.partitionBy("key", "core").orderBy("doc", "span"), W.Window.partitionBy("key")
    met = found.repartition(n, "key").withColumn("copy", F.first(at).over(of_core.rowsBetween(W.Window.unboundedPreceding, W.Window.currentRow))) \
        .withColumn("lead", F.row_number().over(of_core) == 1) \
        .withColumns({"cores": F.sum(F.col("lead").cast("int")).over(of_key), "least": F.min("doc").over(of_key), "most": F.max("doc").over(of_key)}) \
        .where("least < most")
    leads = W.Window.partitionBy("key", "lead").orderBy("doc", "span")
    met = met.withColumn("place", F.row_number().over(leads)).withColumn("near", F.array_compact(F.array(*[F.lag(at, k).over(leads) for k in range(1, FEW)])))
    # a crowd is one row: its key, without windows
    none = F.lit(None).cast("long")
    met = met.withColumn("s", F.explode(F.when(~F.col("lead"), F.array("copy")).when(F.col("cores") <= FEW, F.col("near"))
                                        .when(F.col("place") == 1, F.array(F.struct(none.alias("doc"), none.alias("span")))).otherwise(F.array()))) \
        .where("s.doc is null or doc <> s.doc").select(
            F.when(F.col("s.doc").isNull(), F.col("key")).alias("key"), (F.col("cores") > BLOCK).alias("large"),
            F.least(at, "s").alias("low"), F.greatest(at, "s").alias("high"), "s") \
        .select("key", "large", F.when(F.col("key").isNull(), F.col("low.doc")).alias("src"), F.when(F.col("key").isNull(), F.col("high.doc")).alias("dst"),
                F.col("low.span").alias("s_span"), F.col("high.span").alias("d_span"))
    met = written(met, "window-links")
    crowd = _crowd_links(texts, met.where("key is not null").select("key", "large"), width, similarity)
    met = met.where("key is null").select(*MET[:4])
    met = met.unionByName(crowd) if crowd is not None else met

    # overlapping windows of two documents are one candidate; a near copy goes on
    # beyond the window where a changed token has a smaller hash
    low, high = lambda c: F.shiftright(c, 32), lambda c: F.col(c).bitwiseAND(F.lit(0xFFFFFFFF))
    before = W.Window.partitionBy("src", "dst").orderBy("d_span", "s_span")
    joined = (met.withColumn("reach", F.max(high("d_span")).over(before.rowsBetween(W.Window.unboundedPreceding, -1)) + width)
              .withColumn("part", F.sum(F.when(F.greatest(low("d_span") - width, F.lit(0)) <= F.col("reach"), 0).otherwise(1)).over(before))
              .groupBy("src", "dst", "part").agg(*[f.alias(c) for p in "sd" for c, f in (
                  (f"{p}_low", F.greatest(F.min(low(f"{p}_span")) - width, F.lit(0))), (f"{p}_high", F.max(high(f"{p}_span")) + width))])
              .select("src", "s_low", "s_high", "dst", "d_low", "d_high"))
    joined = written(joined, "window-pairs")

    # stretches of a source that overlap are one stretch, sent once for every TARGETS of its targets
    spans = joined.select("src", "s_low", "s_high").distinct()
    before = W.Window.partitionBy("src").orderBy("s_low", "s_high").rowsBetween(W.Window.unboundedPreceding, -1)
    starts = written(spans.withColumn("new", F.coalesce(F.col("s_low") > F.max("s_high").over(before), F.lit(True)))
                     .withColumn("s_start", F.max(F.when(F.col("new"), F.col("s_low"))).over(before.rowsBetween(W.Window.unboundedPreceding, 0)))
                     .drop("new"), "source-stretches")
    placed = written(joined.join(starts, ["src", "s_low", "s_high"]), "candidates")
    copies = placed.groupBy("src", "s_start").agg(F.max("s_high").alias("high"), F.ceil(F.count("*") / TARGETS).cast("int").alias("copies"))
    copies = written(copies, "stretch-copies")
    none = F.lit(None).cast("long")
    own = copies.select(F.col("src").alias("doc"), F.struct(F.col("s_start").alias("low"), "high", F.col("copies").alias("salt"), none.alias("src"),
                        none.alias("s_start"), none.alias("s_low"), none.alias("s_high"), none.alias("dst")).alias("e"))
    salt = F.pmod(F.xxhash64("dst", "d_low"), F.col("copies").cast("long")).cast("int")
    others = placed.join(copies.drop("high"), ["src", "s_start"]).select(F.col("dst").alias("doc"), F.struct(
        F.col("d_low").alias("low"), F.col("d_high").alias("high"), salt.alias("salt"), "src", "s_start", "s_low", "s_high", "dst").alias("e"))
    # a list per document, as long as the document's own windows at most
    listed = own.unionByName(others).groupBy("doc").agg(F.collect_list("e").alias("listed"))
    schema = "src long, s_start long, salt int, dst long, low long, s_low long, s_high long, tokens binary"
    pieces = texts.join(listed, "doc").mapInArrow(_pieces, schema)
    key = ["src", "s_start", "salt"]
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = pieces.repartition(n, *key).sortWithinPartitions(*key, F.col("dst").asc_nulls_first())
    schema = ", ".join(f"{n} long" for n in NAMES[:-1]) + ", similarity double"
    return found.mapInArrow(_verify(width, similarity), schema).distinct()


def _cut(names: list[str], spans_name: str):
    def cut(batches):
        for batch in slices(batches, "text"):
            texts, spans = batch.column("text").to_pylist(), batch.column(spans_name).to_pylist()
            _, start, end, counts, _ = words(batch.column("text"), NOT_SPACE)
            at, offset = bounds(counts), 0
            for i, (text, own) in enumerate(zip(texts, spans)):
                raw = (text or "").encode()
                if own:
                    pieces, done = [], 0
                    for span in sorted(own, key=lambda x: x["first_word"]):
                        a, b = at[i] + span["first_word"], min(at[i] + span["first_word"] + span["n_words"], at[i + 1]) - 1
                        if a > b:
                            continue
                        if start[a] - offset > done:
                            pieces.append(raw[done:start[a] - offset])
                        done = max(done, int(end[b]) - offset)
                    texts[i] = b"".join([*pieces, raw[done:]]).decode()
                offset += len(raw)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names], names=names)
    return cut


def remove_passages(docs: DataFrame, passages: DataFrame, on: str = "doc_id") -> DataFrame:
    """docs without the words of the passages (doc_id, first_word, n_words), whose
    doc_id names the rows by the column ``on``;
    white space around them and all other columns, whatever their names, stay, and
    so do rows without passages and with a null doc_id or text. Rows that repeat a
    doc_id lose the same words. The first document that has a passage keeps it."""
    taken = {c.lower() for c in docs.columns}
    doc, spans = (next(n for n in (f"{stem}{i}" for i in range(len(taken) + 1)) if n not in taken) for stem in ("doc", "spans"))
    found = passages.groupBy(F.col("doc_id").alias(doc)).agg(F.collect_list(F.struct("first_word", "n_words")).alias(spans))
    marked = docs.join(found, F.col(on) == F.col(doc), "left").drop(doc)
    return marked.mapInArrow(_cut(docs.columns, spans), docs.schema)
