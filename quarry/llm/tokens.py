"""Vectorised text helpers shared by the operators: Arrow columns as flat
byte arrays, word boundaries by byte class, 64-bit word and shingle hashes.

All functions work on one bounded slice of rows at a time; a null text is an
empty text. Hash arithmetic is modulo 2**64 throughout.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# words are runs of bytes other than white space
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
# words are runs of ASCII digits, lower-case ASCII letters and all of UTF-8's non-ASCII bytes
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
_POWERS: dict = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (all output bits depend on all input bits)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeds(n: int, salt: int = 0) -> np.ndarray:
    """n fixed pseudo-random odd 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt)) | np.uint64(1)


BYTE_VALUE = seeds(256, 77)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", BASE), ("down", BASE_INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string or binary column as (bytes, offsets); nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches, column: str, limit: int = 1 << 19):
    """Arrow batches cut so that the text column of each piece holds about
    ``limit`` bytes (one longer row stays whole): memory per step is bounded."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        piece = np.cumsum(size.astype(np.int64)) // limit
        cuts = np.flatnonzero(np.diff(piece)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(int(lo), int(hi - lo))


def binary_array(data: np.ndarray, offsets: np.ndarray, kind=None) -> pa.Array:
    """A binary (or string) Arrow column over flat bytes."""
    return pa.Array.from_buffers(kind or pa.binary(), len(offsets) - 1,
                                 [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def run_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte run data[start:end] (prefix polynomial sums)."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUE[data] * up[:len(data)], out=sums[1:])
    raw = (sums[end] - sums[start]) * down[start]
    return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_bounds(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, words per row) of the runs of word bytes; runs end with their row."""
    inside = is_word[data]
    opens, closes = inside.copy(), inside.copy()
    if len(data):
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        edges = offsets[1:-1]
        first = edges[edges < len(data)]
        opens[first] = inside[first]
        last = edges[edges > 0] - 1
        closes[last] = inside[last]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    counts = np.diff(np.searchsorted(start, offsets))
    return start, end, counts


def words(column: pa.Array, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each row after lower-casing A-Z: (hash, start, end, words per row, lower-cased bytes)."""
    data, offsets = flat(column)
    data = LOWER[data]
    start, end, counts = word_bounds(data, offsets, is_word)
    return run_hashes(data, start, end), start, end, counts, data


def shingles(hashes: np.ndarray, counts: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run of k consecutive words, shingles per row), in text
    order; a row with fewer words, but not none, has its whole sequence as one."""
    weights = seeds(k, 5)
    n = len(hashes)
    ends = np.cumsum(counts)
    begins = ends - counts
    short = (counts > 0) & (counts < k)
    per_row = np.where(short, 1, np.maximum(counts - k + 1, 0))
    row = np.repeat(np.arange(len(counts)), per_row)
    place = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row) + begins[row]
    total = np.zeros(len(row), dtype=np.uint64)
    length = np.minimum(counts, k)[row]
    padded = np.concatenate([hashes, np.zeros(k, np.uint64)]) if n else np.zeros(k, np.uint64)
    for j in range(k):
        part = padded[place + j] * weights[j]
        total += part if not short.any() else np.where(j < length, part, np.uint64(0))
    return mix(total + length.astype(np.uint64)), per_row


def row_ids(counts: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(counts)), counts)


def bounds(counts: np.ndarray) -> np.ndarray:
    """Offsets of consecutive groups of the given sizes."""
    out = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... (size[0] numbers), start[1], ..."""
    at = bounds(size)
    return np.arange(at[-1]) + np.repeat(start - at[:-1], size)
