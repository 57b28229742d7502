"""Cross-tokenizer alignment.

Each text is encoded by two tokenizers, A (byte-level BPE) and B (sentence
pieces). Both cut the same bytes, so every token has a byte range. Per batch,
``merge_asof`` keyed by document finds for each token's start the covering
token of the other side; both directions together are all overlapping pairs,
and offsets where tokens of both sides end cut the tokens into groups.

How many documents hold a pair of ids linked is counted over the whole corpus:
documents are filed in blocks of bounded size, a block adds up its own pairs,
the pairs of all blocks are counted by one aggregation, and the counts go
back to the blocks, where each document keeps its links as places in the
block's sorted list of pairs. No text and no row per link is shuffled.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.bpe import Encoder, Ranks
from quarry.llm.shipping import Shipped, written
from quarry.llm.tokens import bounds, flat, ranges, slices

#: Bytes of text in one block (one longer text is a block of its own).
BLOCK_BYTES = 16 << 20
#: Bits of a B id in a pair's number.
B_BITS = 20
#: White-space runs from this length on are left to ``Encoder``: the regular expression's stack doesn't hold them.
LONG_BLANK = 2048
EMPTY_DIGEST = ""


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable
    Latin-1 characters stand for themselves, all others for 256, 257, ... in turn."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class TokenizerPair:
    """Both tokenizers with the bytes of every id. ``a_json`` and ``b_model`` are the files' contents."""

    def __init__(self, a_json: bytes, b_model: bytes, pattern: str):
        import sentencepiece
        import tiktoken
        spec, letters = json.loads(a_json), _byte_letters()
        special = {t["content"] for t in spec["added_tokens"]}
        self.ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        made = [spec["model"]["vocab"]["".join(m)] for m in merges]
        if made != sorted(made) or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"]:
            raise ValueError("not a byte-level BPE whose merges are in the order of their ids")
        self.a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        self.a_bytes = _table(self.ranks)
        pieces = {}
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            pieces[i] = bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode("utf-8")
        if self.b.get_piece_size() >= 1 << B_BITS:
            raise ValueError("too many pieces for the pairs' numbers")
        self.b_bytes = _table({v: k for k, v in pieces.items()}, pieces)
        self.blanks = re.compile(r"\s{%d}" % LONG_BLANK)
        self.slow = None

    def encode_a(self, text: str) -> np.ndarray:
        if len(text) > LONG_BLANK and self.blanks.search(text):
            if self.slow is None:
                self.slow = Encoder(Ranks(self.ranks))
            data = np.frombuffer(text.encode("utf-8"), np.uint8)
            return self.slow.encode(data, np.array([0, len(data)]))[0]
        return np.array(self.a.encode_ordinary(text), dtype=np.int32)


def _table(ids: dict[bytes, int], by_id: dict[int, bytes] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets by id)"""
    by_id = by_id or {i: data for data, i in ids.items()}
    strings = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
    return np.frombuffer(b"".join(strings), np.uint8), bounds(np.array([len(s) for s in strings], dtype=np.int64))


def _spelled(table, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the ids, and the length of each."""
    data, at = table
    size = np.diff(at)[ids]
    return data[ranges(at[ids], size)], size


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of the given lengths, as integers."""
    total = bounds(values)
    at = bounds(counts)
    return total[at[1:]] - total[at[:-1]]


class Alignment:
    """The tokens, links and groups of a batch of texts (a null text has none).

    a, b: ids in order; a_count, b_count: tokens per text; link_a, link_b:
    places of linked tokens in a and b, link_count per text; a_group, b_group:
    group of each token within the batch, group_count per text."""

    def __init__(self, pair: TokenizerPair, texts: list[str | None]):
        spaced = [" " + t if t else "" for t in texts]
        a = [pair.encode_a(t) if t else () for t in spaced]
        b = pair.b.encode([t or "" for t in texts], num_threads=1)
        b = [x if t else () for x, t in zip(b, texts)]
        raw = [t.encode("utf-8") for t in spaced]
        self.a, self.a_count, a_size = self._side(pair.a_bytes, a, raw)
        self.b, self.b_count, b_size = self._side(pair.b_bytes, b, raw)
        fits = (self.a_count >= 0) & (self.b_count >= 0)
        self.a, self.a_count, a_size = self._only(fits, self.a, self.a_count, a_size)
        self.b, self.b_count, b_size = self._only(fits, self.b, self.b_count, b_size)
        n = len(texts)
        a_doc, b_doc = np.repeat(np.arange(n), self.a_count), np.repeat(np.arange(n), self.b_count)
        a_end, b_end = np.cumsum(a_size), np.cumsum(b_size)  # both sides spell the same bytes: offsets run over the batch
        left = pd.DataFrame({"doc": a_doc, "start": a_end - a_size, "a": np.arange(len(self.a))})
        right = pd.DataFrame({"doc": b_doc, "start": b_end - b_size, "b": np.arange(len(self.b))})
        if len(left):
            over_a = pd.merge_asof(left, right.assign(b_start=right["start"]), on="start", by="doc")
            over_b = pd.merge_asof(right, left.assign(a_start=left["start"]), on="start", by="doc")
            new = over_b["a_start"].to_numpy() != over_b["start"].to_numpy()  # equal starts have met in over_a
            link_a = np.concatenate([over_a["a"].to_numpy(), over_b["a"].to_numpy()[new]])
            link_b = np.concatenate([over_a["b"].to_numpy(), over_b["b"].to_numpy()[new]])
        else:
            link_a = link_b = np.zeros(0, dtype=np.int64)
        link_doc = a_doc[link_a]
        order = np.argsort(link_doc, kind="stable")
        self.link_a, self.link_b, self.link_doc = link_a[order], link_b[order], link_doc[order]
        self.link_count = np.bincount(link_doc, minlength=n)
        cuts = np.intersect1d(a_end, b_end, assume_unique=True)
        self.a_group, self.b_group = np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)
        last = np.isin(a_end, cuts, assume_unique=True)
        self.group_count = np.bincount(a_doc[last], minlength=n)

    @staticmethod
    def _side(table, ids: list, raw: list[bytes]):
        """(ids, ids per text, bytes per id); -1 ids for a text that they don't spell."""
        count = np.array([len(x) for x in ids], dtype=np.int64)
        joined = np.concatenate([np.asarray(x, dtype=np.int64) for x in ids]) if ids else np.zeros(0, np.int64)
        data, size = _spelled(table, joined)
        length = np.array([len(r) for r in raw], dtype=np.int64)
        good = _sums(size, count) == length
        if good.all() and np.array_equal(data, np.frombuffer(b"".join(raw), np.uint8)):
            return joined, count, size
        at = bounds(_sums(size, count))
        good &= np.array([data[lo:hi].tobytes() == r for lo, hi, r in zip(at[:-1], at[1:], raw)], dtype=bool)
        keep = np.repeat(good, count)
        return joined[keep], np.where(good, count, -1), size[keep]

    @staticmethod
    def _only(fits, ids, count, size):
        count = np.maximum(count, 0)
        keep = np.repeat(fits, count)
        return ids[keep], np.where(fits, count, 0), size[keep]

    def group_digests(self) -> list[str]:
        """SHA-256 of each text's groups, written as ``a1,a2|b1;a3|b2,b3``; '' for a text without tokens."""
        group = np.concatenate([self.a_group, self.b_group])
        side = np.repeat(np.array([0, 1]), [len(self.a), len(self.b)])
        order = np.lexsort((side, group))  # stable: tokens stay in order
        ids, group, side = np.concatenate([self.a, self.b])[order], group[order], side[order]
        if not len(ids):
            return [EMPTY_DIGEST] * len(self.a_count)
        new_group, new_side = np.append(np.diff(group) != 0, True), np.append(np.diff(side) != 0, True)
        sign = np.where(new_group, ord(";"), np.where(new_side, ord("|"), ord(",")))
        digits = np.searchsorted(10 ** np.arange(1, 10), ids, side="right") + 1
        width = int(digits.max())
        grid = np.zeros((len(ids), width + 1), dtype=np.uint8)
        rest = ids.copy()
        for place in range(width):  # the digit `place` steps from the end
            column = digits - 1 - place
            rows = np.flatnonzero(column >= 0)
            grid[rows, column[rows]] = 48 + rest[rows] % 10
            rest //= 10
        grid[np.arange(len(ids)), digits] = sign
        data = grid[np.arange(width + 1) <= digits[:, None]].tobytes()
        ends = bounds(_sums(digits + 1, self.a_count + self.b_count))
        return [hashlib.sha256(data[lo:hi - 1]).hexdigest() if hi > lo else EMPTY_DIGEST for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def pairs(self) -> np.ndarray:
        """The number of each link's pair of ids."""
        return self.a[self.link_a] << B_BITS | self.b[self.link_b]


def _planes(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, all lowest bytes first: small numbers compress well."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unplaned(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


FILED = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
         "links binary, pairs array<long>, docs array<int>")


class _Block:
    """Documents of one block: their rows, and for each its distinct pairs with their links."""

    def __init__(self, number: int):
        self.number, self.rows, self.pairs, self.links, self.sizes, self.bytes = number, [], [], [], [], 0

    def add(self, doc_ids: list, alignment: Alignment):
        n = len(doc_ids)
        pairs, which = np.unique(alignment.pairs(), return_inverse=True)
        seen, links = np.unique(alignment.link_doc * max(len(pairs), 1) + which, return_counts=True)
        doc, place = np.divmod(seen, max(len(pairs), 1))
        self.pairs.append(pairs[place] if len(pairs) else np.zeros(0, np.int64))
        self.links.append(links)
        self.sizes.append(np.bincount(doc, minlength=n))
        self.rows += zip(doc_ids, alignment.a_count.tolist(), alignment.b_count.tolist(), alignment.group_count.tolist(),
                         alignment.link_count.tolist(), alignment.group_digests())

    def batches(self):
        """One row per document, then one with the block's pairs and how many of its documents hold each."""
        packer = zstandard.ZstdCompressor(level=1, write_checksum=False)
        pairs, place, docs = np.unique(np.concatenate(self.pairs), return_inverse=True, return_counts=True)
        links, at = np.concatenate(self.links), bounds(np.concatenate(self.sizes))
        step = np.diff(place, prepend=0)
        first = at[:-1][np.diff(at) > 0]
        step[first] = place[first]
        schema = pa.schema([("block", pa.int64()), *[(c, pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")],
                            ("groups_sha256", pa.string()), ("links", pa.binary()), ("pairs", pa.list_(pa.int64())), ("docs", pa.list_(pa.int32()))])
        for lo in range(0, len(self.rows), 1000):
            hi = min(lo + 1000, len(self.rows))
            packed = [packer.compress(_planes(step[at[i]:at[i + 1]]) + _planes(links[at[i]:at[i + 1]])) for i in range(lo, hi)]
            columns = [[self.number] * (hi - lo), *[list(c) for c in zip(*self.rows[lo:hi])], packed, [None] * (hi - lo), [None] * (hi - lo)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
        last = [[self.number], *[[None]] * 7, [pairs], [docs.astype(np.int32)]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(last, schema)], schema=schema)


def _file(shared, block_bytes: int):
    def file(batches):
        from pyspark import TaskContext
        pair, task = shared.value, TaskContext.get().partitionId()
        count, block = 0, None
        for batch in slices(batches, "text", 1 << 20):
            texts = batch.column("text").to_pylist()
            if block is not None and block.bytes >= block_bytes:
                yield from block.batches()
                block = None
            if block is None:
                block = _Block((task << 32) + count)
                count += 1
            block.add(batch.column("doc_id").to_pylist(), Alignment(pair, texts))
            block.bytes += int(flat(batch.column("text"))[1][-1])
        if block is not None:
            yield from block.batches()
    return file


def _add_counts(left: pa.Table, right: pa.Table) -> pa.Table:
    """Documents of a block, and its pairs with their counts over the corpus."""
    right = right.sort_by("pair")
    count, best = right.column("n").to_numpy(), right.column("best").to_numpy(zero_copy_only=False)
    opener = zstandard.ZstdDecompressor()
    n_best, count_sum = [], []
    for packed in left.column("links").to_pylist():
        data = opener.decompress(packed)
        if not data:
            n_best.append(0), count_sum.append(0)
            continue
        place, links = np.cumsum(_unplaned(data[:len(data) // 2])), _unplaned(data[len(data) // 2:])
        n_best.append(int(links[best[place]].sum()))
        count_sum.append(int((links * count[place]).sum()))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    return pa.table([*[left.column(c) for c in names], pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64())],
                    names=[*names, "n_best", "count_sum"])


def load_pair(spark, a_path: str, b_path: str, pattern: str) -> Shipped:
    """Both tokenizers' files (a few MB, fixed by the files) from the driver to the executors."""
    with open(a_path, "rb") as a, open(b_path, "rb") as b:
        return Shipped(spark, _Files(a.read(), b.read(), pattern))


class _Files:
    """The files' contents; unpickled on a worker, they are the tokenizers."""

    def __init__(self, *contents):
        self.contents = contents

    def __reduce__(self):
        return TokenizerPair, self.contents


def pair_counts(filed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(block, pair) of every block, and pair, n (documents of the corpus that
    hold it), best (no pair of its A id has more) per pair."""
    held = filed.where("pairs is not null").select("block", F.explode(F.arrays_zip("pairs", "docs")).alias("p")) \
        .select("block", F.col("p.pairs").alias("pair"), F.col("p.docs").alias("docs"))
    counts = held.groupBy("pair").agg(F.sum("docs").alias("n")).withColumn("a", F.shiftright("pair", B_BITS))
    counts = written(counts, "pair-counts")
    highest = counts.groupBy("a").agg(F.max("n").alias("highest"))  # at most one row per id of A
    counts = counts.join(F.broadcast(highest), "a").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))
    return held.select("block", "pair"), counts


def align(docs: DataFrame, pair: Shipped, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 per
    row of docs (doc_id, text); see the module for the method.

    A takes a space and the text, B adds the space itself. Null and empty
    texts, and texts that the tokens of one side don't spell byte for byte,
    have zeros and an empty digest. Strings of special tokens are ordinary
    text. Texts of any length are encoded whole; a repeated row is a document
    of its own and counts as one; other columns are ignored; an empty table
    gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    filed = written(rows.mapInArrow(_file(pair, block_bytes), FILED), "aligned-blocks")
    held, counts = pair_counts(filed)
    told = held.join(counts, "pair").select(F.col("block").alias("home"), "pair", "n", "best")
    documents = filed.where("pairs is null").drop("pairs", "docs")
    out = documents.groupBy("block").cogroup(told.groupBy("home")).applyInArrow(
        _add_counts, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def links(docs: DataFrame, pair: Shipped) -> DataFrame:
    """doc_id, a_place, a_id, b_place, b_id, group per link of each document:
    the places are those of the tokens in their document, from 0."""
    def emit(batches):
        tokenizers = pair.value
        for batch in slices(batches, "text", 1 << 20):
            found = Alignment(tokenizers, batch.column("text").to_pylist())
            a_at, b_at = bounds(found.a_count)[found.link_doc], bounds(found.b_count)[found.link_doc]
            first = bounds(found.group_count)[found.link_doc]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(found.link_doc)), *[pa.array(x, pa.int64()) for x in (
                    found.link_a - a_at, found.a[found.link_a], found.link_b - b_at, found.b[found.link_b], found.a_group[found.link_a] - first)]],
                names=["doc_id", "a_place", "a_id", "b_place", "b_id", "group"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        emit, "doc_id long, a_place long, a_id long, b_place long, b_id long, group long")
