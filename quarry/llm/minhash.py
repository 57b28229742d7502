"""MinHash near-dedup by a multi-index Hamming join.

A document's set holds its distinct five-word shingles. Its signature is a
row of ``SYMBOLS`` min-hash values cut to 16 bits; the distance of two
signatures is the number of symbols that differ. The symbols are split into
``CHUNKS`` chunks. If two signatures differ in at most ``2 * CHUNKS - 1``
symbols, some chunk has at most one error (pigeonhole), so one index entry
for each chunk and each place of the allowed error finds every such pair.
At a similarity of 0.85 a pair lies beyond that distance with probability
3.5e-6, at 0.80 (the least ``percent``) with 1.4e-4.

Equal sets are one class first, so copies never meet each other in pairs. A
crowded index entry (more than ``crowd`` classes) emits no pairs either: its
classes join a crowd, and crowds are compared in blocks of bounded size that
return only links of a spanning forest. All links are confirmed on full sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.components import connected_components
from quarry.llm.tokens import NOT_SPACE, binary_array, bounds, mix, seeds, shingles, slices, words
from quarry.session import ensure_checkpoint_dir

SYMBOLS, CHUNKS = 32, 8
WIDTH = SYMBOLS // CHUNKS
MAX_DISTANCE = 2 * CHUNKS - 1
BLOCK_SHINGLES = 1 << 16
#: and at most about so many sets, however short: a task's matrices take some 60 MB
BLOCK_SETS = 1024


def _distinct_shingles(column):
    """(sorted distinct shingle hashes, sizes per row) of a text column."""
    hashes, _, _, counts, _ = words(column, NOT_SPACE)
    all_hashes, per_row = shingles(hashes, counts)
    at = bounds(per_row)
    sets = [np.unique(all_hashes[lo:hi]) for lo, hi in zip(at[:-1], at[1:])]
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), sizes


def _signatures(values, sizes):
    """uint16[rows, SYMBOLS]; rows without shingles get zeros."""
    out = np.zeros((len(sizes), SYMBOLS), dtype=np.uint16)
    full = sizes > 0
    if full.any():
        at = bounds(sizes)[:-1][full]
        for k, seed in enumerate(seeds(SYMBOLS, 11)):
            turned = values * seed
            turned ^= turned >> np.uint64(32)
            turned *= np.uint64(0xD6E8FEB86659FD93)
            out[full, k] = mix(np.minimum.reduceat(turned, at)) & np.uint64(0xFFFF)
    return out


def _sign(batches):
    for batch in slices(batches, "text"):
        values, sizes = _distinct_shingles(batch.column("text"))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
        second = np.concatenate([[np.uint64(0)], np.cumsum(mix(values + np.uint64(1)), dtype=np.uint64)])
        at = bounds(sizes)
        one, two = sums[at[1:]] - sums[at[:-1]], second[at[1:]] - second[at[:-1]]
        signatures = _signatures(values, sizes)
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(sizes), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
            binary_array(signatures.view(np.uint8).ravel(), np.arange(len(sizes) + 1) * 2 * SYMBOLS)],
            names=["doc_id", "n_shingles", "set_1", "set_2", "signature"])


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, a 128-bit hash of the set, signature (binary) per row of docs."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _sign, "doc_id long, n_shingles long, set_1 long, set_2 long, signature binary")


def _index(batches):
    salt = seeds(WIDTH * CHUNKS, 23).reshape(CHUNKS, WIDTH)
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        symbols = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16).reshape(n, CHUNKS, WIDTH).astype(np.uint64)
        packed = symbols << (np.arange(WIDTH, dtype=np.uint64) * np.uint64(16))
        whole = packed.sum(axis=2, dtype=np.uint64)
        keys = mix((whole[:, :, None] - packed) * np.uint64(3) + salt)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(batch.column("rep").to_numpy(), CHUNKS * WIDTH)),
            pa.array(np.repeat(batch.column("set_1").to_numpy(), CHUNKS * WIDTH)),
            pa.array(keys.ravel().view(np.int64))], names=["rep", "set_1", "key"])


def _sets(batches):
    for batch in slices(batches, "text"):
        values, sizes = _distinct_shingles(batch.column("text"))
        yield pa.RecordBatch.from_arrays([
            batch.column("rep"), pa.array(sizes), binary_array(values.view(np.uint8), bounds(sizes) * 8)],
            names=["rep", "size", "shingles"])


def _confirm(percent: int):
    def confirm(batches):
        for batch in batches:
            keep = []
            for one, two in zip(batch.column("one"), batch.column("two")):
                x, y = np.frombuffer(one.as_py(), np.uint64), np.frombuffer(two.as_py(), np.uint64)
                common = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return confirm


def _common_counts(sets_x, sets_y):
    """Intersection sizes of all sets of one block with all of another, by
    matrix products over slices of the shingles that both blocks have."""
    flat_x, flat_y = np.concatenate(sets_x), np.concatenate(sets_y)
    both = np.intersect1d(flat_x, flat_y)
    out = np.zeros((len(sets_x), len(sets_y)), dtype=np.float32)
    if not len(both):
        return out
    placed = []
    for sets, values in ((sets_x, flat_x), (sets_y, flat_y)):
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.minimum(np.searchsorted(both, values), len(both) - 1)
        hit = both[at] == values
        order = np.argsort(at[hit], kind="stable")
        placed.append((row[hit][order], at[hit][order]))
    step = 4096
    for lo in range(0, len(both), step):
        dense = []
        for (row, at), n in zip(placed, out.shape):
            i, j = np.searchsorted(at, [lo, lo + step])
            m = np.zeros((n, step), dtype=np.float32)
            m[row[i:j], at[i:j] - lo] = 1
            dense.append(m)
        out += dense[0] @ dense[1].T
    return out


def _forest(a, b):
    """Indices of links that join two parts not joined before."""
    parent: dict = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        rx, ry = find(x), find(y)
        if rx != ry:
            parent[rx] = ry
            kept.append(i)
    return kept


def _compare_blocks(percent: int):
    def compare(table):
        """One pair of blocks of a crowd: links of a spanning forest."""
        side = table.column("side").to_numpy()
        reps = table.column("rep").to_numpy()
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("shingles")]
        same = bool((side == 2).all())
        left = np.flatnonzero(side != 1)
        right = left if same else np.flatnonzero(side == 1)
        found_a, found_b = [], []
        if len(left) and len(right):
            common = _common_counts([sets[i] for i in left], [sets[i] for i in right])
            size = np.array([len(s) for s in sets], dtype=np.float64)
            union = size[left][:, None] + size[right][None, :] - common
            x, y = np.nonzero(100.0 * common >= percent * union)
            found_a, found_b = reps[left[x]], reps[right[y]]
            keep = found_a != found_b
            found_a, found_b = found_a[keep], found_b[keep]
            kept = _forest(found_a, found_b)
            found_a, found_b = found_a[kept], found_b[kept]
        return pa.table({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})
    return compare


def near_duplicates(docs: DataFrame, percent: int = 85, crowd: int = 64) -> DataFrame:
    """doc_id, n_shingles, component_id, kept per row of ``docs`` (doc_id, text).

    Two documents are linked if 100 * |intersection| >= percent * |union| of
    their shingle sets; component_id is the smallest doc_id reachable, kept
    says that the row is that document. percent must be at least 80, for which
    the index is laid out. Null, empty and blank texts have an empty set and
    link with nothing. Rows that repeat a doc_id are each judged by their
    own text. A row with a null doc_id gets the component of its
    class (null if no other row has its text) and is not kept. Other columns
    of docs are ignored; an empty table gives no rows.
    """
    if percent < 80:
        raise ValueError("the index guarantees similarities of 80 percent and more")
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    signed = signatures(docs).checkpoint()
    sets = ["n_shingles", "set_1", "set_2"]
    linked = signed.where("n_shingles > 0 and doc_id is not null")
    classes = linked.groupBy(*sets).agg(F.min("doc_id").alias("rep"), F.min("signature").alias("signature"),
                                        F.count("*").alias("members")).checkpoint()
    index = classes.select("rep", "set_1", "signature").mapInArrow(_index, "rep long, set_1 long, key long")
    crowded = index.groupBy("key").agg(F.count("*").alias("n"), F.min("rep").alias("first")).where("n > 1").checkpoint()
    met = index.join(crowded, "key").checkpoint()

    crowds = connected_components(met.where(F.col("n") > crowd).select(F.col("first").alias("a"), F.col("rep").alias("b"))) \
        .withColumnRenamed("id", "rep").withColumnRenamed("component", "crowd").checkpoint()
    entries = met.where(F.col("n") <= crowd).select("key", "rep", "set_1")
    entries = entries.join(classes.select("rep", "set_1", "signature").join(crowds, "rep", "left"), ["rep", "set_1"]).checkpoint()
    x = entries.select("key", *[F.col(c).alias(f"{c}_a") for c in ("rep", "crowd", "signature")])
    y = entries.select("key", *[F.col(c).alias(f"{c}_b") for c in ("rep", "crowd", "signature")])
    # a pair of one crowd is compared there
    pairs = (x.join(y, "key").where("rep_a < rep_b and not coalesce(crowd_a = crowd_b, false)")
             .where(_distance("signature_a", "signature_b") <= MAX_DISTANCE)
             .select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct().checkpoint())

    needed = pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))) \
        .unionByName(crowds.select("rep")).distinct().checkpoint()
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text").join(needed, "rep")
    shingled = texts.mapInArrow(_sets, "rep long, size long, shingles binary").where("size > 0").checkpoint()
    confirmed = (pairs.join(shingled.select(F.col("rep").alias("a"), F.col("shingles").alias("one")), "a")
                 .join(shingled.select(F.col("rep").alias("b"), F.col("shingles").alias("two")), "b")
                 .select("a", "b", "one", "two").mapInArrow(_confirm(percent), "a long, b long"))

    links = confirmed.unionByName(_crowd_links(crowds, shingled, percent))
    # the copies of a class are linked to its representative
    rooted = connected_components(links).withColumnRenamed("id", "rep").checkpoint()
    labelled = classes.select(*sets, "rep").join(rooted, "rep", "left") \
        .select(*sets, F.coalesce("component", "rep").alias("component_id")).checkpoint()
    out = signed.drop("signature").join(labelled, sets, "left") \
        .withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def _distance(a: str, b: str):
    """Number of symbols in which two signatures differ (hex digits of four)."""
    x, y = F.hex(a), F.hex(b)
    return sum((F.substring(x, 4 * k + 1, 4) != F.substring(y, 4 * k + 1, 4)).cast("int") for k in range(SYMBOLS))


def _crowd_links(crowds: DataFrame, shingled: DataFrame, percent: int) -> DataFrame:
    """Verified links within each crowd: its classes are dealt into blocks of
    about BLOCK_SHINGLES shingles or BLOCK_SETS sets and each pair of blocks is one small task."""
    inside = shingled.join(crowds, "rep").checkpoint()
    blocks = inside.groupBy("crowd").agg(F.ceil(F.greatest(F.sum("size") / BLOCK_SHINGLES, F.count("*") / BLOCK_SETS)).cast("int").alias("blocks")).checkpoint()
    dealt = inside.join(blocks, "crowd").withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
    # block i meets every block j: the row goes to (min, max); side 2 is a block with itself
    meets = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("crowd", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1).alias("side"),
                "rep", "shingles")
    # one column names the pair of blocks: rows that are dealt by crowd would all count as grouped already
    task = F.concat_ws("-", "crowd", "i", "j")
    return meets.select(task.alias("task"), "side", "rep", "shingles").groupBy("task").applyInArrow(_compare_blocks(percent), "a long, b long")
