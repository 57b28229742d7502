"""Conversation prefix trie by composable fingerprints.

A run of turns has a fingerprint in a monoid: (k, s) for k turns, with
s = v1*B + v2*B^2 + ... modulo a prime (v: hashes of role and text), and
(k, s)(l, t) = (k + l, s + B^k * t). Prefix fingerprints of the original
conversations are scanned once, piece by piece of a sorted table, so that a
conversation of any length is split over tasks. A rebuilt conversation, the
head of its base followed by its own later turns, is never put together: the
fingerprint of each of its prefixes follows from the base's and its own by
the product and a division by B^k. Rebuilt prefixes with one fingerprint and
depth are one node; every node's last turns are compared in full through
the turn references the members carry, and another salt is taken if two differ.

A node belongs to its smallest member. So every conversation owns a path of
nodes, and a sum over a subtree is a sum over the members of its top: what
each member owns, less what the smallest one owns above.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.shipping import written

PRIME = (1 << 31) - 1
#: One base for each of three independent lanes: 93 bits in all.
BASES = (1_103_515_245, 1_566_083_941, 1_812_433_253)
LANES = range(len(BASES))
KEY = ["depth", *[f"f{i}" for i in LANES]]
PARENT = ["depth", *[f"p{i}" for i in LANES]]
#: Ids of one packed row of members.
CHUNK = 512
HEAD = 8


def head_length(conv_id) -> Column:
    """Turns that a conversation takes from its base."""
    return F.pmod(F.crc32(F.col(conv_id).cast("string").cast("binary")), F.lit(HEAD + 1)).cast("long")


def _mod(x: Column) -> Column:
    return F.pmod(x, F.lit(PRIME))


def _power(lane: int, exponent: Column) -> Column:
    """B^exponent by squaring: as many steps as the exponent has bits."""
    squares = [pow(BASES[lane], 1 << bit, PRIME) for bit in range(62)]
    table = F.expr("array(" + ", ".join(f"{x}L" for x in squares) + ")")
    bits = F.sequence(F.lit(0), F.length(F.bin(exponent)) - 1)
    return F.aggregate(bits, F.lit(1).cast("long"), lambda acc, bit: F.when(
        F.call_function("shiftright", exponent, bit).bitwiseAND(F.lit(1).cast("long")) == 1,
        _mod(acc * F.element_at(table, bit + 1))).otherwise(acc))


def _small_power(lane: int, exponent: Column, sign: int = 1) -> Column:
    """B^exponent or its inverse for exponents up to the head length."""
    base = BASES[lane] if sign > 0 else pow(BASES[lane], -1, PRIME)
    table = F.expr("array(" + ", ".join(f"{pow(base, k, PRIME)}L" for k in range(HEAD + 1)) + ")")
    return F.element_at(table, exponent.cast("int") + 1)


def scan_turns(conversations: DataFrame, salt: int = 0) -> DataFrame:
    """conv_id, turn, tie, pos (1 for the first), bytes, s0.. (fingerprint up
    to the turn) and t0.. (the turn's own part of it) per turn.

    Turns are sorted over the whole table; each piece of the sorted table is
    scanned for itself and the products of a conversation's earlier pieces
    (at most two rows a piece) are put before it."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role, text) \
        .where("conv_id is not null")
    turns = turns.select("conv_id", "turn", F.xxhash64("role", "text").alias("tie"), F.octet_length("text").cast("long").alias("bytes"),
                         *[_mod(F.xxhash64(F.lit(salt * 8 + i + 1), "role", "text")).alias(f"v{i}") for i in LANES])
    order = [F.col("turn").asc_nulls_first(), F.col("tie")]
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    run = Window.partitionBy("piece", "conv_id").orderBy(*order)
    local = turns.repartitionByRange(n, "conv_id", *order).withColumn("piece", F.spark_partition_id()) \
        .withColumn("i", F.row_number().over(run).cast("long")) \
        .select("*", *[_mod(F.col(f"v{i}") * _power(i, F.col("i"))).alias(f"t{i}") for i in LANES]) \
        .select("*", *[_mod(F.sum(f"t{i}").over(run.rowsBetween(Window.unboundedPreceding, 0))).alias(f"s{i}") for i in LANES]) \
        .drop(*[f"v{i}" for i in LANES])
    local = written(local, "turn-pieces")
    totals = local.groupBy("piece", "conv_id").agg(F.count("*").alias("k"), *[F.max_by(f"s{i}", "i").alias(f"s{i}") for i in LANES])
    edges = totals.groupBy("piece").agg(F.array_distinct(F.array(F.min("conv_id"), F.max("conv_id"))).alias("ids"))
    split = edges.select(F.explode("ids").alias("conv_id")).groupBy("conv_id").count().where("count > 1").select("conv_id")
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.join(F.broadcast(split), "conv_id") \
        .withColumn("k0", F.coalesce(F.sum("k").over(before), F.lit(0).cast("long"))) \
        .select("piece", "conv_id", "k0", *[_mod(F.col(f"s{i}") * _power(i, F.col("k0"))).alias(f"m{i}") for i in LANES]) \
        .select("piece", "conv_id", "k0", *[F.coalesce(_mod(F.sum(f"m{i}").over(before)), F.lit(0).cast("long")).alias(f"c{i}") for i in LANES])
    # at most two rows a piece
    joined = local.join(F.broadcast(carry), ["piece", "conv_id"], "left")
    after = lambda c, i: F.when(F.coalesce("k0", F.lit(0)) == 0, F.col(c)).otherwise(_mod(F.col(c) * _power(i, F.col("k0"))))
    return joined.select("conv_id", "turn", "tie", (F.col("i") + F.coalesce("k0", F.lit(0))).alias("pos"), "bytes",
                         *[_mod(after(f"s{i}", i) + F.coalesce(f"c{i}", F.lit(0))).alias(f"s{i}") for i in LANES],
                         *[after(f"t{i}", i).alias(f"t{i}") for i in LANES])


def rebuilt_prefixes(turns: DataFrame) -> DataFrame:
    """One row per rebuilt conversation and depth (0 to its length): conv_id,
    depth, f0.. (fingerprint), p0.. (that of the prefix before), bytes of the
    last text, is_end, and the reference (ref_conv, ref_pos) of the last turn."""
    lanes = [f"s{i}" for i in LANES]
    h = head_length("conv_id")
    own = turns.groupBy("conv_id").agg(F.count("*").alias("n"), *[
        F.coalesce(F.max(F.when(F.col("pos") == h, F.col(s))), F.lit(0).cast("long")).alias(f"own_{s}") for s in lanes])
    heads = turns.where(f"conv_id % 5 = 0 and pos <= {HEAD}").groupBy(F.col("conv_id").alias("base")) \
        .agg(F.array_sort(F.collect_list(F.struct("pos", "bytes", *lanes))).alias("all"))
    convs = own.withColumn("h", h).withColumn("base", F.expr("conv_id - conv_id % 5")).join(heads, "base", "left")
    convs = convs.withColumn("head", F.filter(F.coalesce("all", F.array().cast(heads.schema["all"].dataType)), lambda x: x["pos"] <= F.col("h"))) \
        .withColumn("k", F.size("head").cast("long")).withColumn("length", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))) \
        .select("conv_id", "base", "h", "k", "length", "head", *[f"own_{s}" for s in lanes],
                *[F.when(F.col("k") > 0, F.col("head")[F.col("k").cast("int") - 1][s]).otherwise(0).alias(f"head_{s}") for s in lanes])
    convs = written(convs, "conversation-heads")
    zero = F.lit(0).cast("long")
    roots = convs.select("conv_id", zero.alias("depth"), *[zero.alias(f"f{i}") for i in LANES], *[zero.alias(f"p{i}") for i in LANES],
                         zero.alias("bytes"), (F.col("length") == 0).alias("is_end"), zero.alias("ref_conv"), zero.alias("ref_pos"))
    at = F.col("i").cast("int")
    in_head = convs.select("conv_id", "base", "length", "head", F.posexplode("head").alias("i", "turn")).select(
        "conv_id", F.col("turn.pos").alias("depth"), *[F.col(f"turn.{s}").alias(f"f{i}") for i, s in enumerate(lanes)],
        *[F.when(at > 0, F.col("head")[F.greatest(at - 1, F.lit(0))][s]).otherwise(0).alias(f"p{i}") for i, s in enumerate(lanes)],
        F.col("turn.bytes").alias("bytes"), (F.col("turn.pos") == F.col("length")).alias("is_end"),
        F.col("base").alias("ref_conv"), F.col("turn.pos").alias("ref_pos"))
    small = convs.select("conv_id", "h", "k", "length", *[f"own_{s}" for s in lanes], *[f"head_{s}" for s in lanes])

    def moved(i: int, upto: Column) -> Column:
        """head product times the own turns after the h-th, up to the given own product"""
        run = _mod(_mod(upto - F.col(f"own_s{i}")) * _small_power(i, F.col("h") - F.col("k"), -1))
        return _mod(F.col(f"head_s{i}") + run)

    after = turns.where(F.col("pos") > h).join(small, "conv_id").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("depth"), *[moved(i, F.col(f"s{i}")).alias(f"f{i}") for i in LANES],
        *[moved(i, F.col(f"s{i}") - F.col(f"t{i}")).alias(f"p{i}") for i in LANES], "bytes",
        (F.col("pos") - F.col("h") + F.col("k") == F.col("length")).alias("is_end"), F.col("conv_id").alias("ref_conv"), F.col("pos").alias("ref_pos"))
    return roots.unionByName(in_head).unionByName(after)


def differing_groups(members: DataFrame, nodes: DataFrame, turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """Nodes whose members' last turns are not all equal: role and text of every
    distinct reference of a node with more than one are read and compared. (Equal
    fingerprints and equal last turns make the prefixes before equal, too.)"""
    mixed = nodes.where("ref_conv_low < ref_conv_high or ref_pos_low < ref_pos_high").select(*KEY)
    refs = members.where("depth > 0").select(*KEY, "ref_conv", "ref_pos").distinct().join(mixed, KEY, "left_semi")
    named = refs.join(turns.select(F.col("conv_id").alias("ref_conv"), F.col("pos").alias("ref_pos"), "turn", "tie"), ["ref_conv", "ref_pos"])
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    texts = conversations.select(F.col("conv_id").cast("long").alias("ref_conv"), F.col("turn").cast("long").alias("at"),
                                 F.xxhash64(role, text).alias("tie"), F.struct(role.alias("role"), text.alias("text")).alias("said"))
    found = named.join(texts, ["ref_conv", "tie"]).where("turn <=> at")
    return found.groupBy(*KEY).agg(F.min("said").alias("low"), F.max("said").alias("high")).where("low != high")


def _pack(keys: list[str]):
    """Sorted (key, conv_id) rows to rows of up to CHUNK ids of one key: first id, ids joined by commas."""
    def pack(batches):
        for batch in batches:
            rows = list(zip(*[batch.column(k).to_pylist() for k in keys]))
            ids = batch.column("conv_id").to_pylist()
            out, at = [], 0
            while at < len(ids):
                end = at + 1
                while end < len(ids) and end - at < CHUNK and rows[end] == rows[at]:
                    end += 1
                out.append((*rows[at], ids[at], ",".join(map(str, ids[at:end]))))
                at = end
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i == len(keys) + 1 else pa.int64())
                                                  for i, c in enumerate(zip(*out))], names=[*keys, "first", "ids"])
    return pack


def _digest(keys: list[str]):
    """Packed rows, sorted by key and first id, to one SHA-256 per key; one packed row is held at a time."""
    def digest(batches):
        now, sha, done = None, None, []
        for batch in batches:
            for *key, ids in zip(*[batch.column(k).to_pylist() for k in [*keys, "ids"]]):
                if key != now:
                    if now is not None:
                        done.append((*now, sha.hexdigest()))
                    now, sha = key, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=[*keys, "ends_sha256"])
                done = []
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*[(*now, sha.hexdigest())])], names=[*keys, "ends_sha256"])
    return digest


def end_digests(members: DataFrame) -> DataFrame:
    """KEY, ends_sha256: the digest of the ids that end at each node. Ids are
    sorted over the whole table and packed first, so a node with any number
    of ends streams through one task as packed rows."""
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lanes = KEY[1:]
    ends = members.where("is_end").select(*KEY, "conv_id").repartitionByRange(n, *lanes, "depth", "conv_id") \
        .sortWithinPartitions(*lanes, "depth", "conv_id")
    columns = ", ".join(f"{k} long" for k in KEY)
    packed = ends.mapInArrow(_pack(KEY), f"{columns}, first long, ids string")
    return packed.repartition(n, *KEY).sortWithinPartitions(*KEY, "first").mapInArrow(_digest(KEY), f"{columns}, ends_sha256 string")


def owned_above(nodes: DataFrame) -> DataFrame:
    """KEY, above: what the node's owner (its smallest member) saves in nodes
    of its own above this one. Paths are scanned piece by piece like the turns."""
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    run = Window.partitionBy("piece", "conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    local = written(nodes.select(*KEY, "conv_id", "saves").repartitionByRange(n, "conv_id", "depth").withColumn("piece", F.spark_partition_id())
                    .withColumn("above", F.coalesce(F.sum("saves").over(run), F.lit(0).cast("long"))), "path-pieces")
    totals = local.groupBy("piece", "conv_id").agg(F.sum("saves").alias("total"))
    edges = totals.groupBy("piece").agg(F.array_distinct(F.array(F.min("conv_id"), F.max("conv_id"))).alias("ids"))
    split = edges.select(F.explode("ids").alias("conv_id")).groupBy("conv_id").count().where("count > 1").select("conv_id")
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.join(F.broadcast(split), "conv_id").select("piece", "conv_id", F.sum("total").over(before).alias("earlier"))
    return local.join(F.broadcast(carry), ["piece", "conv_id"], "left") \
        .select(*KEY, (F.col("above") + F.coalesce("earlier", F.lit(0))).alias("above"))


def prefix_nodes(conversations: DataFrame, salt: int = 0) -> tuple[DataFrame, DataFrame]:
    """(members, nodes): the rebuilt prefixes and their groups, verified."""
    while True:
        turns = written(scan_turns(conversations, salt), "turns")
        members = written(rebuilt_prefixes(turns), "prefixes")
        nodes = written(members.groupBy(*KEY).agg(
            F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"),
            *[F.min(f"p{i}").alias(f"p{i}") for i in LANES], *[f(c).alias(f"{c}_{s}") for c in ("ref_conv", "ref_pos") for f, s in ((F.min, "low"), (F.max, "high"))]),
            "prefix-nodes")
        if not differing_groups(members, nodes, turns, conversations).head(1):
            return members, nodes
        salt += 1


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256 per node of the trie of rebuilt
    conversations (conv_id, turn, role, text).

    Turns are ordered by turn, null first; equal turn numbers by a hash of
    role and text, so that the order doesn't depend on the layout of the table.
    Null roles and texts are empty; rows without conv_id are ignored; repeated
    rows are turns of their own; other columns are ignored; an empty table
    gives no rows, otherwise the root (depth 0) is always there.
    """
    members, nodes = prefix_nodes(conversations)
    nodes = nodes.select(*KEY, *PARENT[1:], "conv_id", "n_convs", ((F.col("n_convs") - 1) * F.col("bytes")).alias("saves"))
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), *[F.col(f"p{i}").alias(f"f{i}") for i in LANES]) \
        .agg(F.count("*").alias("n_children"))
    nodes = written(nodes.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "counted-nodes")
    owners = written(nodes.groupBy("conv_id").agg(F.sum("saves").alias("owned"), F.count(F.when(F.col("n_children") == 0, 1)).alias("leaves")), "owners")
    below = members.select(*KEY, "conv_id").join(owners, "conv_id").groupBy(*KEY).agg(
        F.sum("owned").alias("owned"), F.sum("leaves").alias("n_leaves"))
    full = nodes.join(below, KEY).join(owned_above(nodes), KEY).join(end_digests(members), KEY, "left")
    full = written(full.withColumn("saved_tokens", F.col("owned") - F.col("above")), "trie")
    parents = full.select((F.col("depth") + 1).alias("depth"), *[F.col(f"f{i}").alias(f"p{i}") for i in LANES], F.col("conv_id").alias("parent_conv_id"))
    return full.join(parents, PARENT, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
