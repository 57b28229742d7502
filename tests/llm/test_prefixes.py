"""The prefix trie against a plain Python trie over rebuilt conversations."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from quarry.llm.prefixes import differing_groups, prefix_nodes, prefix_trie, rebuilt_prefixes, scan_turns

from tests.conftest import SF_SMALL

SCHEMA = "conv_id long, turn long, role string, text string"


def brute_force(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    ordered = {c: [t[2:] for t in sorted(ts, key=lambda t: t[:2])] for c, ts in convs.items()}
    rebuilt = {}
    for c, own in ordered.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        rebuilt[c] = tuple(ordered.get(base, [])[:h] + own[h:])
    members, ends = {}, {}
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
        ends.setdefault(seq, []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    out = []
    for node, cs in members.items():
        leaves = saved = 0
        for other, theirs in members.items():
            if other[:len(node)] == node:
                leaves += other not in children
                saved += (len(theirs) - 1) * len(other[-1][1].encode()) if other else 0
        digest = hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()
        out.append((min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), len(children.get(node, [])), leaves, saved, digest))
    return sorted(out, key=lambda r: (r[1], r[0]))


def spark_rows(df):
    return sorted([tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                               "saved_tokens", "ends_sha256").collect()], key=lambda r: (r[1], r[0]))


@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations_equal_the_plain_trie(spark, seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-12, 60), 45):
        for t in range(rng.choice([1, 2, 3, 9, 12])):
            rows.append((c, None if t == 0 and rng.random() < 0.3 else t, rng.choice(["user", None, ""]), rng.choice(["a", "é", None, "bb"])))
    rows += [(None, 0, "user", "lost")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("f0", F.lit("clash")).withColumn("depth", F.lit(1)).withColumn("piece", F.lit(2))
    assert spark_rows(prefix_trie(df.repartition(5))) == brute_force(rows)


def test_given_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert spark_rows(prefix_trie(df)) == brute_force(rows)


def test_a_conversation_split_over_pieces(spark):
    """One conversation with most of the rows, a copy of it, and many copies of a short one."""
    long = [(c, t, "user", f"turn {t % 7}") for c in (10, 25) for t in range(300)]
    short = [(c, t, "user", f"hello {t}") for c in range(100, 300) for t in range(2)]
    df = spark.createDataFrame(long + short, SCHEMA)
    assert scan_turns(df).where("conv_id = 10").agg(F.max("pos")).first()[0] == 300
    assert spark_rows(prefix_trie(df)) == brute_force(long + short)


def test_empty_and_single(spark):
    assert prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(5, 0, None, None)]
    assert spark_rows(prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute_force(rows)


def test_equal_fingerprints_with_different_turns_are_found(spark):
    """Force two different turns into one group: the references tell them apart."""
    rows = [(c, 0, "user", f"text {c}") for c in (100, 105)]
    df = spark.createDataFrame(rows, SCHEMA)
    turns = scan_turns(df)
    members = rebuilt_prefixes(turns)
    forged = members.withColumns({f"f{i}": F.lit(7).cast("long") for i in range(3)})
    nodes = forged.groupBy("depth", "f0", "f1", "f2").agg(*[f(c).alias(f"{c}_{s}") for c in ("ref_conv", "ref_pos")
                                                          for f, s in ((F.min, "low"), (F.max, "high"))])
    expected = 1 if members.where("depth = 1").count() == 2 else 0
    assert differing_groups(forged, nodes, turns, df).count() == expected
    _, honest = prefix_nodes(df)
    assert honest.where("depth = 1").count() == members.where("depth = 1").count()
