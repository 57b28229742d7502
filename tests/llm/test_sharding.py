"""Sharding: laws, gapless slots, and the map's versions."""

import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from quarry.llm import sharding as S
from quarry.session import scratch_path


def table(spark, rows):
    return spark.createDataFrame([(d, t, "k", 0) for d, t in rows], "doc_id long, text string, shard string, slot int").repartition(3)


def placed(spark, rows, shards=24):
    return [r.asDict() for r in S.assign(table(spark, rows), shards, scratch_path(spark, "slots")).collect()]


def test_bytes_law_on_many_rows(spark):
    rows = [(i, "é" * (i * 37 % 400)) for i in range(3000)]
    out = placed(spark, rows)
    texts, loads, slots = dict(rows), defaultdict(int), defaultdict(list)
    for r in out:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 8, zlib.crc32(raw))
        assert r["law"] == "bytes" and r["grown_shard"] is None and r["version"] == 2
        loads[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert sorted(loads) == list(range(24))
    assert max(loads.values()) - min(loads.values()) <= 0.01 * sum(loads.values()) / 24
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_greedy_by_bytes_matches_plain_python(spark):
    rows = [(i, "x" * (i * i % 5003)) for i in range(200)]
    slotted = S.with_slots(table(spark, rows), 64).cache()
    totals = {r["virtual_slot"]: r["bytes"] for r in S.slot_totals(slotted).collect()}
    loads, want = [0] * 5, {}
    for slot, size in sorted(totals.items(), key=lambda x: (-x[1], x[0])):
        want[slot] = loads.index(min(loads))
        loads[want[slot]] += size
    got = {r["virtual_slot"]: r["shard"] for r in S.rebalanced(S.first_map(spark, 5, 64), S.slot_totals(slotted), 5).collect()}
    assert {s: got[s] for s in want} == want
    assert len(got) == 64 and all(got[s] == s % 5 for s in got if s not in want)


def test_growing_moves_slots_only_into_the_new_shard(spark):
    old = S.first_map(spark, 24)
    new = S.grown(old, 24)
    pairs = old.join(new.withColumnRenamed("shard", "to"), "virtual_slot").select("shard", "to").collect()
    assert all(r["to"] in (r["shard"], 24) for r in pairs)
    moved = sum(r["to"] == 24 for r in pairs)
    assert abs(moved - S.SLOTS / 25) <= 24
    path = scratch_path(spark, "map")
    S.save_map(old, path)
    S.save_map(new, path)
    assert S.load_map(spark, path).agg(F.max("version")).first()[0] == 2
    assert S.load_map(spark, path, 1).count() == S.load_map(spark, path, 2).count() == S.SLOTS


def test_nulls_ties_and_empty_tables(spark):
    rows = [(None, None), (None, ""), (1, None), (1, None), (1, "a" * 100_000), (2, "b")]
    out = placed(spark, rows, 3)
    assert len(out) == 6 and {r["shard"] for r in out} <= {0, 1, 2}
    by = defaultdict(list)
    for r in out:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert sorted(r["size"] for r in out) == [8, 8, 8, 8, 9, 100_008]
    assert placed(spark, [], 3) == []
