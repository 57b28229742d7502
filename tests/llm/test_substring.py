"""Substring dedup: compact windows against all subsequences, passages against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import substring
from quarry.llm.substring import compact_windows, dense_segments, remove_passages, repeated_passages, verified_passages

SCHEMA = "doc_id long, text string, key long, doc long, span string"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 1, 2, "x") for d, t in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("top", [5, 1000])
def test_windows_partition_all_long_runs(top):
    rng = np.random.default_rng(top)
    counts = np.array([30, 0, 7, 12, 1, 40])
    values = rng.integers(1, top, counts.sum()).astype(np.uint64)
    row, low, centre, high = compact_windows(values, counts, 7)
    at = np.concatenate([[0], np.cumsum(counts)])
    for r, n in enumerate(counts):
        x = values[at[r]:at[r + 1]]
        own = [w[1:] for w in zip(row.tolist(), low.tolist(), centre.tolist(), high.tolist()) if w[0] == r]
        for i in range(n):
            for j in range(i + 6, n):
                least = [w for w in own if w[0] <= i and j <= w[2] and x[w[1]] == x[i:j + 1].min()]
                assert least, (r, i, j)
        if len(set(x.tolist())) == n:
            assert sum((c - lo + 1) * (hi - c + 1) for lo, c, hi in own) >= sum(n - k for k in range(6, n))


def test_dense_segments():
    assert dense_segments(np.array([1, 1, 1, 0, 1, 1, 1, 0, 0, 0, 0, 1], bool), 0.8, 1) == [(0, 6), (11, 11)]
    assert dense_segments(np.zeros(0, bool), 0.5, 1) == [] and dense_segments(np.zeros(4, bool), 0.9, 1) == []
    rng = np.random.default_rng(0)
    for _ in range(50):
        hit = rng.random(40) < 0.7
        share = lambda i, j: hit[i:j + 1].mean()
        longest = max((j - i + 1 for i in range(40) for j in range(i, 40) if hit[i] and hit[j] and share(i, j) >= 0.85), default=0)
        got = dense_segments(hit, 0.85, 5)
        assert all(share(i, j) >= 0.85 - 1e-9 and hit[i] and hit[j] and j - i >= 4 for i, j in got)
        assert max((j - i + 1 for i, j in got), default=0) == (longest if longest >= 5 else 0)


def test_verification_needs_length_and_likeness():
    base = np.arange(100, dtype=np.uint32)
    assert verified_passages(base, base[20:70], 46, 0.8) == [(0, 49, 20, 69, 1.0)]
    assert verified_passages(base, base[20:60], 46, 0.8) == []
    mixed = base[10:90].copy()
    mixed[::3] = 7_000_000
    assert verified_passages(base, mixed, 46, 0.8) == []
    assert verified_passages(base[:0], base, 46, 0.8) == []


def own_words(d, n):
    return [f"d{d}w{i}" for i in range(n)]


def test_planted_passages_are_found_and_clean_texts_are_not(spark):
    rng = random.Random(4)
    shared = [f"s{i}" for i in range(60)]
    near = [w if i != 30 else "changed" for i, w in enumerate(shared)]
    rows = [(d, " ".join(own_words(d, rng.randrange(0, 200)))) for d in range(40)]
    rows += [(100 + d, " ".join(own_words(100 + d, rng.randrange(0, 150)) + (near if d % 5 == 4 else shared) + own_words(900 + d, 9))) for d in range(20)]
    rows += [(200 + d, " ".join(own_words(200 + d, 80) + shared[:30] + own_words(700 + d, 80))) for d in range(6)]  # too short
    got = repeated_passages(frame(spark, rows)).collect()
    assert {r.doc_id for r in got} == set(range(101, 120)) and all(r.source_id < r.doc_id for r in got)
    texts = dict(rows)
    for r in got:
        words = texts[r.doc_id].split()[r.first_word:r.first_word + r.n_words]
        assert set(words) <= set(shared) | {"changed"} and len(words) >= 50 and r.similarity >= 0.8


def test_copies_make_a_star_and_cutting_keeps_the_first(spark):
    text = "AÉ start\n" + " ".join(f"w{i}" for i in range(120)) + "\t end"
    rows = [(i, text) for i in range(30)] + [(50, "own beginning, " + " ".join(f"w{i}" for i in range(120)) + " own end"), (51, None), (51, None)]
    df = frame(spark, rows)
    passages = repeated_passages(df).cache()
    assert passages.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 8
    assert {r.doc_id for r in passages.collect()} == {*range(1, 30), 50}
    left = {r.doc_id: r.text for r in remove_passages(df, passages).collect()}
    assert left[0] == text and left[51] is None and left[50] == "own beginning,  own end"
    assert all(left[i].split() == [] for i in range(1, 30))
    assert remove_passages(df, passages).schema == df.schema and remove_passages(df, passages).count() == len(rows)


def test_edges(spark):
    long = " ".join(f"x{i}" for i in range(60_000))
    same = "Nd " * 5000
    rows = [(1, None), (2, ""), (3, "few words"), (4, long), (5, "before " + long), (6, same), (7, same), (8, same), (8, same), (None, long)]
    got = {(r.doc_id, r.source_id) for r in repeated_passages(frame(spark, rows)).collect()}
    assert {g[0] for g in got} == {5, 7, 8} and {(5, 4), (7, 6), (8, 6)} <= got
    assert repeated_passages(frame(spark, [])).collect() == []


def test_one_function_nominates_a_near_passage(spark):
    rows = []
    for d in range(300):  # 56 and 56 tokens, 51 of them common: a similarity of 0.836
        words = own_words(d, 60)
        rows += [(d, " ".join(own_words(10_000 + d, 40) + words)), (1000 + d, " ".join(words[:24 + d % 12] + ["other"] + words[25 + d % 12:] + own_words(20_000 + d, 40)))]
    got = {(r.doc_id, r.source_id) for r in repeated_passages(frame(spark, rows)).collect()}
    assert got == {(1000 + d, d) for d in range(300)}


def test_decoys_hide_no_exact_repeat(spark):
    """Pairs that share a passage of 60 words, each among ten documents that hold 45-word parts of it (too
    short to count): every pair is found, and so is every run of 50 words that comes again (all pairs compared)."""
    rng = random.Random(11)
    ids = list(range(60 * 12 + 40))
    rng.shuffle(ids)
    rows, pairs = [], set()
    for p in range(60):
        passage = [f"p{p}x{i}" for i in range(60)]
        a, b = ids.pop(), ids.pop()
        pairs.add((min(a, b), max(a, b)))
        parts = [(a, passage), (b, passage)] + [(ids.pop(), passage[s:s + 45]) for s in (rng.randrange(16) for _ in range(10))]
        rows += [(d, " ".join(own_words(d, rng.randrange(30, 90)) + part + own_words(d + 100_000, rng.randrange(30, 90)))) for d, part in parts]
    often = [f"often{i}" for i in range(70)]  # one passage in many documents, and a common phrase around others
    rows += [(ids.pop(), " ".join(own_words(d + 200_000, 40) + (often if d % 2 else often[:20]) + own_words(d + 300_000, 40))) for d in range(40)]
    got = repeated_passages(frame(spark, rows)).collect()
    assert pairs <= {(r.source_id, r.doc_id) for r in got}
    covered = {}
    for r in got:
        covered.setdefault(r.doc_id, set()).update(range(r.first_word, r.first_word + r.n_words))
    first = {}
    for d, text in sorted(rows):
        w = text.split()
        for i in range(len(w) - 49):
            run = tuple(w[i:i + 50])
            if first.setdefault(run, d) != d:
                assert set(range(i, i + 50)) <= covered.get(d, set()), (d, i)
    assert {r.doc_id for r in got} == {b for _, b in pairs} | {d for d, t in rows if "often69" in t and d != min(e for e, u in rows if "often69" in u)}


def runs_that_come_again(rows, n=50):
    """{doc: word places} of the runs of n words that a smaller doc_id has, too."""
    first, out = {}, {}
    for d, text in sorted(rows):
        w = text.split()
        for i in range(len(w) - n + 1):
            if first.setdefault(tuple(w[i:i + n]), d) != d:
                out.setdefault(d, set()).update(range(i, i + n))
    return out


@pytest.mark.parametrize("block, wide", [(None, None), (16, 64), (16, 0)])
def test_a_crowd_around_a_phrase_hides_no_repeat(spark, monkeypatch, block, wide):
    """332 documents have one phrase of 45 words. Around it 60 pairs share a passage of 60 words, and 60
    other pairs one in which a word is another one; groups of four share parts of a longer passage."""
    if block:  # a large crowd: representatives of blocks meet again
        monkeypatch.setattr(substring, "BLOCK", block)
        monkeypatch.setattr(substring, "WIDE", wide)
    rng = random.Random(5)
    phrase = [f"phrase{i}" for i in range(45)]
    ids = list(range(1000))
    rng.shuffle(ids)
    rows, pairs, near = [], set(), set()

    def add(words):
        d = ids.pop()
        rows.append((d, " ".join(own_words(d, rng.randrange(20, 60)) + words + own_words(d + 10_000, rng.randrange(20, 60)))))
        return d

    for p in range(60):
        at = rng.randrange(16)
        passage = [f"p{p}x{i}" for i in range(at)] + phrase + [f"p{p}x{i}" for i in range(at, 15)]
        pairs.add(tuple(sorted((add(passage), add(passage)))))
        other = [f"q{p}x{i}" for i in range(at)] + phrase + [f"q{p}x{i}" for i in range(at, 15)]
        changed = list(other)
        changed[at - 1 if at > 7 else at + 45] = f"changed{p}"
        near.add(tuple(sorted((add(other), add(changed)))))
    for p in range(8):  # each two of them have other words in common
        long = [f"r{p}x{i}" for i in range(30)] + phrase + [f"r{p}x{i}" for i in range(30, 60)]
        for cut in (long[:82], long[20:90], long[26:80], long[28:]):
            add(cut)
    for _ in range(60):
        add(phrase)
    got = repeated_passages(frame(spark, rows)).collect()
    found, covered = {(r.source_id, r.doc_id) for r in got}, {}
    for r in got:
        covered.setdefault(r.doc_id, set()).update(range(r.first_word, r.first_word + r.n_words))
    assert pairs <= found and near <= found
    again = runs_that_come_again(rows)
    assert again and all(places <= covered.get(d, set()) for d, places in again.items())


def test_equal_cores_do_not_hide_a_longer_repeat(spark):
    """The first document of each three has 180 of the 185 words that the others share."""
    rng = random.Random(8)
    rows = []
    for p in range(250):
        passage = [f"p{p}x{i}" for i in range(185)]
        parts = [passage[:180]] + [passage] * 2
        rows += [(3 * p + j, " ".join(own_words(3 * p + j, rng.randrange(5, 60)) + part + own_words(3 * p + j + 10_000, rng.randrange(5, 60)))) for j, part in enumerate(parts)]
    got, covered = repeated_passages(frame(spark, rows)).collect(), {}
    for r in got:
        covered.setdefault(r.doc_id, set()).update(range(r.first_word, r.first_word + r.n_words))
    assert all(places <= covered.get(d, set()) for d, places in runs_that_come_again(rows).items())


def test_crowds_make_few_links(spark):
    """A passage in 600 documents, and a phrase in 600 others: links grow with the documents, not with their pairs."""
    passage, phrase = [f"s{i}" for i in range(56)], [f"phrase{i}" for i in range(20)]
    rows = [(d, " ".join(own_words(d, 70) + (passage if d % 2 else phrase) + own_words(d + 10_000, 70))) for d in range(1200)]
    got = repeated_passages(frame(spark, rows)).collect()
    assert {r.doc_id for r in got} == set(range(3, 1200, 2)) and len({(r.source_id, r.doc_id) for r in got}) < 20 * 600


def test_equal_least_tokens_have_windows_of_their_own():
    """Each run is in one window whose centre is its first least token, so the same run elsewhere has the same centre in it."""
    rng = np.random.default_rng(3)
    counts = np.array([40, 3, 25, 30])
    values = rng.integers(1, 4, counts.sum()).astype(np.uint64)
    values[-30:] = 2
    row, low, centre, high = compact_windows(values, counts, 6)
    at = np.concatenate([[0], np.cumsum(counts)])
    for r, n in enumerate(counts):
        x = values[at[r]:at[r + 1]]
        own = [w[1:] for w in zip(row.tolist(), low.tolist(), centre.tolist(), high.tolist()) if w[0] == r]
        for i in range(n):
            for j in range(i + 5, n):
                assert [c for lo, c, hi in own if lo <= i <= c <= j <= hi] == [i + int(x[i:j + 1].argmin())]


def test_repeats_of_a_least_token_have_few_windows():
    """A word that comes 2,000 times makes a few windows, and so does a line of four words; each run is in a
    window with the same least token and set of tokens, and its start in one's core."""
    rng = np.random.default_rng(4)
    for words in ([7], [7, 8, 9, 7]):
        tokens = substring.mix(np.array([*range(100, 150), *words * 2000, *range(200, 250)], dtype=np.uint64))
        assert all(len(found[0]) < 130 for found in substring._windows_of(tokens, np.array([len(tokens)]), 46))
    width = 7
    for _ in range(60):
        rows = [np.concatenate([np.resize(rng.integers(0, 9, rng.integers(1, 6)), rng.integers(1, 30)) for _ in range(rng.integers(1, 5))]) for _ in range(3)]
        counts = np.array([len(x) for x in rows])
        tokens = substring.mix(np.concatenate(rows).astype(np.uint64) + np.uint64(1))
        at = np.concatenate([[0], np.cumsum(counts)])
        for k, (key, row, low, high, centre, start, end) in enumerate(substring._windows_of(tokens, counts, width)):
            values = substring.mix(tokens ^ substring.seeds(substring.FUNCTIONS, 41)[k])
            for r, n in enumerate(counts):
                x = values[at[r]:at[r + 1]].tolist()
                own = [(lo, hi, c - at[r], a - at[r], b - at[r]) for i, lo, hi, c, a, b in zip(row, low, high, centre, start, end) if i == r]
                for i in range(n - width + 1):
                    for j in range(i + width - 1, n):
                        least, held = min(x[i:j + 1]), set(x[i:j + 1])
                        assert any(x[c] == least and lo <= i and j <= hi and c <= j or lo <= c <= j <= hi and set(x[c:j + 1]) == held for lo, hi, c, _, _ in own)
                    short = x[i:i + width]
                    assert any(x[c] == min(short) and any(set(x[s:s + width]) == set(short) for s in range(a, b - width + 1)) for _, _, c, a, b in own)
                    # what the first function's windows stand for has this very run
                    assert any(x[c] == min(short) and any(x[s:s + width] == short for s in range(max(lo, c - width + 1), min(c, hi - width + 1) + 1)) for lo, hi, c, _, _ in own)


@pytest.mark.parametrize("block, wide", [(None, None), (16, 64), (16, 0)])
def test_a_repeat_of_a_repeat_is_a_source_too(spark, monkeypatch, block, wide):
    """In a crowd around a phrase, the second of each three documents repeats the first one, and the third one
    resembles the second alone."""
    if block:
        monkeypatch.setattr(substring, "BLOCK", block)
        monkeypatch.setattr(substring, "WIDE", wide)
    rng = random.Random(6)
    phrase = [f"phrase{i}" for i in range(45)]
    rows, thirds = [], {}
    for p in range(50):
        left, right = [f"l{p}x{i}" for i in range(20)], [f"r{p}x{i}" for i in range(12)]
        changed = right[:4] + [f"changed{p}"] + right[5:]
        for j, part in enumerate((left + phrase, left + phrase + right, phrase + changed)):
            d = 100 * j + p
            rows.append((d, " ".join(own_words(d, rng.randrange(20, 60)) + part + own_words(d + 10_000, rng.randrange(20, 60)))))
        thirds[200 + p] = 100 + p
    got = {(r.doc_id, r.source_id) for r in repeated_passages(frame(spark, rows)).collect()}
    assert {d for d, _ in got} == set(range(100, 150)) | set(thirds)
    assert set(thirds.items()) <= got and {(100 + p, p) for p in range(50)} <= got


def test_crowds_settled_together_keep_apart():
    """The links of several crowds in one call are those of each alone, though their tokens are the same."""
    rng = np.random.default_rng(9)
    crowds = []
    for n in (2, 30, 5, 17):
        base = rng.integers(0, 1 << 32, 91).astype(np.uint32)
        cores = [np.where(rng.random(91) < rng.choice([0.0, 0.05, 0.4]), rng.integers(0, 1 << 32, 91).astype(np.uint32), base) for _ in range(n)]
        cores += [np.concatenate([c[:50], crowds[-1][0][50:]]) for c in cores[:2]] if crowds else []
        crowds.append(cores)

    def links(some):
        rows = [(i, 0, c.tobytes()) for cores in some for i, c in enumerate(cores)]
        of = np.repeat(np.arange(len(some)), [len(c) for c in some])
        return substring._settled(rows, of, np.ones(len(rows), bool), [np.ones(91, bool) for _ in rows], 46, 0.8)

    each, begin = [], 0
    for cores in crowds:
        each += [(a + begin, b + begin) for a, b in links([cores])]
        begin += len(cores)
    assert len(each) > 20 and sorted(links(crowds)) == sorted(each)


def test_tokens_that_come_again_are_counted_by_parts():
    import pyarrow as pa

    rng = np.random.default_rng(2)
    cores = [rng.integers(0, 400, 91).astype(np.uint32) for _ in range(40)]
    opens = [None if i % 3 else rng.random(91) < 0.1 for i in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array([7] * 40, pa.int64()), pa.array(range(40), pa.int64()), pa.array([0] * 40, pa.int64()), pa.array([c.tobytes() for c in cores]),
                                        pa.array([None if o is None else np.packbits(o).tobytes() for o in opens]), pa.array([2 * substring.PART_BLOCKS + 1] * 40, pa.int32())],
                                       names=["key", "src", "s_span", "tokens", "open", "blocks"])
    parts = pa.Table.from_batches(substring._core_parts(46, 0.8)([batch]))
    assert parts.num_rows <= 3 * 40
    some = [substring._again(parts.filter(pa.compute.equal(parts["part"], p))).to_pylist() for p in range(3)]
    for i, core in enumerate(cores):
        others = set(np.concatenate([c for j, c in enumerate(cores) if j != i]).tolist())
        open_others = set(np.concatenate([c[o] for j, (c, o) in enumerate(zip(cores, opens)) if j != i and o is not None]).tolist())
        mine, own = set(core.tolist()), set(core[opens[i]].tolist()) if opens[i] is not None else set()
        rows = [r for part in some for r in part if r["src"] == i]
        assert sum(r["have"] for r in rows) == len(mine & others)
        assert any(r["is_target"] for r in rows) == bool(own & others) and any(r["is_source"] for r in rows) == bool(mine & open_others)


def test_core_passages_are_the_verified_ones():
    rng = np.random.default_rng(5)
    some = 0
    for n in range(600):
        size, width, similarity = int(rng.integers(46, 92)), int(rng.choice([3, 10, 46])), float(rng.choice([0.5, 0.8, 1.0]))
        source = rng.integers(0, rng.choice([6, 40, 1 << 32]), size).astype(np.uint32)
        at = int(rng.integers(0, 30))
        target = np.concatenate([rng.integers(0, 1 << 32, at).astype(np.uint32), source[int(rng.integers(0, 20)):]])
        for place in rng.integers(0, len(target), int(rng.integers(0, 4))):
            target[place:place + int(rng.integers(1, 6))] = rng.integers(0, 1 << 32)
        wanted = [p[:2] for p in substring.verified_passages(source, target, width, similarity)]
        assert substring.core_passages(substring._core(source), substring._core(target), width, similarity) == wanted
        some += len(wanted)
        # a token of a passage is never left out as one that no passage can hold, past the end of a core or not
        hit = np.concatenate([np.isin(target, source), np.zeros(int(rng.integers(0, 9)), bool)])
        may = substring._coverable(hit[None], 2 * similarity / (1 + similarity), width)[0]
        for first, last in wanted:
            assert may[first:last + 1].all()
    assert some > 300
