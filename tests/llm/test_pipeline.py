"""The pipeline: each stage against brute force on its own input."""

import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline as P
from quarry.llm.bpe import Ranks
from quarry.session import scratch_path
from test_decontam import brute as contaminated
from test_minhash import shingle_set

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """The rows of each stage, the input first."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [{r.doc_id: r.asDict() for r in docs.collect()}]
    for name, stage in P.STAGES:
        path = scratch_path(spark, f"test-{name}")
        stage(spark, docs, SF).write.parquet(path)
        got = spark.read.parquet(path)
        if name != "bpe_encoding":
            assert got.columns == docs.columns
        docs = got
        rows = docs.collect()
        out.append({r.doc_id: r.asDict() for r in rows})
        assert len(out[-1]) == len(rows)
    return out


def test_language_stage_keeps_every_text_with_letters(kept):
    assert set(kept[1]) == {d for d, r in kept[0].items() if r["text"] and re.search(r"[^\W\d_]", r["text"])}


def test_near_dedup_keeps_one_of_each_group(kept):
    sets = {d: shingle_set(r["text"]) for d, r in kept[1].items()}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    assert set(kept[2]) == {d for d in sets if find(d) == d}
    assert len(kept[2]) < len(kept[1])


def grams(text, n):
    w = re.sub("[A-Z]+", lambda m: m[0].lower(), text).split()
    return [tuple(w[i:i + n]) for i in range(len(w) - n + 1)]


def test_no_passage_of_50_words_is_left_twice(kept):
    first = {}
    for d in sorted(kept[2]):
        for g in grams(kept[2][d]["text"], 50):
            first.setdefault(g, d)
    for d, row in kept[3].items():
        before = kept[2][d]["text"]
        repeats = [g for g in set(grams(before, 50)) if first[g] != d]
        assert not set(grams(row["text"], 50)) & set(repeats)
        near = {g for g in grams(before, 5)} & {g for e in kept[2] if e < d for g in grams(kept[2][e]["text"], 5)}
        if len(near) < 40:  # nothing near a passage: left alone
            assert row["text"] == before
    assert set(kept[3]) == set(kept[2])


def test_decontamination_drops_by_the_rule(spark, kept):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    judged = contaminated([(d, r["text"]) for d, r in kept[3].items()], items)
    assert set(kept[4]) == {r[0] for r in judged if not r[-1]} and len(kept[4]) < len(kept[3])
    assert all(kept[4][d] == kept[3][d] for d in kept[4])


def test_encoding_equals_the_library(kept):
    ranks = Ranks.of_file(public_tokenizers.path("byte_bpe_50k.tiktoken")).ranks
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert set(kept[5]) == set(kept[4])
    for d, row in kept[5].items():
        ids = np.array(reference.encode_ordinary(kept[4][d]["text"]), "<u4").tobytes()
        assert bytes(row["ids"]) == ids and row["ids_sha256"] == hashlib.sha256(ids).hexdigest() and row["n_tokens"] * 4 == len(ids)
        assert row["decoded_sha256"] == hashlib.sha256(kept[4][d]["text"].encode()).hexdigest()


def test_odd_rows_pass_every_stage(spark):
    rows = [(1, None, None, None, None), (2, "", "en", None, 0), (None, "some words here", "en", None, 15), (3, "some words here", "en", "s", 15), (3, "some words here", "en", "s", 15)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for part in (docs, docs.limit(0)):
        for name, stage in P.STAGES:
            out = stage(spark, part, SF)
            assert out.count() <= part.count()
            if name != "bpe_encoding":
                assert out.columns == docs.columns


def test_rows_that_share_a_doc_id_are_judged_by_their_own_text(spark):
    """Extra columns with the operators' own names, one doc_id on two texts, through the stages."""
    words = lambda tag, n: " ".join(f"{tag}word{i} the and" for i in range(n))
    same, unique, passage = words("a", 40), words("b", 40), words("c", 60)
    rows = [(1, same), (3, unique), (3, same), (3, unique), (7, words("d", 30) + " " + passage), (9, passage + " " + words("e", 30)), (9, words("f", 35)), (None, same)]
    columns = "doc_id long, text string, lang string, source string, n_chars long, spans string, _doc int, _spans int, held_out int, signature string, row_id_0 int, doc0 int, label int"
    docs = spark.createDataFrame([(d, t, "en", "s", len(t), "x", 1, 2, 3, "y", 4, 5, 6) for d, t in rows], columns)
    deduped = P.near_dedup(spark, docs, SF)
    assert deduped.columns == docs.columns
    left = sorted(((r.doc_id, r.text) for r in deduped.collect()), key=str)
    assert left == sorted({(1, same), (3, unique), *rows[4:]}, key=str)
    cut = {(r.doc_id, r.text.split()[0]): (r.text, r.n_chars, r.spans, r._spans) for r in P.substring_dedup(spark, deduped, SF).collect()}
    assert len(cut) == len(left)
    kept = cut[9, "eword0"]
    assert kept[0].split() == words("e", 30).split() and kept[1:] == (len(kept[0]), "x", 2)
    assert cut[7, "dword0"][0] == rows[4][1] and cut[9, "fword0"][0] == rows[6][1] and cut[None, "aword0"][0] == same
    for stage in (P.language_id, P.benchmark_decontamination):
        assert stage(spark, docs, SF).columns == docs.columns


def test_a_task_of_the_last_stage_holds_one_python_worker(spark):
    # an encoder and a decoder in one task made two workers a core, which stayed for all stages after it
    docs = spark.createDataFrame([(1, "One text and\tanother."), (2, None)], "doc_id long, text string")
    out = P.bpe_encoding(spark, docs, SF)
    assert str(out._jdf.queryExecution().executedPlan()).count("MapInArrow") == 1
    rows = {r.doc_id: r for r in out.collect()}
    ranks = Ranks.of_file(public_tokenizers.path("byte_bpe_50k.tiktoken")).ranks
    ids = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary("One text and\tanother.")
    assert np.frombuffer(rows[1].ids, "<u4").tolist() == ids and rows[1].n_tokens == len(ids)
    assert rows[2].n_tokens == 0 and rows[2].decoded_sha256 == hashlib.sha256(b"").hexdigest()
