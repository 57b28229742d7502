"""Cross-entropy difference against dictionaries in plain Python."""

import math
import re
from collections import Counter

import pytest

import quarry.llm.lm as LM

ROWS = [(i, f"the Cat {'sat' if i % 2 else 'ran'} on the mat, w{i % 5} é{i % 3}!") for i in range(40)]
ROWS += [(100, None), (101, ""), (102, "?!"), (103, "the"), (104, "zzz the " * 5000), (104, "zzz the " * 5000), (None, "the cat")]
GOOD = [1, 3, 5, 7, 104, 999, 3]


def words_of(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def brute(size, strength=100.0):
    docs = [words_of(t) for _, t in ROWS]
    count = Counter(w for d in docs for w in d)
    border = sorted(count.values(), reverse=True)[size - 1] if len(count) >= size else 0
    known = {w for w, n in count.items() if n >= border}
    assert len(known) == min(size, len(count)), "pick a size without a tie at the border"
    docs = [["<s>"] + [w if w in known else "<u>" for w in d] for d in docs]
    target = [d for d, (i, _) in zip(docs, ROWS) if i in GOOD]

    def loss(corpus):
        pairs = Counter((a, b) for d in corpus for a, b in zip(d, d[1:]))
        heads, single = Counter(), Counter()
        for (a, b), n in pairs.items():
            heads[a] += n
            single[b] += n
        total = sum(single.values()) + len(known) + 1
        return lambda a, b: -math.log((pairs[a, b] + strength * (single[b] + 1) / total) / (heads[a] + strength))

    one, two = loss(target), loss(docs)
    out = []
    for (i, _), d in zip(ROWS, docs):
        n = len(d) - 1
        if n:
            a, b = (sum(f(x, y) for x, y in zip(d, d[1:])) / n for f in (one, two))
            out.append((i, n, a, b, a - b))
        else:
            out.append((i, 0, None, None, None))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [2, 4000])
def test_losses(spark, size):
    docs = spark.createDataFrame([(d, t, 1.0, 9) for d, t in ROWS], "doc_id long, text string, score double, n_words int").repartition(5)
    labels = spark.createDataFrame([(d, 1) for d in GOOD] + [(2, 0), (4, None), (None, 1)], "doc_id long, quality int")
    got = sorted((tuple(r) for r in LM.score_by_quality(docs, labels, size).collect()), key=str)
    want = brute(size)
    for g, w in zip(sorted(got, key=lambda r: str(r[:2])), sorted(want, key=lambda r: str(r[:2]))):
        assert g[:2] == w[:2]
        assert g[2:] == (None, None, None) if w[2] is None else g[2:] == pytest.approx(w[2:], rel=1e-5, abs=1e-5)
    assert len(got) == len(want)


def test_merging_in_levels_and_empty_tables(spark, monkeypatch):
    docs = spark.createDataFrame([(d, t) for d, t in ROWS], "doc_id long, text string").repartition(9)
    known = LM.vocabulary(docs, 50)
    whole = LM.bigram_table(docs, known)
    monkeypatch.setattr(LM, "FAN_IN", 2)
    assert (LM.bigram_table(docs, known) == whole).all() and whole.sum() == sum(len(words_of(t)) for _, t in ROWS)
    empty = docs.limit(0)
    assert LM.score(empty, LM.fit(empty, empty)).collect() == []
    assert all(r.score is None or math.isfinite(r.score) for r in LM.score(docs, LM.fit(docs, empty)).collect())


def test_every_word_counts_by_default(spark, monkeypatch):
    # more words than the dense tables hold: target and background differ in rare words only
    rows = [(i, "the cat " + " ".join(f"{'r' if i % 2 else 's'}{i // 4}x{k}" for k in range(120))) for i in range(120)]
    rows += [(i, ROWS[i][1]) for i in range(40)] + [(500, None), (None, "the cat"), (501, "the the"), (501, "the the"), (501, "cat")]
    good = [1, 3, 5, 7, 9, 501, 999, 3]
    monkeypatch.setitem(globals(), "ROWS", rows)
    monkeypatch.setitem(globals(), "GOOD", good)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(d, 1) for d in good] + [(2, 0)], "doc_id long, quality int")
    want = brute(10_000)
    assert len({w for _, t in rows for w in words_of(t)}) > 2 * LM.WORDS
    got = sorted((tuple(r) for r in LM.score_by_quality(docs, labels).collect()), key=str)
    for g, w in zip(sorted(got, key=lambda r: str((*r[:2], round(r[2] or 0, 3)))), sorted(want, key=lambda r: str((*r[:2], round(r[2] or 0, 3))))):
        assert g[:2] == w[:2]
        assert g[2:] == (None, None, None) if w[2] is None else g[2:] == pytest.approx(w[2:], rel=1e-5, abs=1e-5)
    assert len(got) == len(want)
    empty = LM.score_by_quality(docs.limit(0), labels)
    assert empty.collect() == [] and empty.columns == ["doc_id", "n_words", "target_loss", "background_loss", "score"]
