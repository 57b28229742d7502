"""Decontamination against window-by-window comparison."""

import hashlib
import random
import re

import pytest

from quarry.llm.decontam import contamination, remove_spans


def words_of(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=13):
    out = []
    for d, t in docs:
        w, hit, keys = words_of(t), set(), set()
        for key, item in items:
            iw = words_of(item)
            for s in range(max(1, len(iw) - window + 1)) if iw else ():
                piece = iw[s:s + window]
                for i in range(len(w) - len(piece) + 1):
                    if w[i:i + len(piece)] == piece:
                        hit.update(range(i, i + len(piece)))
                        keys.add("" if key is None else str(key))
        out.append((d, len(w), len(hit), len(keys), hashlib.sha256(",".join(sorted(keys)).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def run(spark, docs, items, **options):
    left = spark.createDataFrame([(d, t, "k", 0) for d, t in docs], "doc_id long, text string, item_id string, n_words int").repartition(2)
    right = spark.createDataFrame([(k, t, 1) for k, t in items], "item_id long, text string, doc_id int")
    return sorted((tuple(r) for r in contamination(left, right, **options).collect()), key=str)


@pytest.mark.parametrize("window", [3, 13])
def test_random_texts(spark, window):
    rng = random.Random(window)
    vocabulary = ["The", "of", "é", "7b", "x", "ZZ"]
    text = lambda n: " ".join(rng.choice(vocabulary) + rng.choice(["", ",", "!", "\n"]) for _ in range(n))
    items = [(i, text(rng.randrange(0, 30))) for i in range(25)] + [(30, "of of"), (31, "zz"), (32, None), (33, "..."), (33, "x x x x")]
    docs = [(i, text(rng.randrange(0, 60))) for i in range(30)]
    docs += [(100 + i, text(20) + " " + (items[i][1] or "") + " " + text(15)) for i in range(20)]
    assert run(spark, docs, items, window=window) == brute(docs, items, window)


def test_edges(spark):
    item = " ".join(f"w{i}" for i in range(20))
    long = " ".join(f"clean{i}" for i in range(40_000))
    docs = [(1, None), (2, ""), (3, "?!"), (4, item.upper()), (4, item.upper()), (5, item.replace(" ", "-")), (6, long + " " + item),
            (7, " ".join(item.split()[:12])), (8, " ".join(item.split()[3:16])), (None, item)]
    items = [(10, item), (2, item), (None, "w0 w1")]
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, docs, []) == brute(docs, [])
    assert run(spark, [], items) == []


def test_remove_spans(spark):
    item = " ".join(f"w{i}" for i in range(14))
    docs = spark.createDataFrame([(1, f"Ça va: {item}. Après", "a"), (2, "nothing", "b"), (3, None, "c"), (4, item + " " + "z " * 400, "d")],
                                 "doc_id long, text string, lang string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert {r[0]: r[1] for r in remove_spans(docs, bench).collect()} == {1: "Ça va: . Après", 2: "nothing", 3: None, 4: item + " " + "z " * 400}


def test_items_in_several_automata(spark, monkeypatch):
    """The benchmark cut into parts gives the rows of one automaton."""
    import functools

    import quarry.llm.decontam as D
    rng = random.Random(8)
    text = lambda n: " ".join(rng.choice(["a", "b", "é", "7", "zz", "q"]) for _ in range(n))
    items = [(i, text(rng.randrange(0, 40))) for i in range(60)]
    docs = [(i, text(20) + " " + (items[i][1] or "") + " " + text(10)) for i in range(60)]
    monkeypatch.setattr(D, "build_automata", functools.partial(D.build_automata, part_words=100))
    left = spark.createDataFrame(docs, "doc_id long, text string")
    right = spark.createDataFrame(items, "item_id long, text string")
    assert len(D.build_automata(right, 5)) > 5
    assert sorted((tuple(r) for r in D.contamination(left, right, 5).collect()), key=str) == brute(docs, items, 5)


def test_flat_arrays_are_small():
    """Some 60 bytes a word, where dictionaries take ten times that."""
    import pickle

    import numpy as np

    from quarry.llm.decontam import SuffixAutomaton
    rng = np.random.default_rng(1)
    machine = SuffixAutomaton([(str(i), rng.integers(1, 1 << 40, 200).astype(np.uint64)) for i in range(200)], 13)
    assert len(pickle.dumps(machine)) < 80 * 40_000


def test_too_large_a_benchmark_is_refused(spark, monkeypatch):
    import quarry.llm.decontam as D
    monkeypatch.setattr(D, "MAX_BENCHMARK_BYTES", 10)
    with pytest.raises(ValueError):
        D.build_automata(spark.createDataFrame([(1, "x" * 11)], "item_id long, text string"))
