"""Near-dedup against a brute-force join over all pairs."""

import re
from itertools import combinations

import pytest

from quarry.llm.minhash import near_duplicates

SCHEMA = "doc_id long, text string, signature string, rep long, key long, crowd int"


def shingle_set(text):
    text = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    w = [x for x in re.split(r"[\x20\x09-\x0d]+", text) if x]
    return frozenset(zip(*[w[i:] for i in range(5)])) if len(w) >= 5 else frozenset([tuple(w)]) if w else frozenset()


def brute(rows, percent):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
            parent[find(i)] = find(j)
    smallest = {}
    for i, (d, _) in enumerate(rows):
        smallest[find(i)] = min(d, smallest.get(find(i), d))
    return sorted((d, len(s), smallest[find(i)], d == smallest[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def run(spark, rows, **options):
    df = spark.createDataFrame([(d, t, "x", 1, 2, 3) for d, t in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in near_duplicates(df, **options).collect())


def varied(n, words, edits):
    base = [f"w{i * 7 % 97}x{i}" for i in range(words)]
    rows = []
    for d in range(n):
        text = list(base)
        for e in range(d % edits):
            text[(d * 13 + e * 17) % words] = f"edit{d % 5}{e}"
        rows.append((100 + d, " ".join(text)))
    return rows


@pytest.mark.parametrize("crowd", [2, 64])
def test_matches_brute_force_in_crowds_and_pairs(spark, crowd):
    rows = varied(40, 120, 9) + [(d, f"alone {d} " + " ".join(f"q{d}_{i}" for i in range(30))) for d in range(20)]
    assert run(spark, rows, crowd=crowd) == brute(rows, 85)


def test_null_empty_short_tied_and_long_texts(spark):
    long = " ".join(f"long{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one  TWO\n"), (6, "two one"), (7, long), (8, long + " end"),
            (9, "a b c d e"), (10, "A b c d e"), (10, "A b c d e"), (11, "É é"), (12, "é É")]
    assert run(spark, rows) == brute(rows, 85)


def test_empty_table_null_id_and_low_threshold(spark):
    assert run(spark, []) == []
    df = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (None, "z")], "doc_id long, text string")
    assert {tuple(r) for r in near_duplicates(df).collect()} == {(None, 2, 1, False), (1, 2, 1, True), (None, 1, None, False)}
    with pytest.raises(ValueError):
        near_duplicates(df, percent=50)
