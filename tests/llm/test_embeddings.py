"""Vector near-dedup against all pairs in double precision."""

import math

import numpy as np
import pytest

import quarry.llm.embeddings as E

SCHEMA = "vec_id long, embedding array<float>, label int, cls long, links long"


def brute(rows, threshold):
    def unit(v):
        if v is None or not v or any(x is None or not math.isfinite(x) for x in v):
            return None
        x = np.array(v, dtype=np.float32).astype(np.float64)
        return x / np.linalg.norm(x) if x.any() else None

    units = [unit(r[1]) for r in rows]
    links, parent = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][2] is not None and rows[i][2] == rows[j][2] and units[i] is not None and units[j] is not None \
                    and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(r[0], least.get(find(i), r[0]))
    out = []
    for i, r in enumerate(rows):
        c = least.get(find(i))
        out.append((r[0], links[i], c, c is not None and c == r[0]))
    return sorted(out, key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in E.near_duplicate_vectors(df, **options).collect()), key=str)


def cloud(n, dim=16, noise=0.3, labels=3, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, dim))
    return [(i, (centres[rng.integers(6)] + noise * rng.standard_normal(dim)).astype(np.float32).tolist(), int(rng.integers(labels)))
            for i in range(n)]


def test_one_block_finds_every_link(spark):
    rows = cloud(200)
    want = brute(rows, 0.93)
    assert sum(w[1] for w in want) > 100
    assert run(spark, rows) == want


def test_dense_runs_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(E, "BLOCK", 8)
    rows = cloud(400, noise=0.15, labels=2)
    want, got = brute(rows, 0.93), run(spark, rows)
    assert sum(g[1] for g in got) >= 0.99 * sum(w[1] for w in want) > 1000
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    assert [g[2:] for g in got] == [w[2:] for w in want]


def test_nulls_copies_and_odd_vectors(spark):
    base = [1.0, 2.0, 3.0]
    rows = [(5, base, 1), (3, base, 1), (9, [2.0, 4.0, 6.0], 1), (4, base, 2), (6, base, None), (7, base, None), (8, None, 1), (10, [], 1),
            (11, [0.0, 0.0, 0.0], 1), (12, [0.0, 0.0, 0.0], 1), (13, [1.0, None, 3.0], 1), (14, [1.0, None, 3.0], 1), (15, [float("nan"), 1.0, 1.0], 1),
            (16, [float("inf"), 1.0, 1.0], 1), (17, [1.0, 2.0], 1), (None, base, 1), (5, [-1.0, 0.0, 0.0], 1), (3, base, 1), (18, [3e38, 3e38, 3e38], 4), (19, [1e-40, 1e-40, 1e-40], 4)]
    got = run(spark, rows)
    # copies of vectors that link with nothing don't count as links
    assert got == brute(rows, 0.93)
    assert run(spark, []) == []


def test_number_of_passes():
    assert E.passes_for(100, 0.93, 0.999)[0] == 4
    bits, passes = E.passes_for(10**9, 0.93, 0.999)
    assert 1 - (1 - (1 - math.acos(0.93) / math.pi) ** bits) ** passes >= 0.999
    assert passes > E.passes_for(10**6, 0.93, 0.999)[1]
