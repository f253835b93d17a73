"""Hard negatives: every anchor against every row by plain Python, and the awkward rows."""

import math
import random

import numpy as np
import pytest

from quarry.llm import negatives
from quarry.llm.negatives import Best, hard_negatives, limits, products

ROW = "vec_id long, embedding array<float>, label int"


def brute(rows, every=100):
    kept = []
    for vec_id, x, label in rows:
        if label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        kept.append((vec_id, [math.floor(256.0 * v) for v in x], (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label))
    order = lambda e: (-e[0], e[1] is None, e[1] or 0)
    out = []
    for i, (a, x, label) in enumerate(kept):
        if a is None or a % every:
            continue
        scored = [(sum(p * q for p, q in zip(x, y)), b, other == label) for j, (b, y, other) in enumerate(kept) if j != i]
        for s, p, _ in sorted((e for e in scored if e[2]), key=order)[:5]:
            found = sorted((e for e in scored if not e[2] and 30 * s <= 100 * e[0] <= 90 * s), key=order)[:10]
            out += [(a, p, k + 1, n, s, t) for k, (t, n, _) in enumerate(found)]
    return sorted(out, key=str)


def answer(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def vectors(n, dim=6, labels=4, seed=1):
    rng = random.Random(seed)
    return [(i, [float(np.float32(rng.gauss(0.3, 0.5))) for _ in range(dim)], rng.randrange(labels)) for i in range(n)]


def test_equals_brute_force_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 64)
    monkeypatch.setattr(negatives, "CHUNK", 3)
    monkeypatch.setattr(negatives, "HELD", 2)
    rows = vectors(900)
    got = answer(hard_negatives(spark.createDataFrame(rows, ROW).repartition(5), every=20))
    assert got == brute(rows, 20) and len(got) > 1000


def test_hot_copies_ties_and_windows_that_overlap(spark):
    rows = vectors(300, dim=3, seed=4)
    rows += [(1000 + i, [0.5, 0.25, 0.125], i % 2) for i in range(400)]  # ties over two labels
    rows += [(2000, [0.5, 0.25, 0.125], 0), (2000, [0.5, 0.25, 0.125], 0)]  # a repeated anchor row
    assert answer(hard_negatives(spark.createDataFrame(rows, ROW).repartition(4))) == brute(rows)


def test_awkward_rows(spark):
    rows = vectors(120, dim=4, seed=7) + [
        (200, None, 1), (201, [0.1, None, 0.2, 0.3], 1), (202, [0.1, float("nan"), 0.2, 0.3], 1), (203, [float("inf"), 0.0, 0.0, 0.0], 2),
        (204, [0.1, 0.2, 0.3, 0.4], None), (None, [0.9, 0.9, 0.9, 0.9], 1), (None, [0.2, 0.3, 0.3, 0.2], 0), (400, [], 1), (500, [0.4], 2),
        (600, [0.5, 0.5, 0.5, 0.5, 0.5, 0.5], 3), (700, [-0.5, -0.5, -0.5, -0.5], 1), (-100, [0.5, 0.4, 0.3, 0.2], 0), (0, [0.0, 0.0, 0.0, 0.0], 0)]
    df = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], f"{ROW}, row string, g string, slot string, scores string").repartition(3)
    assert answer(hard_negatives(df)) == brute(rows)


def test_empty_tables_and_no_anchor(spark):
    assert answer(hard_negatives(spark.createDataFrame([], ROW))) == []
    assert answer(hard_negatives(spark.createDataFrame([(1, [0.5], 1), (2, [0.5], 2)], ROW))) == []
    assert answer(hard_negatives(spark.createDataFrame([(100, [0.5], 1)], ROW))) == []


def test_large_components_stay_exact(spark):
    rows = [(100, [4e5, 3.0], 1), (101, [5e5, 1.0], 1), (102, [3e5, 2.0], 2), (103, [2e5, 9.0], 3)]
    assert answer(hard_negatives(spark.createDataFrame(rows, ROW))) == brute(rows)
    a = np.array([[2.0**60, 3.0]])
    assert products(a, np.array([[1.0, 5.0], [2.0**60, 0.0], [-(2.0**60), 0.0]])).tolist() == [[2**60 + 15, 2**63 - 1, -(2**63)]]


@pytest.mark.parametrize("score", [-11, -1, 0, 1, 9, 10, 11, 333, 10**17 + 7, 2**63 - 1])
def test_limits_without_overflow(score):
    least, most = limits(np.array([score]))
    assert int(least[0]) == -(-30 * score // 100) and int(most[0]) == 90 * score // 100


def test_best_keeps_the_first_of_every_key():
    rng = np.random.default_rng(3)
    key, score, ident = rng.integers(0, 7, 4000), rng.integers(-9, 9, 4000), rng.integers(0, 500, 4000)
    unnamed = (ident % 11 == 0).astype(np.int64)
    best = Best(7, 10)
    for part in np.array_split(np.arange(4000), 13):
        best.add(key[part], score[part], unnamed[part], ident[part])
    want = [e for k in range(7) for e in sorted((k, -s, u, i) for k2, s, u, i in zip(key, score, unnamed, ident) if k2 == k)[:10]]
    assert [(k, -s, u, i) for k, s, u, i in zip(*best.rows)] == want
