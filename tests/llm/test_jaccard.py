import itertools
import os

import numpy as np
import pytest

from quarry.llm import counttree as T
from quarry.llm import jaccard as J
from quarry.session import checkpoint_dir
from tests.llm.conftest import tokens


def shingles(text):
    w = tokens(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), 1 << 62), r[0])
    return sorted(((r[0], len(sets[i]), least.get(find(i))) for i, r in enumerate(rows)), key=str)


def run(docs):
    return sorted((tuple(r) for r in J.near_duplicates(docs).collect()), key=str)


def test_against_brute_force(odd_docs, doc_rows):
    assert run(odd_docs) == brute(doc_rows)


def near_threshold(n=26):
    """Pairs around the threshold: k of 60 words changed at the end."""
    rows = []
    for i in range(n):
        base = [f"w{i}x{j}" for j in range(64)]
        rows.append((2 * i, " ".join(base)))
        rows.append((2 * i + 1, " ".join(base[:64 - i] + [f"other{i}y{j}" for j in range(i)])))
    return rows


def test_threshold_is_exact(spark):
    rows = near_threshold()
    assert run(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


@pytest.mark.parametrize("kept", [1, 2])
def test_hashes_cut_short_change_no_result(spark, monkeypatch, kept):
    """With one byte kept most pairs have matches of different hashes; whole hashes decide them."""
    rows = near_threshold() + [(1000 + i, t) for i, t in copies_of_a_template(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    asked = []
    confirm = J.confirm
    monkeypatch.setattr(J, "KEPT_BYTES", kept)
    monkeypatch.setattr(J, "confirm", lambda *a: asked.append(1) or confirm(*a))
    assert run(docs) == brute(rows) and asked


def test_surplus_that_settles_a_pair():
    assert J.doubt(5000, J.HASH_BYTES) == 0
    assert J.doubt(100, 5) == 1 and J.doubt(10_000, 5) == 2
    assert J.doubt(2_000_000, 5) > 10 and J.doubt(100, 1) > J.doubt(100, 2) > 1


def copies_of_a_template(n=90):
    rng = np.random.default_rng(5)
    base = [f"t{j}" for j in range(120)]
    rows = []
    for i in range(n):
        w = list(base)
        for j in rng.integers(0, 120, 1 + i % 4):
            w[j] = f"e{i}z{j}"
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("block", [2048, 16])
def test_group_of_near_copies_with_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK", block)
    monkeypatch.setattr(J, "PARTNERS", 1)
    rows = copies_of_a_template() + [(1000 + i, t) for i, t in copies_of_a_template(3)]
    assert run(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == brute(rows)


def test_sets_that_share_by_chance_are_not_read(spark, monkeypatch):
    """Texts that share half of their shingles with each neighbour meet as count vectors only; whole sets leave no table behind."""
    part = [[f"p{i}x{j}" for j in range(30)] for i in range(40)]
    rows = [(i, " ".join(part[i] + part[(i + 1) % 40])) for i in range(40)] + [(1000 + i, t) for i, t in copies_of_a_template(3)]
    read = []
    verify = J.verify
    monkeypatch.setattr(J, "verify", lambda pairs, sets, kept: read.append(sets.count()) or verify(pairs, sets, kept))
    before = set(os.listdir(checkpoint_dir(spark).removeprefix("file:")))
    assert run(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == brute(rows)
    assert 0 < max(read) <= 3
    left = set(os.listdir(checkpoint_dir(spark).removeprefix("file:"))) - before
    assert not [x for x in left if x.startswith(("llm-jac-sets", "llm-jac-runs", "llm-jac-open", "llm-jac-vecs"))]


def test_runs_are_cut_where_no_sizes_fit(spark):
    rows = [(1, i, n) for i, n in enumerate([52, 10, 20, 11, 50, 100])] + [(2, 7, 10), (3, 8, 10), (3, 9, 12)]
    parts = {}
    for r in J.size_runs(spark.createDataFrame(rows, "key long, sid long, n int")).collect():
        parts.setdefault(r["key"], []).append(r["sid"])
    assert sorted(map(sorted, parts.values())) == [[0, 4], [1, 3], [8, 9]]


@pytest.mark.parametrize("block", [2048, 16])
def test_runs_of_many_sizes_lose_no_pair(spark, monkeypatch, block):
    """Groups of near copies that grow word by word, with so few partners that pairs are left out at first."""
    monkeypatch.setattr(J, "BLOCK", block)
    monkeypatch.setattr(J, "PARTNERS", 1)
    monkeypatch.setattr(J, "SMALL", 4)
    base = [f"t{j}" for j in range(200)]
    rows = [(1000 * k + i, " ".join(base[:20 + 7 * i] + [f"e{k}y{j}" for j in range(k)])) for k in range(3) for i in range(26)]
    assert run(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == brute(rows)


def test_one_document_of_each_group_stays(odd_docs, doc_rows):
    out = J.keep_one(odd_docs)
    assert out.columns == odd_docs.columns
    left = [(r["doc_id"], r["text"]) for r in out.collect()]
    want = brute(doc_rows)
    heads = {c for d, n, c in want if n and c is not None}
    no_words = [r for r in doc_rows if not shingles(r[1])]
    assert len(left) == len(heads) + len(no_words) + 1  # and the one without an id
    assert heads <= {d for d, _ in left}


def test_empty_table(no_docs):
    assert run(no_docs) == [] and J.keep_one(no_docs).count() == 0


def test_tree_finds_every_pair_that_the_bound_allows():
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 4, (12, 64))
    points = np.abs(centre[rng.integers(0, 12, 300)] + rng.integers(-1, 2, (300, 64)) * (rng.random((300, 64)) < 0.1))
    sizes = points.sum(1)
    found = {tuple(sorted(p)) for i, j, _ in T.CountTree(points, sizes).close_pairs() for p in zip(i.tolist(), j.tolist(), strict=True)}
    want = {(i, j) for i, j in itertools.combinations(range(300), 2)
            if 9 * np.minimum(points[i], points[j]).sum() >= 4 * (sizes[i] + sizes[j]) and 5 * min(sizes[i], sizes[j]) >= 4 * max(sizes[i], sizes[j])}
    assert found == want and 0 < len(want) < 300 * 299 // 2


def test_packed_points_never_lose_counts():
    for counts in ([0, 255, 3], [0, 256, 1], [1 << 20, 7, 0], [511, 510, 255]):
        x = np.array(counts)
        assert (T.unpack([T.pack(x)])[0] >= x).all()
        assert len(T.pack(x)) == 4


def test_short_runs_are_enumerated():
    pairs = {p for a, b in T.small_run_pairs(np.array([0, 3, 4]), np.array([3, 1, 2])) for p in zip(a.tolist(), b.tolist(), strict=True)}
    assert pairs == {(0, 1), (0, 2), (1, 2), (4, 5)}
