"""Quality rules: statistics by plain Python, trees by a plain walk, constraints, held-out labels."""

import re
from collections import Counter

import numpy as np

from quarry.llm import rules
from quarry.llm.queries import QUERIES
from quarry.llm.rules import BASE, FALLING, FEATURES, apply_rules, fit_trees, statistics
from tests.conftest import SF_MID
from tests.llm.conftest import fold

LABEL = "doc_id long, quality int, toxic int"


def counted(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    again = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again)]


AWKWARD = [None, "", " \t\n\r\x0b ", "one", "a b c a b c a", "A b c a b c", "x\nx\nx \n\n\n x", "é ö 漢字 é ö 漢字 #*$%&|<>", "a b c", "w " * 3000, "q\x0cq q q q", "\n\n", "a a a", "a a a a"]


def test_statistics_equal_a_plain_count(monkeypatch, doc_rows):
    texts = AWKWARD + [r[1] for r in doc_rows] + ["a b c", "a b c"]
    want = [counted(t) for t in texts]
    raw = [None if t is None else t.encode() for t in texts]
    assert statistics(raw)[0].tolist() == want
    monkeypatch.setattr(rules, "GROUP", 1)
    assert statistics(raw)[0].tolist() == want
    monkeypatch.setattr("quarry.llm.textarrays.PIECE", 64)  # long texts in several buffers
    base, x = statistics(raw)
    assert base.tolist() == want and np.isfinite(x).all() and x.shape[1] == len(FEATURES)


def test_query_equals_a_plain_count_on_whole_table(spark):
    got = QUERIES["op11_quality_rules"](spark, SF_MID).collect()
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").collect()
    want = {d["doc_id"]: counted(d["text"]) for d in docs}
    assert len(got) == len(docs)
    for r in got:
        n, *_, repeated = counts = [r[c] for c in BASE]
        assert counts == want[r["doc_id"]]
        assert r["base_failed"] == (n < 50 or 100 * repeated > 50 * n)
        assert r["kept"] == (not r["base_failed"] and r["score"] >= 0.5)


def plain_walk(trees, x):
    total = trees.prior
    for f, t, v in zip(trees.feature, trees.threshold, trees.value):
        at = 0
        while at < len(f):
            at = 2 * at + (2 if x[f[at]] > t[at] else 1)
        total += v[at - len(f)]
    return 1 / (1 + np.exp(-total))


def test_trees_walk_and_constraints():
    rng = np.random.default_rng(5)
    x = rng.random((3000, 4))
    odds = 3 * np.sin(6 * x[:, 0]) - 2 * x[:, 1] + 1.5 * np.sin(9 * x[:, 1]) + 2 * x[:, 2]  # not monotonic in feature 1 by itself
    y = (rng.random(3000) < 1 / (1 + np.exp(-odds))).astype(float)
    free, bound = (fit_trees(x, y, np.array(d), rounds=40) for d in ([0, 0, 0, 0], [0, -1, 1, 0]))
    probe = rng.random((200, 4))
    assert np.allclose(bound.score(probe), [plain_walk(bound, p) for p in probe])
    line = np.linspace(-0.1, 1.1, 121)
    bent = 0
    for p in probe[:60]:
        for feature, sign in ((1, -1), (2, 1)):
            q = np.repeat(p[None], len(line), axis=0)
            q[:, feature] = line
            assert (sign * np.diff(bound.score(q)) >= -1e-12).all()
            bent += (sign * np.diff(free.score(q)) < -1e-6).any()
    assert bent > 10  # without the constraint the same data bend the score
    wrong = [np.mean((t.score(x) >= 0.5) != (y == 1)) for t in (free, bound)]
    assert wrong[0] < 0.25 and wrong[1] < 0.3 and min(y.mean(), 1 - y.mean()) > 0.3


def test_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet").collect()
    seen = [tuple(r) for r in labels if fold(r["doc_id"], 3) != 1]
    out = {r["doc_id"]: r for r in apply_rules(docs, spark.createDataFrame(seen, LABEL)).collect()}
    held = [r for r in labels if fold(r["doc_id"], 3) == 1 and not out[r["doc_id"]]["base_failed"]]
    right = [out[r["doc_id"]]["kept"] == bool(r["quality"]) for r in held]
    assert len(right) > 50 and np.mean(right) > 0.95
    assert all(c in FEATURES for c in FALLING)


def test_awkward_rows_and_labels(spark, odd_docs, no_docs, doc_rows):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 0, 0), (2, 0, 1), (None, 1, 0), (3, None, 0), (999, 1, 0), (206, 1, None)], LABEL)
    for given in (labels, labels.limit(0), labels.filter("quality = 1")):
        got = apply_rules(odd_docs, given, sample=3).collect()
        assert len(got) == len(doc_rows)
        assert sorted(str([r["doc_id"], *[r[c] for c in BASE]]) for r in got) == sorted(str([r[0], *counted(r[1])]) for r in doc_rows)
    assert all(r["kept"] != r["base_failed"] for r in got)  # one class only
    assert apply_rules(no_docs, labels).collect() == []
