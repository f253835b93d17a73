import hashlib
import re

import pytest

from quarry.llm import decontaminate as D

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, n=10):
    windows = []
    for item, text in items:
        w = words(text)
        k = min(n, len(w))
        windows += [(item, w[i:i + k]) for i in range(len(w) - k + 1) if k]
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for item, win in windows:
            for i in range(len(w) - len(win) + 1):
                if w[i:i + len(win)] == win:
                    hit |= set(range(i, i + len(win)))
                    if item is not None:
                        found.add(str(item))
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


ITEMS = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "short item"), (10, "ÉCOLE école a-b 4,2"),
         (3, None), (4, "..."), (None, "nameless item of some words"), (2, "short item"), (5, "beta gamma delta epsilon zeta eta theta iota kappa lambda")]
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
DOCS = [(1, "x ALPHA, beta; gamma delta epsilon zeta eta theta iota kappa! lambda"), (2, "alpha beta gamma delta"), (3, "a SHORT ... item short item"), (4, None), (5, ""),
        (6, "ÉCOLE École"), (7, "É École a b 4 2 ÉCOLE école a b 4 2"), (8, "nameless item of some words"), (8, "nameless item of some words"), (None, "short item"),
        (9, LONG + " short item " + LONG), (10, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu " * 3)]


@pytest.fixture()
def tables(spark):
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in DOCS], "doc_id long, text string, n_words string, items string")
    return docs, spark.createDataFrame(ITEMS, "item_id long, text string")


def test_against_brute_force(tables):
    out = D.contamination(*tables).collect()
    assert sorted((tuple(r) for r in out), key=str) == brute(DOCS, ITEMS)


def test_beyond_the_broadcast_bound_and_with_a_full_bitmap(tables, monkeypatch):
    monkeypatch.setattr(D, "BROADCAST_WINDOWS", 0)
    monkeypatch.setattr(D, "BITMAP_BITS", 64)
    assert sorted((tuple(r) for r in D.contamination(*tables).collect()), key=str) == brute(DOCS, ITEMS)


def test_no_items_and_no_documents(tables):
    docs, items = tables
    assert {r["n_hit"] for r in D.contamination(docs, items.limit(0)).collect()} == {0}
    assert D.contamination(docs.limit(0), items).count() == 0


def test_documents_are_removed(tables):
    docs, items = tables
    out = D.decontaminate(docs, items)
    assert out.columns == docs.columns
    bad = {r[0] for r in brute(DOCS, ITEMS) if r[5]}
    assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(str(i) for i, _ in DOCS if i not in bad)


def test_spans_are_removed(tables):
    docs, items = tables
    out = {r["doc_id"]: r["text"] for r in D.decontaminate(docs, items, mode="span").collect()}
    assert out[3] == "a" and out[2] == "alpha beta gamma delta" and out[1] == "x" and out[10] == ""
    assert out[9] == LONG + " " + LONG and out[4] is None
    with pytest.raises(ValueError):
        D.decontaminate(docs, items, mode="other")


def test_plan_is_native(tables):
    plan = D.contamination(*tables)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("MapIn", "Python", "Pandas", "CartesianProduct", "NestedLoop"))


def test_the_filter_grows_with_the_windows(spark, monkeypatch):
    monkeypatch.setattr(D, "BITMAP_BITS", 1 << 10)
    items = [(i, " ".join(f"item{i}word{j}" for j in range(60))) for i in range(60)]  # 51 windows each, more than the least bits
    docs = [(i, " ".join(f"doc{i}word{j}" for j in range(400))) for i in range(40)] + [(99, "x " + items[7][1] + " y")]
    windows = D.item_windows(spark.createDataFrame(items, "item_id long, text string"))
    n = windows.count()
    assert n == 60 * 51 > 1 << 10
    size = D.bitmap_bits(n)
    own = {r[0] % size for r in windows.select("w_hash").collect()}
    other = D.item_windows(spark.createDataFrame(docs[:40], "item_id long, text string")).select("w_hash").collect()
    assert sum(r[0] % size in own for r in other) < 0.01 * len(other)
    got = D.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r["doc_id"]: r["n_hit"] for r in got if r["contaminated"]} == {99: 60}
    assert D.bitmap_bits(0) == 1 << 10 and D.bitmap_bits(10**9) == D.MOST_BITS
