import numpy as np
import pytest

from quarry.llm import quality as Q
from tests.llm.conftest import ENGLISH, GERMAN, sentence


def corpus(n=240):
    import random

    rng = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        text = sentence(rng, ENGLISH if i % 2 else GERMAN, rng.randint(20, 60)).capitalize() + "."
        bad = i % 5 == 0
        if bad:
            text = [" ".join([text.split()[0]] * 40), " ".join(w.upper() + "!!" for w in text.split()), " ".join(w + "$$$" for w in text.split())][i // 5 % 3]
        rows.append((i, text, "en", "s", 1))
        if i % 3:
            labels.append((i, 0 if bad else 1, 0))
    return rows, labels


@pytest.fixture()
def tables(spark):
    rows, labels = corpus()
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_junk_is_rejected_and_clean_documents_stay(tables):
    out = Q.resample(*tables).collect()
    assert len(out) == 240
    kept = {r["doc_id"] for r in out if r["selected"]}
    good = [i for i in range(240) if i % 5]
    assert len([i for i in good if i in kept]) >= 0.97 * len(good)
    assert len([i for i in range(0, 240, 5) if i in kept]) <= 0.15 * 48


def test_weights_against_brute_force(tables):
    docs, labels = tables
    rows, marks = corpus()
    good = {i for i, q, _ in marks if q == 1}

    def bag(text):
        return np.bincount(Q.cells(text.encode() + b" ", np.zeros(1, int))[0], minlength=Q.CELLS)

    raw, target = sum(bag(r[1]) for r in rows), sum(bag(r[1]) for r in rows if r[0] in good)
    ratio = Q.log_ratio(target.astype(float), raw.astype(float))
    got = {r["doc_id"]: r["log_weight"] for r in Q.resample(docs, labels).collect()}
    for r in rows:
        assert got[r[0]] == pytest.approx(bag(r[1]) @ ratio)


def test_sampling_without_replacement_is_in_proportion(spark):
    """k = 1 of three documents with weights 1, 2, 5: the first pick follows them over many seeds."""
    docs = spark.createDataFrame([(i, "") for i in range(3)], "doc_id long, text string")
    weight = np.log([1.0, 2.0, 5.0])
    noise = np.array([[r["key"] for r in Q.weigh(docs.coalesce(1), np.zeros(Q.CELLS), seed).orderBy("doc_id").collect()] for seed in range(120)])
    first = np.bincount((noise + weight).argmax(1), minlength=3) / 120
    assert abs(first - np.array([1, 2, 5]) / 8).max() < 0.13


@pytest.mark.parametrize("k", [1, 7, 500, 999, 1000])
def test_kth_largest_is_exact(spark, k):
    rng = np.random.default_rng(k)
    values = np.concatenate([rng.integers(-(1 << 62), 1 << 62, 600), rng.integers(-5, 5, 400)]).tolist()
    df = spark.createDataFrame([(int(v),) for v in values], "bits long")
    assert Q.kth_largest(df, "bits", k) == sorted(values, reverse=True)[k - 1]
    assert Q.kth_largest(df, "bits", 1001) is None


def test_awkward_rows(spark, odd_docs, doc_rows, no_docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    out = Q.resample(odd_docs, labels)
    rows = out.collect()
    assert len(rows) == len(doc_rows) and all(np.isfinite(r["key"]) for r in rows)
    assert next(r for r in rows if r["doc_id"] == 200)["log_weight"] == 0
    kept = Q.keep_good(odd_docs, labels)
    assert kept.columns == odd_docs.columns and kept.count() == sum(r["selected"] for r in rows)
    assert Q.resample(no_docs, labels).count() == 0
    assert {r["log_weight"] for r in Q.resample(odd_docs, labels.limit(0)).collect()} == {0.0}
