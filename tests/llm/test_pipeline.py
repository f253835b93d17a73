from collections import Counter

import corpus_pipeline as P
from quarry.llm.decontaminate import contamination
from quarry.llm.quality import resample
from tests.llm.conftest import tokens
from tests.llm.test_jaccard import brute

SF = "/root/testdata/sf0.001"


def test_stages_on_the_small_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    steps = [docs]
    for name, stage in P.STAGES:
        steps.append(stage(spark, steps[-1], SF).cache())
        assert steps[-1].columns[:len(columns)] == columns, name
    raw, good, distinct, clean, mixed, sharded = steps
    wanted = {r["doc_id"] for r in resample(raw, spark.read.parquet(f"{SF}/labels.parquet")).collect() if r["selected"]}
    assert {r["doc_id"] for r in good.collect()} == wanted
    groups = brute([(r["doc_id"], r["text"]) for r in good.collect()])
    assert sorted(r["doc_id"] for r in distinct.collect()) == sorted({c for _, n, c in groups if n} | {d for d, n, _ in groups if not n})
    bad = {r["doc_id"] for r in contamination(distinct, spark.read.parquet(f"{SF}/benchmark.parquet")).collect() if r["contaminated"]}
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in distinct.collect()} - bad
    assert set(Counter(r["doc_id"] for r in mixed.collect()).values()) <= {1, 2, 3, 4}
    assert abs(sum(len(tokens(r["text"])) for r in mixed.collect()) / sum(len(tokens(r["text"])) for r in clean.collect()) - 1) < 0.2
    assert sharded.count() == mixed.count() and sharded.columns == [*columns, "slot", "shard"]
    assert P.run(spark, SF).count() == sharded.count()


def test_stages_on_awkward_documents(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        step = docs
        for name, stage in P.STAGES:
            out = stage(spark, step, SF)
            if name != "sharding":
                assert out.columns == docs.columns, name
                step = out.cache()
        assert step.count() <= docs.count() * 3


def test_columns_named_like_the_helpers_come_back_as_they_were(spark, doc_rows):
    names = ["_key", "_id", "_noise", "_theirs", "_text_key", "_hit_at", "_repeated", "_KEY_", "_doc", "_copies", "_order", "_pattern"]
    docs = spark.createDataFrame([(*r, *[f"{c}{i}" for c in names]) for i, r in enumerate(doc_rows)], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in names)).repartition(3)
    given = {str(tuple(r)) for r in docs.collect()}
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows and {str(tuple(r)) for r in rows} <= given, name
