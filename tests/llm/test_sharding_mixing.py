import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quarry.llm import mixing as M
from quarry.llm import sharding as S
from tests.llm.conftest import tokens


def test_table_is_balanced_and_every_slot_is_claimed():
    table = S.fill_table()
    assert len(table) == S.TABLE_SIZE and min(table) == 0
    count = Counter(table)
    assert max(count.values()) - min(count.values()) <= 1


def test_losing_a_shard_moves_few_others():
    before, after = S.fill_table(S.SHARDS), S.fill_table(S.SHARDS[:-1])
    moved = sum(a != b for a, b in zip(before, after, strict=True) if a != len(S.SHARDS) - 1)
    assert moved < 0.15 * S.TABLE_SIZE


@pytest.mark.parametrize("size", [1, 4, 2001])
def test_size_must_be_prime(size):
    with pytest.raises(ValueError):
        S.fill_table(("a",), size)


def test_assignment_against_python(odd_docs, doc_rows):
    out = S.assign_shards(odd_docs)
    assert out.columns.count("slot") == 1 and out.columns.count("shard") == 1 and "size" in out.columns
    table = S.fill_table()
    got = Counter((r["doc_id"], r["slot"], r["shard"]) for r in out.collect())
    want = Counter()
    for r in doc_rows:
        slot = int(hashlib.md5(("" if r[0] is None else str(r[0])).encode()).hexdigest()[:15], 16) % S.TABLE_SIZE
        want[r[0], slot, S.SHARDS[table[slot]]] += 1
    assert got == want


def test_sharding_runs_no_shuffle_and_no_python(odd_docs):
    plan = S.assign_shards(odd_docs.coalesce(1))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEval" not in plan and "BatchEvalPython" not in plan and "MapIn" not in plan and plan.count("Join") == 0


def test_written_shards_hold_every_row(spark, odd_docs, tmp_path):
    S.write_shards(S.assign_shards(odd_docs), str(tmp_path / "s"), files_per_shard=2)
    assert spark.read.parquet(str(tmp_path / "s")).count() == odd_docs.count()


def test_empty_tables(no_docs):
    assert S.assign_shards(no_docs).count() == 0
    assert M.mix_documents(no_docs).count() == 0
    assert M.mixed(no_docs).count() == 0


def test_share_out_stops_at_caps_and_shares_the_excess():
    out = M.share_out(100, {"a": 5, "b": 2, "c": 1}, {"a": 30, "b": 1000, "c": 1000})
    assert out["a"] == 30 and out["b"] == pytest.approx(70 * 2 / 3) and sum(out.values()) == pytest.approx(100)
    assert M.share_out(0, {None: 5}, {None: 0}) == {None: 0}


def test_flow_prefers_first_copies_and_meets_quotas():
    # b can only be filled by the shared pattern, so a must repeat its own documents
    flows = M.route([(["a"], 10), (["a", "b"], 10)], {"a": 20, "b": 10})
    assert flows[1]["b"] == pytest.approx(10) and flows[0]["a"] + flows[1]["a"] == pytest.approx(20)
    # convex costs: with room, nobody is repeated
    flows = M.route([(["a"], 10), (["a"], 10)], {"a": 20})
    assert [sum(f.values()) for f in flows] == [pytest.approx(10)] * 2


def brute_cost(patterns, quotas):
    """Least cost of routing all quota tokens, by trying every split of unit tokens."""
    import itertools

    best = None
    options = [[dict(zip(m, split, strict=True)) for split in itertools.product(range(0, 3 * t + 1), repeat=len(m)) if sum(split) <= 3 * t] for m, t in patterns]
    for choice in itertools.product(*options):
        got = defaultdict(int)
        for c in choice:
            for s, n in c.items():
                got[s] += n
        if any(got[s] != quotas[s] for s in quotas):
            continue
        cost = 0
        for (_, t), c in zip(patterns, choice, strict=True):
            n = sum(c.values())
            cost += max(0, min(n, 2 * t) - t) * 1 + max(0, n - 2 * t) * 3
        best = cost if best is None else min(best, cost)
    return best


@pytest.mark.parametrize("patterns, quotas", [
    ([(["a"], 2), (["b"], 1), (["a", "b"], 1)], {"a": 3, "b": 3}),
    ([(["a"], 1), (["a", "b"], 2), (["b"], 2)], {"a": 5, "b": 2}),
])
def test_flow_has_least_cost(patterns, quotas):
    flows = M.route(patterns, quotas)
    cost = 0
    for (_, t), f in zip(patterns, flows, strict=True):
        n = sum(f.values())
        cost += max(0, min(n, 2 * t) - t) + 3 * max(0, n - 2 * t)
    assert {s: round(sum(f.get(s, 0) for f in flows)) for s in quotas} == quotas
    assert round(cost) == brute_cost(patterns, quotas)


def test_mix_against_python(odd_docs, doc_rows):
    out = M.mix_documents(odd_docs).collect()
    assert len(out) == len(doc_rows)
    size = Counter()
    for r in doc_rows:
        size[r[3]] += len(tokens(r[1]))
    names = sorted(size, key=lambda s: (s is None, s or ""))
    want = M.share_out(sum(size.values()), {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}, {s: 3 * size[s] for s in names})
    taken = Counter()
    for r in out:
        assert r["source_size"] == size[r["source"]] and r["target"] == pytest.approx(want[r["source"]], abs=1e-5)
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["size"] * r["copies"]
        taken[r["source"]] += r["taken"]
    longest = Counter()
    for r in doc_rows:
        longest[r[3]] = max(longest[r[3]], len(tokens(r[1])))
    for s in names:  # the prefix ends at the document nearest to the target
        assert abs(taken[s] - want[s]) <= longest[s] / 2 + 1


def test_mix_repeats_itself_and_mixed_rows_follow(odd_docs):
    a, b = (sorted((r["doc_id"] or -1, r["taken"]) for r in M.mix_documents(d).collect()) for d in (odd_docs, odd_docs.repartition(7)))
    assert a == b
    mixed = M.mixed(odd_docs)
    assert mixed.columns == odd_docs.columns
    words = sum(len(tokens(r["text"])) for r in mixed.collect())
    assert words == sum(n for _, n in a)


def test_overlapping_sources(spark):
    docs = spark.createDataFrame([(i, 10, ["a"] if i % 3 else ["a", "b"]) for i in range(90)], "doc_id long, size long, sources array<string>")
    rows, quotas, _ = M.copies(docs, {"a": 500.0, "b": 300.0})
    got = rows.groupBy(F.size("sources").alias("n")).agg(F.sum(F.col("size") * F.col("_copies")).alias("t")).collect()
    assert sum(r["t"] for r in got) == pytest.approx(800, abs=10)
