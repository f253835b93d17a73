"""Dense positions, as-of merges, halos and quantiles on a distributed order, with hot keys and tiny blocks."""

import bisect
import datetime as dt
import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from quarry.operators import clean as C
from quarry.operators import ordered as O
from quarry.operators import stats as ST


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("partitions", [1, 2, 7, 40])
def test_positions_are_dense_and_spread(spark, partitions):
    rng = random.Random(partitions)
    rows = [(rng.choice([None, 1, 2, 3]), rng.random()) for _ in range(600)] + [(7, 0.5)] * 900  # one value over and over
    df = O.numbered(spark.createDataFrame(rows, "k int, v double"), [F.col("k").asc(), F.col("v").asc()], partitions=partitions)
    got = df.orderBy("__g").collect()
    assert [r["__g"] for r in got] == list(range(1500))
    keys = [((r["k"] is not None, r["k"] or 0), r["v"]) for r in got]
    assert keys == sorted(keys)
    assert O.numbered(df.drop("__g").limit(0), ["k"], partitions=partitions).count() == 0


def test_the_hot_value_does_not_fill_one_partition(spark):
    df = spark.createDataFrame([(7,)] * 4000, "k int").repartition(8)
    rows, _ = O.written(df.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(8, "k", "__tie"), "probe")
    sizes = [r["n"] for r in rows.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 1200  # as ``numbered`` splits it


def moments(n, seed, users):
    rng = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    return [(rng.choice(users), base + dt.timedelta(seconds=rng.randrange(4000)), f"r{i}") for i in range(n)]


@pytest.mark.parametrize("block", [3, 50, 1 << 16])
@pytest.mark.parametrize("forward", [False, True])
def test_asof_equals_a_search(spark, block, forward):
    users = ["hot"] * 30 + list("abcdef") + [None]
    left = moments(500, 1, users) + [("a", None, "late"), ("gone", dt.datetime(2024, 1, 1), "x")]
    right = moments(160, 2, users[:-1]) + [("a", None, "none"), (None, dt.datetime(2024, 1, 1), "none")] + [("b", dt.datetime(2024, 1, 1, 0, 10), n) for n in ("p", "q")]
    l, r = (spark.createDataFrame(x, "u string, t timestamp, id string") for x in (left, right))
    got = {x["id"]: x for x in O.asof_join(l.withColumnRenamed("id", "id"), r.select("u", "t", F.col("id").alias("rid")), "u", "t", ["rid"], "100 SECONDS", forward, block).collect()}
    assert len(got) == len(left)
    times = {}
    for u, t, i in right:
        if u is not None and t is not None:
            times.setdefault(u, {}).setdefault(t, []).append(i)
    for u, t, i in left:
        mine = times.get(u, {})
        order = sorted(mine)
        best = None
        if t is not None and order:
            at = bisect.bisect_left(order, t) if forward else bisect.bisect_right(order, t) - 1
            best = order[at] if 0 <= at < len(order) else None
            if best is not None and abs((best - t).total_seconds()) > 100:
                best = None
        assert (got[i]["matched_ts"], got[i]["matched_rid"]) == (best, max(mine[best]) if best is not None else None)


def test_asof_plan_has_no_single_task(spark):
    l = spark.createDataFrame(moments(50, 1, ["a", "b"]), "u string, t timestamp, id string")
    text = plan(O.asof_join(l, l.select("u", "t", F.col("id").alias("other")), "u", "t", ["other"]))
    assert not re.search("SinglePartition|CartesianProduct|NestedLoop|Python|Arrow", text)


def test_rolling_with_a_hot_series_nulls_and_tiny_blocks(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["hot"] * 8 + ["x", "y", None]), i, rng.choice([None, float("nan"), 1.0, 2.5, 4.0, 9.0])) for i in range(700)]
    df = spark.createDataFrame(rows, "s string, k int, v double").repartition(6)
    for series in (None, "s"):
        for block in (5, 64):
            out = O.rolling(df, ([series] if series else []) + ["k"], series, ["v"], 5, 11, block)
            assert not re.search("SinglePartition|MapInPandas|MapInArrow|NestedLoop", plan(out))
            got = {r["k"]: r["rolling_v"] for r in out.collect()}
            assert len(got) == 700
            before = {}
            for s, k, v in rows:
                line = before.setdefault(s if series else 0, [])
                line.append(v)
                seen = [x for x in line[-5:] if x is not None and x == x]
                want = statistics.fmean(seen) if seen else None
                assert got[k] == (pytest.approx(want) if want is not None else None)


def test_rolling_mean_uses_no_python(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(50)], "k int, v double")
    assert not re.search("MapInPandas|SinglePartition", plan(ST.rolling_mean(df, ["k"], ["v"])))


def test_quantiles_with_a_third_of_the_rows_in_one_key(spark):
    rng = random.Random(8)
    rows = [("hot", float(rng.randrange(10**6))) for _ in range(3000)] + [(f"k{i % 40}", rng.choice([None, 1.0, 2.0, -3.5])) for i in range(6000)] + [(None, 5.0), ("one", 4.0), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(8)
    out = O.group_quantiles(df, ["k"], "v", [0.0, 0.25, 0.5, 0.75, 1.0])
    assert not re.search("percentile|SinglePartition|NestedLoop", plan(out))
    got = {r["k"]: r["quantiles"] for r in out.collect()}
    by_key = {}
    for k, v in rows:
        if v is not None:
            by_key.setdefault(k, []).append(v)
    assert set(got) == set(by_key)
    for k, values in by_key.items():
        values.sort()
        for q, p in zip(got[k], (0, 0.25, 0.5, 0.75, 1)):
            at = p * (len(values) - 1)
            low = int(at)
            want = values[low] + (at - low) * (values[min(low + 1, len(values) - 1)] - values[low])
            assert q == pytest.approx(want)


def test_describe_sorted_equals_describe(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(rng.choice(["a", "b", None]), rng.choice([None, rng.random()]), float(i % 9)) for i in range(300)] + [("void", None, 1.0)], "g string, x double, y double")
    key = lambda r: (r["g"] or "", r["metric"])
    one, two = (sorted(ST.describe_by_group(df, "g", ["x", "y"], exact=e).collect(), key=key) for e in (True, "sorted"))
    assert len(one) == len(two) == 8
    for a, b in zip(one, two):
        assert [a[c] for c in a.asDict()] == [pytest.approx(b[c]) if isinstance(b[c], float) else b[c] for c in a.asDict()]


def test_a_hundred_thousand_tokens_with_one_beginning(spark, monkeypatch):
    df = spark.range(20_000).select(F.concat_ws(",", *[F.concat(F.lit("https://example/"), F.lpad((F.col("id") * 5 + i).cast("string"), 7, "0")) for i in range(5)]).alias("t"), "id")
    out = C.multi_hot_indices(df, "t")
    assert out.filter(F.expr("indices <> transform(sequence(0, 4), i -> id * 5 + i)")).count() == 0 and out.count() == 20_000
    tables, real = [], O.written
    monkeypatch.setattr(O, "written", lambda d, tag: tables.append(real(d, tag)) or tables[-1])
    O.numbered(df.select(F.explode(C.tokens(F.col("t"))).alias("token")).distinct(), [F.col("token").asc()], "probe", 8)
    sizes = [r["n"] for r in tables[0][0].groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 100_000 / 8
