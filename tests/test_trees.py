"""Grouped forests: a plain grower's trees, prefixes and cuts of one forest, many groups, awkward rows."""

import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import learn as L
from quarry.operators import trees as T
from quarry.plans.learn import DAY_FEATURES
from quarry.sources.fixtures import days
from tests.conftest import SF_MID

ROW = "g int, id long, a double, b double, c double, y double"


def plain_tree(rows, weights, edges, depth):
    """rows: (bins, outputs). Returns {node: (feature, bin, left value, right value)} grown level by level."""
    splits, at = {}, {1: [i for i in range(len(rows)) if weights[i]]}
    width = len(rows[0][1])
    for level in range(depth):
        below = {}
        for node, members in at.items():
            n = sum(weights[i] for i in members)
            sums = [sum(weights[i] * rows[i][1][k] for i in members) for k in range(width)]
            square = sum(weights[i] * sum(v * v for v in rows[i][1]) for i in members)
            total = sum(s * s for s in sums) / n
            best = None
            for f in range(len(edges)):
                for b in sorted({rows[i][0][f] for i in members}):
                    left = [i for i in members if rows[i][0][f] <= b]
                    nl = sum(weights[i] for i in left)
                    if not 0 < nl < n or square - total <= T.LEAST_SHARE * square:
                        continue
                    sl = [sum(weights[i] * rows[i][1][k] for i in left) for k in range(width)]
                    gain = sum(x * x / nl + (s - x) ** 2 / (n - nl) for x, s in zip(sl, sums)) - total
                    share = round(gain / (square - total), 9)
                    if share > T.LEAST_SHARE and (best is None or share > best[0]):
                        best = share, f, b, [x / nl for x in sl], [(s - x) / (n - nl) for x, s in zip(sl, sums)]
            if best:
                _, f, b, lv, rv = best
                splits[node] = f, b, lv, rv
                below[2 * node] = [i for i in members if rows[i][0][f] <= b]
                below[2 * node + 1] = [i for i in members if rows[i][0][f] > b]
        at = below
    return splits


def check_against_plain(forest, data, key, features, outputs, depth, seed=42):
    """Compares every tree of ``forest`` with the plain grower, bags read from the operator's own draw."""
    groups = forest.groups
    edges = {tuple(r[g] for g in groups): (r["__edges"], r["__means"]) for r in forest.tables.collect()}
    drawn = {}
    for r in T._pairs(data.select(*groups, key), forest.trees, [key], seed).collect():
        drawn[(*(r[g] for g in groups), r[key], r["tree"])] = r["__w"]
    found = {}
    for level in forest.levels:
        for r in level.collect():
            found[(*(r[g] for g in groups), r["tree"], r["node"])] = (r["feature"], r["bin"], r["left"], r["right"])
    given = data.collect()
    n = 0
    for group, (cuts, means) in edges.items():
        rows = [r for r in given if tuple(r[g] for g in groups) == group]
        binned = [([sum(e < float(r[f]) for e in cuts[i]) for i, f in enumerate(features)], [o(r) - m for o, m in zip(outputs, means)]) for r in rows]
        for tree in range(forest.trees):
            weights = [drawn.get((*group, r[key], tree), 0) for r in rows]
            want = plain_tree(binned, weights, cuts, depth) if any(weights) else {}
            got = {k[-1]: v for k, v in found.items() if k[:-1] == (*group, tree)}
            assert set(got) == set(want)
            for node, (f, b, lv, rv) in want.items():
                assert got[node][:2] == (f, b)
                assert got[node][2] == pytest.approx(lv) and got[node][3] == pytest.approx(rv)
            n += len(want)
    return n


def test_days_equal_a_plain_grower(spark):
    data = days(spark, SF_MID).withColumn("label", F.col("total_users").cast("double"))
    forest = T.grow(data, ["year", "season_id"], DAY_FEATURES, [F.col("label")], ["date"], trees=2, depth=4, bins=12)
    assert check_against_plain(forest, data, "date", DAY_FEATURES, [lambda r: r["label"]], 4) > 100


def labelled(n, seed=2):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = rng.random(), rng.randrange(5) / 4, rng.random()
        out.append((i % 3, i, a, b, c, float((a > 0.5) + 2 * (b > 0.4) if rng.random() > 0.1 else rng.randrange(4))))
    return out


def test_classes_equal_a_plain_grower_and_are_learnt(spark):
    rows = labelled(360)
    data = spark.createDataFrame(rows, ROW)
    forest = T.grow(data, ["g"], ["a", "b", "c"], T.class_outputs("y", [0, 1, 2, 3]), ["id"], trees=5, depth=4, bins=8)
    outputs = [lambda r, k=k: float(r["y"] == k) for k in range(4)]
    assert check_against_plain(forest, data, "id", ["a", "b", "c"], outputs, 4) > 60
    fresh = spark.createDataFrame(labelled(300, 7), ROW)
    right = T.predict(forest, fresh, [0, 1, 2, 3]).filter("prediction = y").count()
    assert right > 240  # nine of ten rows follow the rule


def test_one_forest_scores_every_setting_of_a_grid(spark):
    data = spark.createDataFrame(labelled(240), ROW)
    train, held = data.filter("id % 4 > 0"), data.filter("id % 4 = 0")
    outputs = T.class_outputs("y", [0, 1, 2, 3])
    whole = T.grow(train, ["g"], ["a", "b", "c"], outputs, ["id"], trees=9, depth=5, columns=2)
    table = {(r["g"], r["trees"], r["depth"]): (r["n"], r["accuracy"]) for r in T.scores(whole, held, "y", [3, 9, 5], [1, 3, 5], [0, 1, 2, 3]).collect()}
    assert len(table) == 3 * 3 * 3
    for trees, depth in ((3, 1), (5, 3), (9, 5), (3, 5)):
        alone = T.grow(train, ["g"], ["a", "b", "c"], outputs, ["id"], trees=trees, depth=depth, columns=2)
        got = T.predict(alone, held, [0, 1, 2, 3]).groupBy("g").agg(F.count("*").alias("n"), F.avg((F.col("prediction") == F.col("y")).cast("double")).alias("a"))
        for r in got.collect():
            assert table[(r["g"], trees, depth)] == (r["n"], pytest.approx(r["a"]))
    line = T.grow(train, ["g"], ["a", "b", "c"], [F.col("y")], ["id"], trees=4, depth=3)
    for r in T.scores(line, held, "y", [4], [3]).collect():
        mse = T.predict(line, held.filter(F.col("g") == r["g"])).agg(F.avg(F.pow(F.col("prediction") - F.col("y"), F.lit(2)))).first()[0]
        assert r["mse"] == pytest.approx(mse)


def test_two_thousand_groups_in_a_few_jobs(spark):
    data = spark.range(40_000).selectExpr("CAST(id % 2000 AS INT) AS g", "id", "CAST(hash(id) % 1000 AS DOUBLE) AS a", "CAST(id % 7 AS DOUBLE) AS b", "CAST(id % 2000 AS DOUBLE) + IF(hash(id) % 1000 > 0, 5, -5) AS y")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("forests", "two thousand")
    forest = T.grow(data, ["g"], ["a", "b"], [F.col("y")], ["id"], trees=3, depth=2)
    jobs = len(tracker.getJobIdsForGroup("forests"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    out = T.predict(forest, data)
    assert out.count() == 40_000 and out.select("g").distinct().count() == 2000
    error = out.agg(F.avg(F.pow(F.col("prediction") - F.col("y"), F.lit(2)))).first()[0]
    assert error < 6  # 25 without splits
    assert jobs < 40  # writes, tests for emptiness and broadcasts; not 2,000 fits


def test_awkward_rows(spark):
    rows = labelled(60) + [(0, 900, None, 0.1, 0.2, 1.0), (0, 901, float("nan"), 0.1, 0.2, 1.0), (0, 902, 0.3, 0.1, 0.2, None),
                           (None, 903, 0.3, 0.1, 0.2, 4.0), (None, 904, 0.3, 0.1, 0.2, 4.0), (8, 905, 0.1, 0.1, 0.1, 7.0), (9, 906, 0.1, 0.1, 0.1, None)]
    data = spark.createDataFrame(rows, ROW)
    forest = T.grow(data, ["g"], ["a", "b", "c"], [F.col("y")], ["id"], trees=20, depth=3)
    got = {r["id"]: r["prediction"] for r in T.predict(forest, data).collect()}
    assert set(got) == {r[1] for r in rows} - {906}  # a group without training rows has no model
    assert got[900] is None and got[901] is None and got[902] is not None
    assert got[903] == got[904] == pytest.approx(4.0) and got[905] == pytest.approx(7.0)
    empty = T.grow(data.limit(0), ["g"], ["a", "b", "c"], [F.col("y")], ["id"], trees=3, depth=2)
    assert T.predict(empty, data).filter("prediction is not null").count() == 0


def plain_boost(rows, cuts, rounds, depth, rate, ridge):
    """rows: (features, label). What the trees of every round say of each row, by the definition: recursive splits, shrunk leaves."""
    mean = sum(y for _, y in rows) / len(rows)
    at = [[sum(e < v for e in cuts[f]) for f, v in enumerate(x)] for x, _ in rows]
    said = [mean] * len(rows)

    def fit(members, left, level, out):
        n, s = len(members), sum(left[i] for i in members)
        q, best = sum(left[i] ** 2 for i in members), None
        total = s * s / (n + ridge)
        if level < depth and q - total > T.LEAST_SHARE * q:
            for f in range(len(cuts)):
                for b in sorted({at[i][f] for i in members})[:-1]:
                    low = [i for i in members if at[i][f] <= b]
                    sl, nl = sum(left[i] for i in low), len(low)
                    share = round((sl * sl / (nl + ridge) + (s - sl) ** 2 / (n - nl + ridge) - total) / (q - total), 9)
                    if share > T.LEAST_SHARE and (best is None or share > best[0]):
                        best = share, f, b
        if best is None:
            out.update((i, s / (n + ridge)) for i in members)
            return
        _, f, b = best
        fit([i for i in members if at[i][f] <= b], left, level + 1, out)
        fit([i for i in members if at[i][f] > b], left, level + 1, out)

    path = []
    for _ in range(rounds):
        out = {}
        fit(list(range(len(rows))), [y - p for (_, y), p in zip(rows, said)], 0, out)
        said = [p + rate * out[i] for i, p in enumerate(said)]
        path.append(said)
    return path


def curved(n, seed=5):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = rng.random(), rng.randrange(5) / 4, rng.random()
        out.append((i % 3, i, a, b, c, (i % 3) * 10 + 6 * a * a + 3 * b + rng.random() / 10))
    return out


def test_boosted_trees_equal_a_plain_booster(spark):
    rows = curved(150) + [(7, 900, 0.1, 0.2, 0.3, 4.0), (None, 901, 0.1, 0.2, 0.3, 1.0), (None, 902, 0.9, 0.2, 0.3, 2.0)]
    data = spark.createDataFrame(rows, ROW)
    model = T.boost(data, ["g"], ["a", "b", "c"], F.col("y"), rounds=3, depth=3, rate=0.4, bins=8)
    cuts = {r["g"]: r["__edges"] for r in model.tables.collect()}
    got = {r["id"]: r["prediction"] for r in T.predict(model, data).collect()}
    for g in (0, 1, 2, 7, None):
        mine = [r for r in rows if r[0] == g]
        want = plain_boost([(r[2:5], r[5]) for r in mine], cuts[g], 3, 3, 0.4, 1.0)[-1]
        assert [got[r[1]] for r in mine] == pytest.approx(want)
    odd = spark.createDataFrame([(0, 1, None, 0.1, 0.1, None), (0, 2, float("nan"), 0.1, 0.1, 1.0), (5, 3, 0.1, 0.1, 0.1, 1.0)], ROW)
    assert {r["id"]: r["prediction"] for r in T.predict(model, odd).collect()} == {1: None, 2: None}


def test_settings_as_groups_equal_boosting_alone(spark):
    data = spark.createDataFrame(curved(120), ROW)
    table = {(r["depth"], r["rate"], r["trees"]): (r["n"], r["rmse"]) for r in L.boosted_search(data, ["a", "b", "c"], "y", "id", [1, 3], [0.3, 0.6], [1, 2], folds=2).collect()}
    assert len(table) == 2 * 2 * 2 and {n for n, _ in table.values()} == {120}
    folds = data.withColumn("fold", L._fold("id", 2))
    for depth, rate, trees in ((1, 0.6, 3), (2, 0.3, 1)):
        errors = []
        for f in (0, 1):
            alone = T.boost(folds.filter(F.col("fold") != f), [], ["a", "b", "c"], F.col("y"), trees, depth, rate)
            errors.append(T.predict(alone, folds.filter(F.col("fold") == f)).agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("y"), F.lit(2))))).first()[0])
        assert table[depth, rate, trees][1] == pytest.approx(sum(errors) / 2)
