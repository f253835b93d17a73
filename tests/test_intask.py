"""Trees grown inside a task are those grown level by level."""

import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quarry.operators import intask
from quarry.operators import learn as L
from quarry.operators import trees as T
from quarry.plans import learn as P
from tests.conftest import SF_SMALL
from tests.test_trees import ROW, curved, labelled


def test_draws_are_those_of_spark(spark):
    rows = spark.range(0, 300).select(F.xxhash64("id").alias("h"), F.xxhash64("id", F.lit(7), F.lit(42)).alias("want"), "id").collect()
    keys = np.array([r["h"] for r in rows])
    assert intask.hash_int(42, intask.hash_int(7, keys)).tolist() == [r["want"] for r in rows]
    drawn = {r["id"]: r["__w"] for r in T._pairs(spark.range(0, 300), 8, ["id"], 42).filter("tree = 7").collect()}
    assert intask.bag(keys, 7, 42).tolist() == [drawn.get(r["id"], 0) for r in rows]
    nodes = spark.range(1, 200).select(F.lit(7).alias("tree"), F.col("id").cast("int").alias("__node")).select(T._tried(64, 8, 42).alias("f"))
    assert intask.tried(np.arange(1, 200), 7, 64, 8, 42).tolist() == [r["f"] for r in nodes.collect()]


def both_ways(monkeypatch, call):
    here = call()
    monkeypatch.setattr(intask, "TASK_BYTES", 0)
    return here, call()


def test_sampled_boosting_in_a_task_equals_levels(spark, monkeypatch):
    data = spark.createDataFrame(curved(150) + [(None, 901, 0.1, 0.2, 0.3, 1.0), (None, 902, 0.9, 0.2, 0.3, 2.0), (7, 903, 0.1, 0.1, 0.1, 2.0)], ROW)

    def call():
        model = T.boost(data, ["g"], ["a", "b", "c"], F.col("y"), rounds=3, depth=3, rate=0.4, key="id", sample=0.7, columns=2)
        return {r["id"]: r["prediction"] for r in T.predict(model, data).collect()}

    here, levels = both_ways(monkeypatch, call)
    assert len(here) == 153 and here == pytest.approx(levels)


def test_search_in_tasks_equals_levels(spark, monkeypatch):
    data = spark.createDataFrame(curved(120), ROW)
    call = lambda: {tuple(r[:4]): r[4] for r in L.boosted_search(data, ["a", "b", "c"], "y", "id", [1, 3], [0.3, 0.6], [1, 3], folds=2, sample=0.8, columns=2).collect()}
    here, levels = both_ways(monkeypatch, call)
    assert len(here) == 8 and here == pytest.approx(levels)


def test_cv_search_has_the_whole_grid():
    """The reference's: 5 depths, 4 numbers of rounds, 3 rates."""
    assert P.CV_SEARCH == {"maxDepth": [3, 4, 5, 6, 7], "maxIter": [50, 75, 100, 125], "stepSize": [0.075, 0.05, 0.1]}


def test_cv_search_of_boosted_trees_scores_and_refits(spark):
    from pyspark.ml.tuning import ParamGridBuilder

    data = spark.createDataFrame(curved(200), ROW).withColumn("y", F.col("y") - 10 * F.col("g")).withColumn("label", F.col("y"))
    est = L.reg_boosted()
    grid = ParamGridBuilder().addGrid(est.maxDepth, [1, 3]).addGrid(est.maxIter, [2, 30]).addGrid(est.stepSize, [0.1, 0.2]).build()
    model, rows = L.cv_search(est, grid, L.evaluator_rmse(), L.assemble(data, ["a", "b", "c"]), folds=3, key="id")
    assert [p for p, _ in rows] == grid
    best = min(rows, key=lambda r: r[1])[0]
    assert best[est.maxIter] == 30 and model.trees == 30 and model.rate == best[est.stepSize]
    renamed = data.select("y", *[F.col(c).alias(f"x{i}") for i, c in enumerate(["a", "b", "c"])])
    spread, error = T.predict(model, renamed).agg(F.var_pop("y"), F.avg(F.pow(F.col("y") - F.col("prediction"), F.lit(2)))).first()
    assert error < spread / 2
    table = {r["params"]: r["rmse"] for r in L.search_table(spark, rows, "rmse").collect()}
    assert set(table) == {str(p) for p in P._grid_names(maxDepth=[1, 3], maxIter=[2, 30], stepSize=[0.1, 0.2])}
    assert table["[('maxDepth', 3.0), ('maxIter', 30.0), ('stepSize', 0.2)]"] < 0.7 * table["[('maxDepth', 1.0), ('maxIter', 2.0), ('stepSize', 0.1)]"]


def test_forest_search_in_tasks_equals_levels(spark, monkeypatch):
    data = spark.createDataFrame([r[1:] for r in labelled(240)] + [(900, None, 0.1, 0.2, 1.0), (901, 0.1, 0.1, 0.2, None), (902, float("nan"), 0.1, 0.2, 1.0)], ROW.split(", ", 1)[1])
    train, held = data.filter("id % 4 > 0"), data.filter("id % 4 = 0")
    call = lambda: {(r["trees"], r["depth"]): (r["n"], r["accuracy"]) for r in L.forest_search(train, held, ["a", "b", "c"], "y", [0, 1, 2, 3], ["id"], [3, 20, 16], [0, 2, 5]).collect()}
    assert L.forest_search(train.limit(0), held, ["a", "b", "c"], "y", [0, 1], ["id"], [3], [2]).count() == 0
    here, levels = both_ways(monkeypatch, call)
    assert len(here) == 9 and here == levels
    assert {n for n, _ in here.values()} == {60} and here[20, 5][1] > here[20, 0][1]


@pytest.mark.parametrize("classes", [False, True])
def test_deep_nodes_split_as_wide_ones(classes):
    """Nodes of few rows are put in order instead of counted by bin; both ways are the same."""
    rng = np.random.default_rng(1)
    bins, rank = rng.integers(0, 32, (400, 5)).astype(np.int8), np.sort(rng.integers(0, 40, 400))
    w, slots = rng.integers(1, 4, 400).astype(float), intask.tried(np.arange(40), 3, 5, 2, 42)
    given = (rng.integers(0, 3, 400), np.array([0.2, 0.3, 0.5])) if classes else (rng.normal(size=(400, 3)), None)
    outputs = intask.Outputs(w, *given)
    deep = intask.best_splits(rank, 40, bins, outputs, slots)
    assert len(deep[0]) > 30
    for node in range(40):
        own = np.tile(np.flatnonzero(rank == node), 20)
        alone = intask.best_splits(np.zeros(len(own), np.int64), 1, bins[own], outputs.taken(own), slots[node:node + 1])
        mine = [v[deep[0] == node] for v in deep[1:]]
        assert [v.tolist() for v in mine[:2]] == [v.tolist() for v in alone[1:3]]
        assert all(np.allclose(a, b) for a, b in zip(mine[2:], alone[3:]))


def test_classes_are_indicators_less_their_means():
    rng = np.random.default_rng(2)
    bins, w, codes, means = rng.integers(0, 32, (300, 6)).astype(np.int8), rng.integers(1, 4, 300).astype(float), rng.integers(0, 4, 300), np.array([0.1, 0.2, 0.3, 0.4])
    ways = [intask.Outputs(w, codes, means), intask.Outputs(w, np.eye(4)[codes] - means)]
    trees = [[v.copy() for v in intask.grown(bins, o, bins, 1, 7, 2)] for o in ways]
    assert len(trees[0]) == 8 and np.allclose(*trees)


def test_holdout_search_writes_no_pairs(spark, monkeypatch):
    """It grew 375 trees level by level, which did not end in time on 10,000 vectors."""
    def stop(*args, **kwargs):
        raise AssertionError("grown level by level")

    monkeypatch.setattr(T, "grow", stop)
    monkeypatch.setitem(P._SETTINGS, "sizes", [3, 5])
    monkeypatch.setitem(P._SETTINGS, "depths", [2, 4])
    assert sorted(map(tuple, P.q_holdout_search(spark, SF_SMALL).collect())) == sorted((str(p), True) for p in P._grid_names(maxDepth=[2, 4], numTrees=[3, 5]))


def test_executors_need_not_find_the_package(tmp_path):
    """A driver started elsewhere adds the package to its own path only."""
    (tmp_path / "f").write_bytes(cloudpickle.dumps(lambda: (intask.bag(np.arange(3), 1, 42).tolist(), "quarry" in sys.modules)))
    told = "from pyspark import cloudpickle; print(cloudpickle.loads(open('f', 'rb').read())())"
    out = subprocess.run([sys.executable, "-c", told], cwd=tmp_path, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, capture_output=True, text=True)
    assert out.stdout.strip() == str((intask.bag(np.arange(3), 1, 42).tolist(), False)), out.stderr
