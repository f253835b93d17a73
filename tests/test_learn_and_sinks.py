"""Learning jobs: metrics recomputed exactly; sinks write and read back."""

import os

import pandas as pd
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from quarry.operators import learn as L
from quarry.sources import sinks
from quarry.sources.fixtures import days, transactions
from quarry.sources.tables import read_table
from tests.conftest import SF_SMALL


def _pred(spark):
    e = L.vectors(spark.read.parquet(f"{SF_SMALL}/embeddings.parquet"), "embedding")
    e = e.withColumn("label", F.col("label").cast("double"))
    d = L.holdout_split(e, "vec_id", 0.3)
    m = L.clf_forest(num_trees=10, max_depth=4).fit(d.filter("split = 'train'"))
    return m.transform(d.filter("split = 'test'"))


def test_classification_metrics_equal_mllib(spark):
    p = _pred(spark).cache()
    ours = L.classification_metrics(p).first()
    for name, metric in (("accuracy", "accuracy"), ("precision", "weightedPrecision"),
                         ("recall", "weightedRecall"), ("f1", "f1")):
        want = MulticlassClassificationEvaluator(metricName=metric).evaluate(p)
        assert abs(ours[name] - want) < 1e-6, name


def test_regression_error_equals_mllib(spark):
    d = days(spark, SF_SMALL)
    p = d.select(F.col("total_users").cast("double").alias("label"), (F.col("temperature") * 0.1).alias("prediction"))
    ours = L.regression_error(p).first()
    assert abs(ours.mse - RegressionEvaluator(metricName="mse").evaluate(p)) < 1e-5
    assert abs(ours.rmse - RegressionEvaluator(metricName="rmse").evaluate(p)) < 1e-5


def test_group_line_mse_matches_per_group_fit_and_total(spark):
    d = days(spark, SF_SMALL)
    got = L.group_line_mse(d, ["year", "season_id"], "temperature", "total_users").toPandas()
    pdf = d.toPandas()
    total_sse, total_n = 0.0, 0
    for (y, s), g in pdf.groupby(["year", "season_id"]):
        x, t = g["temperature"], g["total_users"].astype(float)
        b = ((x - x.mean()) * (t - t.mean())).sum() / ((x - x.mean()) ** 2).sum()
        resid = t - (t.mean() + b * (x - x.mean()))
        mse = (resid ** 2).mean()
        row = got[(got.year == str(y)) & (got.season_id == str(s))].iloc[0]
        assert abs(row.mse - mse) < 1e-4 * max(1, mse)
        total_sse += (resid ** 2).sum()
        total_n += len(g)
    tot = got[got.year == "all"].iloc[0]
    assert tot.n == total_n and abs(tot.mse - total_sse / total_n) < 1e-4 * max(1, tot.mse)


def test_holdout_split_is_stable_and_sized(spark):
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id")
    a = L.holdout_split(e, "vec_id", 0.2).toPandas().sort_values("vec_id")
    b = L.holdout_split(e.repartition(7), "vec_id", 0.2).toPandas().sort_values("vec_id")
    assert a["split"].tolist() == b["split"].tolist()
    assert 0.12 < (a["split"] == "test").mean() < 0.28


def test_holdout_split_takes_any_fraction(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    assert L.holdout_split(df, "k", 1.0).filter("split = 'test'").count() == 1000
    assert L.holdout_split(df, "k", 0.0).filter("split = 'test'").count() == 0


def test_stratified_split_is_exact_in_every_stratum(spark):
    import hashlib

    df = spark.range(3000).selectExpr("id AS k", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE concat('s', id % 5) END AS g")
    got = L.stratified_split(df, "k", ["g"], 0.15).toPandas()
    assert len(got) == 3000
    for _, part in got.groupby("g", dropna=False):
        order = part.assign(h=[hashlib.md5(str(k).encode()).hexdigest() for k in part.k]).sort_values("h")
        want = int(len(part) * 0.15 + 0.5)
        assert (order.split == "test").tolist() == [True] * want + [False] * (len(part) - want)


def test_models_of_many_groups_are_scored_on_held_out_rows(spark):
    from pyspark.ml.regression import LinearRegression

    df = spark.range(120).selectExpr("id", "CASE WHEN id % 12 = 0 THEN NULL ELSE id % 12 END AS g", "CAST(id AS DOUBLE) AS x", "CAST(id * 2 AS DOUBLE) AS y",
                                     "CASE WHEN id % 5 = 0 THEN 'test' ELSE 'train' END AS split")
    pred = L.group_models(df, ["g"], ["x"], "y", lambda: LinearRegression())
    rows = pred.collect()
    assert sorted(r.id for r in rows) == list(range(0, 120, 5))
    assert all(abs(r.prediction - r.y) < 1e-3 for r in rows)


def test_held_out_labels_reach_no_feature(spark):
    from quarry.operators import graph as G

    rows = [(u, i, float((u * i) % 5 + 1)) for u in range(12) for i in range(6)]
    schema = "user_id long, item_id int, label double"
    train = spark.createDataFrame([r for r in rows if r[0] % 3], schema)
    edges = spark.createDataFrame([(u, (u * 5 + 1) % 12) for u in range(12)], "trustor long, trustee long")
    outs = []
    for shift in (0.0, 3.0):
        test = spark.createDataFrame([(u, i, v + shift) for u, i, v in rows if u % 3 == 0], schema)
        outs.append(sorted(map(tuple, G.rating_features(train, edges, test).drop("label", "residual").collect()), key=str))
    assert outs[0] == outs[1]


def test_feature_importance_sorted(spark):
    d = L.assemble(days(spark, SF_SMALL), ["temperature", "humidity", "month"]).withColumn(
        "label", F.col("total_users").cast("double"))
    m = L.reg_forest(num_trees=5, max_depth=3).fit(d)
    imp = L.feature_importance(spark, m, ["temperature", "humidity", "month"]).toPandas()
    assert list(imp["importance"]) == sorted(imp["importance"], reverse=True)


def test_write_report_and_read_back_with_schema(spark, tmp_path):
    from quarry.operators import reports as R

    rep = R.merchant_category_summary(transactions(spark, SF_SMALL))
    path = str(tmp_path / "merchant_category_df")
    sinks.write_report(rep, path)
    back = read_table(spark, path, rep.schema)
    assert back.count() == rep.count()
    sinks.write_report(rep, path)  # overwrite
    assert read_table(spark, path, rep.schema).count() == rep.count()


def test_csv_missing_value_is_null_not_nan(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("hour,failure_reason\n0,\n1,cancelled\n")
    df = read_table(spark, str(p), "hour int, failure_reason string")
    assert df.filter(F.col("failure_reason").isNotNull()).count() == 1


def test_load_summary_and_predictions(spark, tmp_path):
    from quarry.operators import reports as R

    rep = R.customer_type_summary(transactions(spark, SF_SMALL))
    sinks.load_summary(rep, str(tmp_path / "summary"), id_column="customer_type")
    back = spark.read.parquet(str(tmp_path / "summary"))
    assert "_id" in back.columns and back.count() == 3
    preds = spark.createDataFrame([(1, 0.5), (2, 1.5)], "id long, prediction double")
    sinks.write_predictions(preds, str(tmp_path / "pred"))
    assert spark.read.option("header", True).csv(str(tmp_path / "pred")).columns == ["id", "Label"]


def test_job_runner_writes_result(spark, tmp_path):
    from quarry.__main__ import main

    out = str(tmp_path / "c1")
    assert main(["merchant_category_summary", SF_SMALL, out, "--master", "local[4]", "--shuffle-partitions", "8"]) == 0
    assert spark.read.parquet(out).count() == 5


def test_group_linear_on_many_features_and_singular_groups(spark):
    import numpy as np

    rng = np.random.default_rng(6)
    rows, x_of = [], {}
    for g, n in (("plain", 300), ("large", 200), ("twin", 80), ("still", 50), ("few", 3), ("one", 1)):
        x = rng.normal(size=(n, 4)) * [1, 5, 0.1, 3]
        if g == "large":
            x += 1e7  # means far from 0
        if g == "twin":
            x[:, 2] = x[:, 0] * 2 + x[:, 1]  # a combination of those before it
        if g == "still":
            x[:, 1] = 4.0
        y = x @ [1.0, -2.0, 3.0, 0.5] + rng.normal(size=n)
        x_of[g] = x, y
        rows += [(g, *map(float, a), float(b)) for a, b in zip(x, y)]
    rows += [("plain", None, 1.0, 1.0, 1.0, 1.0), ("plain", 1.0, 1.0, 1.0, 1.0, None), ("plain", float("nan"), 1.0, 1.0, 1.0, 1.0), (None, 1.0, 2.0, 3.0, 4.0, 5.0), ("none", None, 1.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "g string, a double, b double, c double, d double, y double").repartition(5)
    got = {r["g"]: r for r in L.group_linear(df, ["g"], ["a", "b", "c", "d"], "y").collect()}
    assert set(got) == {*x_of, None}
    for g, (x, y) in x_of.items():
        design = np.column_stack([np.ones(len(y)), x - x.mean(axis=0)])
        best = design @ np.linalg.lstsq(design, y, rcond=None)[0]
        mse = ((y - best) ** 2).mean()
        assert got[g]["n"] == len(y) and abs(got[g]["mse"] - mse) < 1e-6 * max(1, y.var())
        mine = got[g]["intercept"] + x @ np.array(got[g]["coefficients"])
        assert np.abs(mine - best).max() < 1e-4
    assert got["twin"]["coefficients"][2] == 0 and got["still"]["coefficients"][1] == 0 and got["one"]["coefficients"] == [0, 0, 0, 0]
    total = {r["g"]: (r["n"], r["mse"]) for r in L.group_linear_mse(df, ["g"], ["a", "b", "c", "d"], "y").collect()}
    assert set(total) == {"plain", "large", "twin", "still", "few", "all"}
    assert total["all"][0] == 633 and abs(total["all"][1] - sum(n * m for g, (n, m) in total.items() if g != "all") / 633) < 1e-9
    marked = df.withColumn("split", F.when(F.rand(1) < 0.3, "test").otherwise("train"))
    pred = L.group_linear_predict(marked, ["g"], ["a", "b", "c", "d"], "y").filter("g = 'plain' AND NOT isnan(prediction + y)")
    assert pred.agg(F.avg(F.pow(F.col("prediction") - F.col("y"), F.lit(2)))).first()[0] < 1.6


def test_fourier_features_beat_the_line_on_two_rings(spark):
    import math
    import random

    rng = random.Random(3)
    rows = []
    for i in range(600):
        radius, angle = (1.0 if i % 2 else 2.5) + rng.gauss(0, 0.15), rng.uniform(0, 2 * math.pi)
        rows.append(([radius * math.cos(angle), radius * math.sin(angle)], float(i % 2)))
    d = spark.createDataFrame(rows, "x array<double>, label double").repartition(4)
    train, test = d.limit(400), d.exceptAll(d.limit(400))
    right = lambda p: p.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    line = L.clf_svc(50).fit(L.vectors(train, "x"))
    assert right(line.transform(L.vectors(test, "x"))) < 0.75
    assert right(L.svc_rbf(train, test, "x", gamma=1.0, components=128)) > 0.97


def test_fourier_features_approximate_the_kernel(spark):
    import numpy as np

    x = np.random.default_rng(1).normal(size=(12, 5))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "i int, x array<double>")
    z = np.array([r["features"].toArray() for r in L.fourier_features(df, "x", 5, 0.1, 4000).orderBy("i").collect()])
    kernel = np.exp(-0.1 * ((x[:, None] - x[None]) ** 2).sum(axis=2))
    assert np.abs(z @ z.T - kernel).max() < 0.08


def test_console_sink_and_csv_scan(spark, tmp_path, capfd):
    from pyspark.sql import types as T

    src = str(tmp_path / "in")
    spark.createDataFrame([("a", 1), ("b", None)], "k string, v int").coalesce(1).write.option("header", True).csv(src)
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.IntegerType())])
    assert sorted(map(tuple, read_table(spark, src, schema).collect()), key=str) == [("a", 1), ("b", None)]
    stream = spark.readStream.schema(schema).option("header", True).csv(src)
    q = sinks.console(stream, str(tmp_path / "ckpt"))
    q.awaitTermination()
    assert q.exception() is None and q.lastProgress["numInputRows"] == 2
