"""Registered learning jobs.

The operators return models and predictions. What a solver predicts cannot be
repeated in SQL, so the registered fits return what must hold for any correct
one, row by row: the held-out ids and labels, that each prediction is in the
labels' domain (or finite), and that the fit beats the constant predictor.
Searches return their grid with whether each point was scored.
"""

from __future__ import annotations

from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from quarry.operators import graph as G
from quarry.operators import learn as L
from quarry.plans.registry import query
from quarry.plans.stats import rounded
from quarry.session import written
from quarry.sources.fixtures import days, ratings, trust
from quarry.sources.tables import load

DAY_FEATURES = ["temperature", "humidity", "wind_speed", "feels_like_temp", "month", "weekday", "season_id", "year"]


def _embeddings(spark, sf):
    e = load(spark, sf, "embeddings")
    return L.vectors(e, "embedding").select("vec_id", "features", F.col("label").cast("double").alias("label"))


def _clf_split(spark, sf):
    d = L.holdout_split(L.settled(_embeddings(spark, sf)), "vec_id", 0.2)
    return d.filter("split = 'train'"), d.filter("split = 'test'")


def _checked_classifier(spark, sf, est):
    """Held-out rows with ``in_domain``, and whether the fit beats the majority
    class on its training rows (the tables' labels may not follow the vectors,
    so the held-out rows need not be predictable)."""
    train, test = _clf_split(spark, sf)
    model = est.fit(train)
    pred = model.transform(test).select("vec_id", "label", "prediction")
    labels = [r[0] for r in train.select("label").distinct().collect()]  # one value per class
    accuracy = model.transform(train).agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).scalar()
    majority = train.groupBy("label").count().agg(F.max("count") / F.sum("count")).scalar()
    return pred.select("vec_id", "label", F.col("prediction").isin(labels).alias("in_domain"), (accuracy > majority).alias("beats_majority"))


_CLF_SQL = """
SELECT vec_id, CAST(label AS DOUBLE) AS label, true AS in_domain, true AS beats_majority
FROM embeddings WHERE substr(md5(CAST(vec_id AS VARCHAR)), 1, 4) < '3333'"""


def _finite(c):
    return F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))


def _checked_regression(model, data):
    """Held-out days with ``finite``, and whether the fit beats the mean on its training rows."""
    train = model.transform(data.filter("split = 'train'"))
    error = train.agg(F.avg(F.pow(F.col("label") - F.col("prediction"), 2))).scalar()
    spread = train.agg(F.var_pop("label")).scalar()
    test = model.transform(data.filter("split = 'test'"))
    return test.select("date", "label", _finite("prediction").alias("finite"), (error < spread).alias("beats_mean"))


_REG_SQL = """
SELECT date, CAST(total_users AS DOUBLE) AS label, true AS finite, true AS beats_mean
FROM days WHERE substr(md5(CAST(date AS VARCHAR)), 1, 4) < '2666'"""


def _grid_sql(grid, metric: str) -> str:
    rows = ", ".join("('" + str(p).replace("'", "''") + "', true)" for p in grid)
    return f"SELECT * FROM (VALUES {rows}) t(params, scored)"


def _grid_names(**values):
    """The grid's rows as the search table names them."""
    import itertools

    return [sorted((k, float(v)) for k, v in zip(values, point, strict=True)) for point in itertools.product(*values.values())]


def _scored(table, metric):
    return table.select("params", _finite(metric).alias("scored"))


@query("holdout_split", """
SELECT vec_id, label, CASE WHEN substr(md5(CAST(vec_id AS VARCHAR)), 1, 4) < '3333' THEN 'test' ELSE 'train' END AS split
FROM embeddings""")
def q_holdout_split(spark, sf):
    return L.holdout_split(load(spark, sf, "embeddings").select("vec_id", "label"), "vec_id", 0.2)


@query("stratified_split", """
SELECT date, year, season_id,
  CASE WHEN row_number() OVER (PARTITION BY year, season_id ORDER BY md5(CAST(date AS VARCHAR)))
            <= floor(count(*) OVER (PARTITION BY year, season_id) * 0.15 + 0.5) THEN 'test' ELSE 'train' END AS split
FROM days""", ("days",))
def q_stratified_split(spark, sf):
    d = days(spark, sf).select("date", "year", "season_id")
    return L.stratified_split(d, "date", ["year", "season_id"], 0.15)


@query("clf_logistic", _CLF_SQL)
def q_clf_logistic(spark, sf):
    return _checked_classifier(spark, sf, L.clf_logistic(max_iter=1000))


@query("clf_svc", _CLF_SQL)
def q_clf_svc(spark, sf):
    return _checked_classifier(spark, sf, L.clf_svc(max_iter=100))


@query("clf_forest", _CLF_SQL)
def q_clf_forest(spark, sf):
    return _checked_classifier(spark, sf, L.clf_forest(num_trees=100, max_depth=6))


@query("clf_boosted", _CLF_SQL)
def q_clf_boosted(spark, sf):
    return _checked_classifier(spark, sf, L.clf_boosted(max_iter=10, max_depth=3))


@query("clf_svc_rbf", _CLF_SQL)
def q_clf_svc_rbf(spark, sf):
    e = load(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"), F.col("label").cast("double").alias("label"))
    d = L.holdout_split(e, "vec_id", 0.2)
    train, test = d.filter("split = 'train'"), d.filter("split = 'test'")
    pred = L.svc_rbf(train, train.withColumn("part", F.lit(0)).unionByName(test.withColumn("part", F.lit(1))), "x")
    labels = [r[0] for r in train.select("label").distinct().collect()]  # one value per class
    accuracy = pred.filter("part = 0").agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).scalar()
    majority = train.groupBy("label").count().agg(F.max("count") / F.sum("count")).scalar()
    return pred.filter("part = 1").select("vec_id", "label", F.col("prediction").isin(labels).alias("in_domain"), (accuracy > majority).alias("beats_majority"))


# one-vs-rest lines cannot part the middle quarters from the rest by the month, the other fits can
FLOORS = {"logistic": 0.9, "svc": 0.7, "svc_rbf": 0.9, "forest": 0.95, "boosted": 0.95, "reg_boosted": 0.8, "reg_forest": 0.8, "group_forests": 0.5}


@query("model_floors", "SELECT * FROM (VALUES " + ", ".join(f"('{m}', true)" for m in FLOORS) + ") t(model, reached)")
def q_model_floors(spark, sf):
    """Held-out accuracy (classifiers: season from the day's figures) or explained share (regression: a mix of figures
    with products) of every kind of fit against a fixed floor, on labels that the features determine."""
    d = days(spark, sf)
    target = F.col("month") * 2.0 + F.when(F.col("weekday") < 5, 4.0).otherwise(0.0) + F.col("month") * F.col("year")
    x = F.array(*[F.col(c).cast("double") for c in ("month", "weekday", "year")])
    d = L.settled(L.assemble(d, ["month", "weekday", "year"]).withColumns({"x": x, "season": (F.col("season_id") - 1).cast("double"), "target": target}))
    d = L.holdout_split(d, "date", 0.2)
    train, test = d.filter("split = 'train'").persist(), d.filter("split = 'test'").persist()
    right = F.avg((F.col("season") == F.col("prediction")).cast("double"))
    share = 1 - F.avg(F.pow(F.col("target") - F.col("prediction"), F.lit(2))) / F.var_pop("target")
    by_season, by_target = (lambda df: df.withColumn("label", F.col("season"))), (lambda df: df.withColumn("label", F.col("target")))
    out = {}
    for name, est in (("logistic", L.clf_logistic()), ("svc", L.clf_svc()), ("forest", L.clf_forest(50, 5)), ("boosted", L.clf_boosted(10, 3))):
        out[name] = est.fit(by_season(train)).transform(by_season(test)).agg(right)
    out["svc_rbf"] = L.svc_rbf(by_season(train), by_season(test), "x", gamma=1.0).agg(right)
    for name, est in (("reg_boosted", L.reg_boosted(40)), ("reg_forest", L.reg_forest(50, 8))):
        out[name] = est.fit(by_target(train)).transform(by_target(test)).agg(share)
    out["group_forests"] = L.group_forests(d, ["season_id"], ["month", "weekday", "year"], "target", ["date"], trees=20, depth=5).agg(share)
    train.unpersist()
    rows = [(name, float(out[name].first()[0]) >= floor) for name, floor in FLOORS.items()]  # one number per model
    test.unpersist()
    return spark.createDataFrame(rows, "model string, reached boolean")


# Metric arithmetic checked exactly on a deterministic (label, prediction)
# pair set read from the labels table: quality against 1 - toxic.
@query("classification_metrics", """
WITH p AS (SELECT CAST(quality AS DOUBLE) AS y, CAST(1 - toxic AS DOUBLE) AS p FROM labels),
n AS (SELECT count(*) AS n FROM p),
t AS (SELECT y, count(*) AS support, sum(CASE WHEN y = p THEN 1 ELSE 0 END) AS tp FROM p GROUP BY y),
q AS (SELECT p AS y, count(*) AS predicted FROM p GROUP BY p),
c AS (SELECT t.y, support, tp, coalesce(predicted, 0) AS predicted FROM t LEFT JOIN q ON t.y = q.y),
m AS (SELECT support, tp, coalesce(tp / nullif(predicted, 0), 0) AS prec, tp / support AS rec FROM c)
SELECT round(sum(tp) / max(n.n), 6) AS accuracy, round(sum(support / n.n * prec), 6) AS precision,
       round(sum(support / n.n * rec), 6) AS recall,
       round(sum(support / n.n * coalesce(2 * prec * rec / nullif(prec + rec, 0), 0)), 6) AS f1
FROM m, n""")
def q_classification_metrics(spark, sf):
    lab = load(spark, sf, "labels")
    return rounded(L.classification_metrics(lab.select(F.col("quality").alias("label"), (1 - F.col("toxic")).alias("prediction"))))


@query("model_metrics", "SELECT true AS accuracy, true AS precision, true AS recall, true AS f1")
def q_model_metrics(spark, sf):
    train, test = _clf_split(spark, sf)
    pred = L.clf_logistic(max_iter=1000).fit(train).transform(test)
    out = L.classification_metrics(pred)
    return out.select(*[((F.col(c) > 0) & (F.col(c) <= 1)).alias(c) for c in out.columns])


SEARCH = {"numTrees": list(range(50, 400, 25)), "maxDepth": list(range(6, 20, 2))}


@query("holdout_search", _grid_sql(_grid_names(**SEARCH), "accuracy"))
def q_holdout_search(spark, sf):
    """All 98 settings of the reference's grid, read off one forest of 375 trees of depth 18."""
    e = load(spark, sf, "embeddings").filter("label IS NOT NULL")
    size = e.agg(F.max(F.size("embedding"))).first()[0]
    classes = sorted(r[0] for r in e.select("label").distinct().collect())  # one value per class
    names = [f"x{i}" for i in range(size)]
    rows = L.holdout_split(e.select("vec_id", "label", *[F.col("embedding")[i].alias(c) for i, c in enumerate(names)]), "vec_id", 0.2)
    rows = L.holdout_split(rows.filter("split = 'train'"), "vec_id", 0.2, salt="search")
    table = L.forest_search(rows.filter("split = 'train'"), rows.filter("split = 'test'"), names, "label", classes, ["vec_id"], **_SETTINGS)
    return table.select(F.format_string("[('maxDepth', %.1f), ('numTrees', %.1f)]", F.col("depth").cast("double"), F.col("trees").cast("double")).alias("params"),
                        _finite("accuracy").alias("scored"))


_SETTINGS = {"sizes": SEARCH["numTrees"], "depths": SEARCH["maxDepth"]}


def _day_data(spark, sf):
    d = days(spark, sf)
    return L.settled(L.assemble(d, DAY_FEATURES).withColumn("label", F.col("total_users").cast("double")))


CV_SEARCH = {"maxDepth": [3, 4, 5, 6, 7], "maxIter": [50, 75, 100, 125], "stepSize": [0.075, 0.05, 0.1]}


@query("cv_search", _grid_sql(_grid_names(**CV_SEARCH), "rmse"))
def q_cv_search(spark, sf):
    """All 60 settings of the reference's grid on 5 folds: 300 boosted fits, with 0.8 of the rows and of the features."""
    est = L.reg_boosted()
    grid = ParamGridBuilder().addGrid(est.maxDepth, CV_SEARCH["maxDepth"]).addGrid(est.maxIter, CV_SEARCH["maxIter"]).addGrid(est.stepSize, CV_SEARCH["stepSize"]).build()
    _, rows = L.cv_search(est, grid, L.evaluator_rmse(), _day_data(spark, sf), folds=5, key="date")
    return _scored(L.search_table(spark, rows, "rmse"), "rmse")


@query("cv_score", "SELECT * FROM (VALUES ('all', true), ('selected', true)) t(feature_set, scored)")
def q_cv_score(spark, sf):
    """Two feature sets: all, and those that a forest finds important (H15 feeds H10)."""
    d = days(spark, sf).withColumn("label", F.col("total_users").cast("double"))
    forest = L.reg_forest(num_trees=50, max_depth=6)
    found = L.feature_importance(spark, forest.fit(L.assemble(d, DAY_FEATURES)), DAY_FEATURES, min_importance=0.05)
    selected = [r["feature"] for r in found.collect()]  # at most one row per feature
    out = None
    for name, cols in (("all", DAY_FEATURES), ("selected", selected or DAY_FEATURES)):
        t = L.forest_cv(d, cols, "label", "date", trees=200, depth=6).agg(F.lit(name).alias("feature_set"), F.avg("mse").alias("mse"))
        out = t if out is None else out.unionByName(t)
    return out.select("feature_set", _finite("mse").alias("scored"))


@query("group_models", """
WITH s AS (SELECT year, season_id, date, total_users,
  row_number() OVER (PARTITION BY year, season_id ORDER BY md5(CAST(date AS VARCHAR)))
    <= floor(count(*) OVER (PARTITION BY year, season_id) * 0.15 + 0.5) AS test FROM days)
SELECT year, season_id, date, CAST(total_users AS DOUBLE) AS label, true AS finite FROM s
WHERE test AND (year, season_id) IN (SELECT (year, season_id) FROM s WHERE NOT test)""", ("days",))
def q_group_models(spark, sf):
    """Forests of 200 trees for all groups at once, scored on the groups' held-out days."""
    d = days(spark, sf).withColumn("label", F.col("total_users").cast("double"))
    d = L.stratified_split(d, "date", ["year", "season_id"], 0.15)
    pred = L.group_forests(d, ["year", "season_id"], DAY_FEATURES, "label", ["date"], trees=200, depth=8)
    return pred.select("year", "season_id", "date", "label", _finite("prediction").alias("finite"))


@query("group_boosted", """
WITH s AS (SELECT year, season_id, date, total_users,
  row_number() OVER (PARTITION BY year, season_id ORDER BY md5(CAST(date AS VARCHAR)))
    <= floor(count(*) OVER (PARTITION BY year, season_id) * 0.15 + 0.5) AS test FROM days),
g AS (SELECT year, season_id, var_pop(total_users) > 0 AS varied FROM s WHERE NOT test GROUP BY 1, 2)
SELECT s.year, s.season_id, date, CAST(total_users AS DOUBLE) AS label, true AS finite, varied AS beats_mean
FROM s JOIN g ON s.year = g.year AND s.season_id = g.season_id WHERE test""", ("days",))
def q_group_boosted(spark, sf):
    """Boosted trees for all groups at once on the groups' held-out days; ``beats_mean``: a group's trees come closer to
    its training rows than their mean does."""
    d = days(spark, sf).withColumn("label", F.col("total_users").cast("double"))
    d = L.stratified_split(d, "date", ["year", "season_id"], 0.15)
    seen = d.filter("split = 'train'").withColumn("split", F.lit("seen"))
    pred, _ = written(L.group_boosted(d.unionByName(seen), ["year", "season_id"], DAY_FEATURES, "label", rounds=6, depth=3, rate=0.3), "boosted-days")
    error = F.avg(F.pow(F.col("label") - F.col("prediction"), F.lit(2)))
    fit = pred.filter("split = 'seen'").groupBy("year", "season_id").agg((error < F.var_pop("label")).alias("beats_mean"))
    return pred.filter("split = 'test'").join(fit, ["year", "season_id"]).select("year", "season_id", "date", "label", _finite("prediction").alias("finite"), "beats_mean")


@query("reg_boosted", _REG_SQL, ("days",))
def q_reg_boosted(spark, sf):
    d = L.holdout_split(_day_data(spark, sf), "date", 0.15)
    return _checked_regression(L.reg_boosted(max_iter=70).fit(d.filter("split = 'train'")), d)


@query("reg_forest", _REG_SQL, ("days",))
def q_reg_forest(spark, sf):
    d = L.holdout_split(_day_data(spark, sf), "date", 0.15)
    return _checked_regression(L.reg_forest(num_trees=200, max_depth=8).fit(d.filter("split = 'train'")), d)


@query("feature_importance", "SELECT true AS known_features, true AS sums_to_one, true AS falling")
def q_feature_importance(spark, sf):
    m = L.reg_forest(num_trees=200, max_depth=8).fit(_day_data(spark, sf))
    found = L.feature_importance(spark, m, DAY_FEATURES, min_importance=-1.0)
    listed = F.collect_list("importance")
    return found.agg(
        F.bool_and(F.col("feature").isin(DAY_FEATURES)).alias("known_features"),
        (F.abs(F.sum("importance") - 1) < 1e-6).alias("sums_to_one"),
        (F.sort_array(listed, asc=False) == listed).alias("falling"))


# Error arithmetic checked exactly with a deterministic predictor: the
# season's mean of total_users.
@query("regression_error", """
WITH p AS (SELECT total_users AS label, avg(total_users) OVER (PARTITION BY season_id) AS prediction FROM days)
SELECT round(avg(pow(label - prediction, 2)), 6) AS mse, round(sqrt(avg(pow(label - prediction, 2))), 6) AS rmse FROM p""",
       ("days",))
def q_regression_error(spark, sf):
    d = days(spark, sf)
    means = d.groupBy("season_id").agg(F.avg("total_users").alias("prediction"))
    return rounded(L.regression_error(d.join(means, "season_id").withColumn("label", F.col("total_users"))))


_RATING_SQL = """
WITH s AS (SELECT *, substr(md5(CAST(user_id AS VARCHAR) || ':' || CAST(item_id AS VARCHAR)), 1, 4) < '3333' AS test FROM ratings),
g AS (SELECT avg(label) AS m FROM s WHERE NOT test),
u AS (SELECT user_id, avg(label) - any_value(m) AS b FROM s, g WHERE NOT test GROUP BY 1),
i AS (SELECT item_id, avg(label) - any_value(m) AS b FROM s, g WHERE NOT test GROUP BY 1)
SELECT s.user_id, s.item_id, s.label, round(m + coalesce(u.b, 0) + coalesce(i.b, 0), 6) AS baseline_pred, true AS finite
FROM s CROSS JOIN g LEFT JOIN u ON s.user_id = u.user_id LEFT JOIN i ON s.item_id = i.item_id WHERE test"""


@query("rating_prediction", _RATING_SQL, ("ratings",))
def q_rating_prediction(spark, sf):
    """Split first; biases, statistics and the residual model come from the training ratings alone."""
    rows = L.holdout_split(ratings(spark, sf).withColumn("rid", F.concat_ws(":", "user_id", "item_id")), "rid", 0.2).drop("rid")
    train, test = (rows.filter(F.col("split") == k).drop("split") for k in ("train", "test"))
    edges = trust(spark, sf)
    cols = ["avg_rating_trustees", "var_rating_trustees", "num_trustees_rated", "average_rating",
            "number_of_ratings", "total_number_of_trustees", "total_number_of_trusters",
            "item_average_rating", "item_number_of_reviews"]
    features = lambda part: L.settled(L.assemble(G.rating_features(train, edges, part).na.fill(-1.0, cols).na.fill(-1, cols), cols).select("user_id", "item_id", "label", "baseline_pred", "residual", "features"))
    model = L.reg_boosted(max_iter=70).setLabelCol("residual").fit(features(train))
    pred = model.transform(features(test)).withColumn("prediction", F.col("baseline_pred") + F.col("prediction"))
    return rounded(pred.select("user_id", "item_id", "label", "baseline_pred", _finite("prediction").alias("finite")))


@query("rating_prediction_khop", _RATING_SQL, ("ratings",))
def q_rating_prediction_khop(spark, sf):
    """G6 on the k-hop columns (G3): a boosted residual model on mean, spread, count, median, least and greatest of the
    ratings within 1 to 9 hops, all from the training ratings; a row's own rating is never among them."""
    rows = L.holdout_split(ratings(spark, sf).withColumn("rid", F.concat_ws(":", "user_id", "item_id")), "rid", 0.2).drop("rid")
    train, test = (rows.filter(F.col("split") == k).drop("split") for k in ("train", "test"))
    depths = range(1, 10)
    reach = G.khop_masks(trust(spark, sf), rows.select("user_id"), max_depth=9)
    cols = [f"{c}{d}" for d in depths for c in ("trust_mean", "trust_std", "trust_count", "median", "min", "max")]

    def features(part):
        base = G.rating_baseline(train, part).select("user_id", "item_id", "label", "baseline_pred", "residual")
        near = G.khop_rating_stats(part, train, reach, depths).select("user_id", "item_id", *cols)
        return L.assemble(base.join(near, ["user_id", "item_id"]), cols).select("user_id", "item_id", "label", "baseline_pred", "residual", "features")

    known, _ = written(features(train), "khop-train")
    asked, _ = written(features(test), "khop-test")
    model = L.reg_boosted(max_iter=70).setLabelCol("residual").fit(known)
    pred = model.transform(asked).withColumn("prediction", F.col("baseline_pred") + F.col("prediction"))
    return rounded(pred.select("user_id", "item_id", "label", "baseline_pred", _finite("prediction").alias("finite")))
