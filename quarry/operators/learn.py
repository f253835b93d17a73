"""Learning jobs on MLlib.

Fits are distributed MLlib estimators; the only driver-side values are model
parameters, metrics and the feature-importance vector (all bounded by the
number of features or grid points, not by the data).
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression, OneVsRest,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators import intask
from quarry.operators import trees as trees_
from quarry.session import written

SEED = 42
#: Rows of a fit's input that one task takes at least, where there are so many.
PART_ROWS = 1 << 15


# --- splits ---------------------------------------------------------------------

def holdout_split(df: DataFrame, key: str, test_fraction: float = 0.2, salt: str = "") -> DataFrame:
    """H1: ``split`` = 'train' / 'test' from an MD5 of the row key (plus an
    optional salt): stable across partitionings, reruns and engines (unlike
    a random number per row). The first four hex digits are compared with
    the fraction scaled to 16 bits, so any SQL engine with ``md5`` can
    reproduce the split."""
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(salt)))
    number = F.conv(F.substring(digest, 1, 4), 16, 10).cast("int")
    return df.withColumn("split", F.when(number < int(round(test_fraction * 65536)), "test").otherwise("train"))


def stratified_split(df: DataFrame, key: str, strata: list[str], test_fraction: float = 0.15, salt: str = "") -> DataFrame:
    """H2: of each stratum's n rows the round(n * ``test_fraction``) whose MD5
    of the key comes first go to test; exact at every size, and any SQL engine
    can repeat it.

    No stratum is put in order as a whole: rows are counted per three leading
    hex digits (4096 cells a stratum), and only the rows of the one cell in
    which the test part ends are ranked.
    """
    from pyspark.sql import Window

    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(salt)))
    rows = df.withColumns({"__h": digest, "__c": F.substring(digest, 1, 3)})
    cells = rows.groupBy(*strata, "__c").agg(F.count(F.lit(1)).alias("__n"))
    upto = F.sum("__n").over(Window.partitionBy(*strata).orderBy("__c"))
    total = F.sum("__n").over(Window.partitionBy(*strata))
    cells = cells.withColumns({"__upto": upto, "__want": F.floor(total * F.lit(test_fraction) + 0.5)})
    same = [F.col(f"__s{i}").eqNullSafe(rows[c]) for i, c in enumerate(strata)] + [F.col("__d") == rows["__c"]]
    cells = cells.select(*[F.col(c).alias(f"__s{i}") for i, c in enumerate(strata)], F.col("__c").alias("__d"), "__n", "__upto", "__want")
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    rows = rows.join(cells, cond)
    whole = rows.filter((F.col("__upto") <= F.col("__want")) | (F.col("__upto") - F.col("__n") >= F.col("__want")))
    whole = whole.withColumn("split", F.when(F.col("__upto") <= F.col("__want"), "test").otherwise("train"))
    part = rows.filter((F.col("__upto") > F.col("__want")) & (F.col("__upto") - F.col("__n") < F.col("__want")))
    place = F.row_number().over(Window.partitionBy(*strata, "__d").orderBy("__h")) + F.col("__upto") - F.col("__n")
    part = part.withColumn("split", F.when(place <= F.col("__want"), "test").otherwise("train"))
    return whole.unionByName(part).select(*df.columns, "split")


# --- inputs -------------------------------------------------------------------------

def vectors(df: DataFrame, array_col: str, out: str = "features") -> DataFrame:
    """Array column (e.g. embeddings) to an MLlib vector."""
    return df.withColumn(out, array_to_vector(F.col(array_col)))


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)


def settled(df: DataFrame, tag: str = "fit-rows") -> DataFrame:
    """``df`` written once and read in as many parts as its rows ask for. A fit passes over its input hundreds of times;
    what comes before it is not computed again then, and the passes over a small table are a task each, not one for
    every partition of the shuffle that made it."""
    rows, _ = written(df, tag)
    return rows.coalesce(max(1, -(-rows.count() // PART_ROWS)))


# --- classifiers (H3-H6) ---------------------------------------------------------------

def clf_logistic(max_iter: int = 1000) -> Pipeline:
    """H3: standardise + multinomial logistic regression."""
    return Pipeline(stages=[
        StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True),
        LogisticRegression(featuresCol="scaled", labelCol="label", maxIter=max_iter),
    ])


def clf_svc(max_iter: int = 100) -> Pipeline:
    """H4: standardise + linear SVM, one-vs-rest for many classes (``svc_rbf`` is the kernel fit)."""
    return Pipeline(stages=[
        StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True),
        OneVsRest(classifier=LinearSVC(maxIter=max_iter), featuresCol="scaled", labelCol="label", parallelism=4),
    ])


def fourier_features(df: DataFrame, array_col: str, size: int, gamma: float | None = None, components: int = 256, out: str = "features", seed: int = SEED) -> DataFrame:
    """H4: ``out`` = random Fourier features of an array of ``size`` numbers, so that a
    linear fit on them approximates one with the kernel exp(-gamma |x - y|^2)
    (``gamma``: 1 / ``size`` by default, for standardised features).

    Frequencies and phases are ``components`` x ``size`` numbers drawn from the
    seed; the features are array expressions, no row leaves the JVM.
    """
    import numpy as np

    rng = np.random.default_rng(seed)
    gamma = 1.0 / size if gamma is None else gamma
    waves = rng.normal(0.0, (2 * gamma) ** 0.5, (components, size))
    phases = rng.uniform(0, 2 * np.pi, components)
    rows = ", ".join(f"array({', '.join(f'{v!r}D' for v in map(float, (p, *w)))})" for p, w in zip(phases, waves))
    dot = f"aggregate(zip_with(slice(w, 2, {size}), {array_col}, (a, b) -> a * b), w[0], (t, v) -> t + v)"
    return df.withColumn(out, array_to_vector(F.expr(f"transform(array({rows}), w -> {(2 / components) ** 0.5!r}D * cos({dot}))")))


def svc_rbf(train: DataFrame, test: DataFrame, array_col: str, label: str = "label", gamma: float | None = None, components: int = 256, max_iter: int = 100) -> DataFrame:
    """H4: support vectors with a Gaussian kernel by Fourier features in front of linear ones, one-vs-rest;
    ``test`` with its ``prediction``. Features are standardised by ``train``."""
    size = train.agg(F.max(F.size(array_col))).first()[0]
    moments = train.agg(F.array(*[F.avg(F.col(array_col)[i]) for i in range(size)]).alias("m"), F.array(*[F.stddev_samp(F.col(array_col)[i]) for i in range(size)]).alias("s")).first()
    scale = F.array(*[F.struct(F.lit(float(m)).alias("m"), F.lit(float(s) if s else 1.0).alias("s")) for m, s in zip(moments["m"], moments["s"])])

    def lifted(df: DataFrame) -> DataFrame:
        scaled = F.zip_with(F.col(array_col).cast("array<double>"), scale, lambda x, z: (x - z["m"]) / z["s"])
        return fourier_features(df.withColumn("__x", scaled), "__x", size, gamma, components, "__f").drop("__x")

    rows = lifted(train).persist()
    fit = OneVsRest(classifier=LinearSVC(maxIter=max_iter), featuresCol="__f", labelCol=label, parallelism=4).fit(rows)
    rows.unpersist()
    return fit.transform(lifted(test)).drop("__f")


def clf_forest(num_trees: int = 100, max_depth: int = 5) -> RandomForestClassifier:
    """H5."""
    return RandomForestClassifier(numTrees=num_trees, maxDepth=max_depth, seed=SEED)


def clf_boosted(max_iter: int = 20, max_depth: int = 5, step: float = 0.1) -> OneVsRest:
    """H6: boosted trees; MLlib's GBT is binary, so one-vs-rest for classes."""
    return OneVsRest(classifier=GBTClassifier(maxIter=max_iter, maxDepth=max_depth, stepSize=step, seed=SEED),
                     parallelism=4)


# --- metrics (H7, H16) ---------------------------------------------------------------

def classification_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """H7: accuracy and support-weighted precision, recall and F1, as one
    aggregate over per-class counts (classes with no predictions have
    precision 0, as with zero_division=0)."""
    # one pass over the predictions: cells of (label, prediction), then each
    # cell counts once for its label and once for its prediction
    cells = pred.groupBy(F.col(label).cast("double").alias("y"), F.col(prediction).cast("double").alias("p")).agg(F.count(F.lit(1)).alias("n"))
    right = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)
    sides = F.array(F.struct(F.col("y").alias("y"), F.col("n").alias("support"), right.alias("tp"), F.lit(0).cast("bigint").alias("predicted")),
                    F.struct(F.col("p").alias("y"), F.lit(0).cast("bigint").alias("support"), F.lit(0).cast("bigint").alias("tp"), F.col("n").alias("predicted")))
    per_class = cells.select(F.inline(sides)).groupBy("y").agg(F.sum("support").alias("support"), F.sum("tp").alias("tp"), F.sum("predicted").alias("predicted"))
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("predicted")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * prec * rec, prec + rec), F.lit(0.0))
    n, w = F.sum("support"), F.col("support")
    return per_class.agg(
        F.try_divide(F.sum("tp"), n).alias("accuracy"),
        F.try_divide(F.sum(w * prec), n).alias("precision"),
        F.try_divide(F.sum(w * rec), n).alias("recall"),
        F.try_divide(F.sum(w * f1), n).alias("f1"),
    )


def regression_error(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """MSE and RMSE in one aggregate."""
    se = F.pow(F.col(label) - F.col(prediction), 2)
    return pred.agg(F.avg(se).alias("mse"), F.sqrt(F.avg(se)).alias("rmse"))


# --- searches (H8-H10) -----------------------------------------------------------------

def holdout_search(estimator, grid, evaluator, train: DataFrame, ratio: float = 0.8, parallelism: int = 4):
    """H8: exhaustive search on one hold-out split; returns (model, rows of
    (params, metric)). The winning settings refit the same estimator (the
    reference selected on a forest and refit a different model, quirk Q21)."""
    tvs = TrainValidationSplit(estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator,
                               trainRatio=ratio, seed=SEED, parallelism=parallelism)
    model = tvs.fit(train)
    return model, list(zip(grid, model.validationMetrics))


def cv_search(estimator, grid, evaluator, train: DataFrame, folds: int = 5, parallelism: int = 4, key: str | None = None):
    """K-fold grid search (an empty grid scores one model).

    Boosted regressors on rows with a ``key`` are not fitted one by one: all settings and folds grow together
    (``boosted_search``, with the estimator's shares of rows and features, seed and bins), numbers of rounds are read off
    the longest, and the model returned is the best setting's trees on all rows.
    """
    if key is not None and _boosts_together(estimator, grid, evaluator):
        return _cv_boosted(estimator, grid, train, folds, key)
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds,
                        seed=SEED, parallelism=parallelism)
    model = cv.fit(train)
    return model, list(zip(grid, model.avgMetrics))


def _boosts_together(estimator, grid, evaluator) -> bool:
    """Whether ``boosted_search`` does what the estimator says."""
    plain = isinstance(estimator, GBTRegressor) and isinstance(evaluator, RegressionEvaluator) and evaluator.getMetricName() == "rmse"
    return plain and estimator.getLossType() == "squared" and estimator.getMinInstancesPerNode() == 1 and estimator.getMinInfoGain() == 0 \
        and estimator.getMinWeightFractionPerNode() == 0 and not any(estimator.isDefined(p) for p in (estimator.weightCol, estimator.validationIndicatorCol)) \
        and estimator.getFeatureSubsetStrategy().replace(".", "", 1).isdigit() and {p.name for point in grid for p in point} <= {"maxDepth", "maxIter", "stepSize"}


def _cv_boosted(estimator, grid, train: DataFrame, folds: int, key: str):
    from pyspark.ml.functions import vector_to_array

    x = train.select(F.col(key), F.col(estimator.getLabelCol()).cast("double").alias("label"), vector_to_array(estimator.getFeaturesCol()).alias("x"))
    size = x.agg(F.max(F.size("x"))).first()[0]
    names = [f"x{i}" for i in range(size)]
    rows = x.select(key, "label", *[F.col("x")[i].alias(c) for i, c in enumerate(names)])
    share = estimator.getFeatureSubsetStrategy()  # as MLlib reads it: with a point a share, else a number
    columns = min(size, -int(-float(share) * size // 1) if "." in share else int(share))
    drawn = {"sample": estimator.getSubsamplingRate(), "columns": columns, "seed": estimator.getSeed() % (1 << 30), "bins": estimator.getMaxBins()}
    points = [{p.name: v for p, v in point.items()} for point in grid]
    settings = [(p.get("maxDepth", estimator.getMaxDepth()), p.get("stepSize", estimator.getStepSize()), p.get("maxIter", estimator.getMaxIter())) for p in points]
    depths, rates, sizes = (sorted({s[i] for s in settings}) for i in range(3))
    table = boosted_search(rows, names, "label", key, sizes, rates, depths, folds, **drawn)
    found = {(r["depth"], r["rate"], r["trees"]): r["rmse"] for r in table.collect()}  # at most one row per setting
    metrics = [found.get(s, float("nan")) for s in settings]
    depth, rate, rounds = settings[metrics.index(min(metrics))]
    return trees_.boost(rows, [], names, F.col("label"), rounds, depth, rate, key=key, **drawn), list(zip(grid, metrics))


def search_table(spark, rows, metric_name: str) -> DataFrame:
    """Grid results (bounded by the grid size) as a DataFrame."""
    data = [({p.name: float(v) if isinstance(v, (int, float)) else str(v) for p, v in pm.items()}, float(m))
            for pm, m in rows]
    return spark.createDataFrame([(str(sorted(p.items())), m) for p, m in data], f"params string, {metric_name} double")


# --- grouped regression (H11, H12, C25) ------------------------------------------------------

def group_line_mse(df: DataFrame, groups: list[str], x: str, y: str) -> DataFrame:
    """Training MSE of a one-feature least-squares line per group,
    (Syy - Sxy^2 / Sxx) / n, from regression aggregates (no model fit), and a
    count-weighted total row with keys 'all'. Groups below two rows are left
    out, as in the reference; with a constant x the line is the mean."""
    per = df.groupBy(*groups).agg(
        F.regr_count(y, x).alias("n"),
        F.try_divide(F.regr_syy(y, x) - F.coalesce(F.try_divide(F.pow(F.regr_sxy(y, x), 2), F.regr_sxx(y, x)), F.lit(0.0)),
                     F.regr_count(y, x)).alias("mse"),
    ).filter("n >= 2")
    per = per.select(*[F.col(g).cast("string").alias(g) for g in groups], "n", "mse")
    total = per.agg(*[F.lit("all").alias(g) for g in groups], F.sum("n").alias("n"),
                    F.try_divide(F.sum(F.col("n") * F.col("mse")), F.sum("n")).alias("mse"))
    return per.unionByName(total)


#: Share of a feature's variance that must be left beside the features before it.
DEPENDENT = 1e-10


def group_linear(df: DataFrame, groups: list[str], features: list[str], label: str) -> DataFrame:
    """Least squares on a list of features per group: group columns, n,
    mse (training), intercept and coefficients, all groups in one aggregate.

    The aggregate holds the covariances of the features and the label (summed
    around running means, so large values do not cancel); the normal equations
    are solved by Cholesky in array expressions, forwards for the explained
    part and backwards for the coefficients. A feature that is constant or a
    combination of those before it in a group gets the coefficient 0 and
    changes nothing; so does every feature beyond a group's rows. Rows with a NULL or NaN
    in a feature or the label are left out, and so is a group without rows.
    """
    p = len(features)
    columns = [F.col(c).cast("double") for c in (*features, label)]
    whole = F.lit(True)
    for c in columns:
        whole = whole & c.isNotNull() & ~F.isnan(c)
    cells = [F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.covar_pop(columns[i], columns[j]).alias("c")) for i in range(p + 1) for j in range(i + 1)]
    out = df.filter(whole).groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), F.array(*cells).alias("__cells"), F.array(*[F.avg(c) for c in columns]).alias("__means"))

    def dot(a: str, b: str) -> str:
        return f"aggregate(zip_with({a}, {b}, (a, b) -> a * b), 0D, (t, v) -> t + v)"

    # the factor's lower triangle, row after row; the row of (i, j) begins at i (i + 1) / 2
    before = dot("slice(l, x.i * (x.i + 1) div 2 + 1, x.j)", "slice(l, x.j * (x.j + 1) div 2 + 1, x.j)")
    pivot = "element_at(l, CAST((x.j + 1) * (x.j + 2) div 2 AS INT))"
    own = f"if(x.c - {before} > {DEPENDENT}D * x.c, sqrt(x.c - {before}), 0D)"
    out = out.withColumn("__l", F.expr(f"aggregate(__cells, CAST(array() AS array<double>), (l, x) -> concat(l, array(if(x.i = x.j, {own}, if({pivot} = 0, 0D, (x.c - {before}) / {pivot})))))"))
    last = F.slice("__l", p * (p + 1) // 2 + 1, p)
    explained = F.aggregate(last, F.lit(0.0), lambda t, v: t + v * v)
    out = out.withColumn("mse", F.greatest(F.lit(0.0), F.element_at("__cells", -1)["c"] - explained)).withColumn("__z", last)
    column = f"transform(slice(sequence(0, {p - 1}), j + 2, {p - 1} - j), i -> element_at(__l, CAST(i * (i + 1) div 2 + j + 1 AS INT)))"
    diagonal = "element_at(__l, CAST((j + 1) * (j + 2) div 2 AS INT))"
    back = f"aggregate(sequence({p - 1}, 0, -1), CAST(array() AS array<double>), (w, j) -> concat(array(if({diagonal} = 0, 0D, (element_at(__z, j + 1) - {dot(column, 'w')}) / {diagonal})), w))"
    out = out.withColumn("coefficients", F.expr(back))
    shift = F.expr(dot(f"slice(__means, 1, {p})", "coefficients"))
    return out.select(*groups, "n", "mse", (F.element_at("__means", -1) - shift).alias("intercept"), "coefficients")


def group_linear_mse(df: DataFrame, groups: list[str], features: list[str], label: str) -> DataFrame:
    """N and training MSE per group of at least two rows, and the row-weighted total with keys 'all'."""
    per = group_linear(df, groups, features, label).filter("n >= 2").select(*[F.col(g).cast("string").alias(g) for g in groups], "n", "mse")
    total = per.agg(*[F.lit("all").alias(g) for g in groups], F.sum("n").alias("n"), F.try_divide(F.sum(F.col("n") * F.col("mse")), F.sum("n")).alias("mse"))
    return per.unionByName(total)


def group_linear_predict(df: DataFrame, groups: list[str], features: list[str], label: str, split: str = "split") -> DataFrame:
    """Rows with ``split`` other than 'train' and their ``prediction`` by the line of their group, fitted on the rows with 'train'."""
    lines = group_linear(df.filter(F.col(split) == "train"), groups, features, label)
    lines = lines.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)], "intercept", "coefficients")
    rest = df.filter(F.col(split) != "train")
    same = F.lit(True)
    for i, g in enumerate(groups):
        same = same & rest[g].eqNullSafe(F.col(f"__g{i}"))
    value = F.col("intercept") + sum((F.col("coefficients")[i] * F.col(c).cast("double") for i, c in enumerate(features)), F.lit(0.0))
    return rest.join(lines, same).select(*df.columns, value.alias("prediction"))


def group_models(df: DataFrame, groups: list[str], features: list[str], label: str, estimator_factory,
                 split: str = "split") -> DataFrame:
    """One model per group, fitted on its rows with ``split`` = 'train';
    returns the predictions for its other rows.

    The rows are written once, partitioned by group, so each fit reads its own
    files. Keys are streamed one by one and every group's predictions are
    written when its model is fitted: any number of groups, and neither keys
    nor plans pile up on the driver. A group without training rows is left out.
    """
    from quarry.session import scratch_path

    spark = df.sparkSession
    stored, out = scratch_path(spark, "group-rows"), scratch_path(spark, "group-predictions")
    df.repartition(*groups).write.partitionBy(*groups).parquet(stored)
    rows = spark.read.schema(df.schema).parquet(stored).select(*df.columns)
    written = False
    for key in rows.select(*groups).distinct().orderBy(*groups).toLocalIterator():
        part = rows
        for g in groups:
            part = part.filter(F.col(g).eqNullSafe(F.lit(key[g]).cast(df.schema[g].dataType)))
        part = assemble(part, features)
        train = part.filter(F.col(split) == "train")
        if train.isEmpty():
            continue
        model = estimator_factory().setLabelCol(label).setFeaturesCol("features").fit(train)
        model.transform(part.filter(F.col(split) != "train")).drop("features").write.mode("append").parquet(out)
        written = True
    empty = T.StructType([*df.schema.fields, T.StructField("prediction", T.DoubleType())])
    return spark.read.schema(empty).parquet(out) if written else spark.createDataFrame([], empty)


def group_forests(df: DataFrame, groups: list[str], features: list[str], label: str, key: list[str], trees: int = 200, depth: int = 8,
                  split: str = "split") -> DataFrame:
    """A forest per group, all grown together on the rows with ``split`` = 'train'
    (a number of jobs that depends on ``depth`` only); returns the other rows of
    groups with training rows with their ``prediction``."""
    forest = trees_.grow(df.filter(F.col(split) == "train"), groups, features, [F.col(label)], key, trees, depth)
    return trees_.predict(forest, df.filter(F.col(split) != "train"))


def group_boosted(df: DataFrame, groups: list[str], features: list[str], label: str, rounds: int = 50, depth: int = 5, rate: float = 0.1,
                  split: str = "split") -> DataFrame:
    """Boosted trees per group, all groups grown together on the rows with ``split`` = 'train' (a number of jobs
    that depends on ``rounds`` and ``depth`` only); returns the other rows of groups with training rows with their
    ``prediction``."""
    model = trees_.boost(df.filter(F.col(split) == "train"), groups, features, F.col(label), rounds, depth, rate)
    return trees_.predict(model, df.filter(F.col(split) != "train"))


def boosted_search(df: DataFrame, features: list[str], label: str, key: str, sizes: list[int], rates: list[float], depths: list[int],
                   folds: int = 5, sample: float = 1.0, columns: int | None = None, seed: int = SEED, bins: int = 32) -> DataFrame:
    """H9: (depth, rate, trees, n, rmse) of every setting, ``rmse`` the mean over the folds. All settings and folds grow
    in one run, as groups of ``boost`` (``sample`` and ``columns`` as there); numbers of trees are read off the longest. A
    setting's rows are a copy of the table, as what its trees leave over is its own. Where the table fits a task, a
    setting and fold is grown and scored in one."""
    grid = F.explode(F.array(*[F.struct(F.lit(float(r)).alias("rate"), F.lit(d).alias("limit")) for r in rates for d in depths]))
    rows = df.select(F.col(key).alias("key"), F.col(label).cast("double").alias("label"), F.array(*[F.col(c).cast("double") for c in features]).alias("x"))
    names = [f"x{i}" for i in range(len(features))]
    rows = rows.select("key", "label", *[F.col("x")[i].alias(c) for i, c in enumerate(names)], _fold("key", folds).alias("fold"))
    others = F.filter(F.sequence(F.lit(0), F.lit(folds - 1)), lambda f: f != F.col("fold"))
    drawn = {"sample": sample, "columns": columns, "seed": seed}
    if intask.fits(rows.count(), len(names), 1):
        table = trees_.boosted_scores(rows, rows.withColumn("fold", F.explode(others)), "fold", names, "label", "key", sizes, grid, len(rates) * len(depths) * folds, bins=bins, **drawn)
    else:
        rows = rows.withColumn("s", grid).select("*", "s.rate", "s.limit").drop("s")
        model = trees_.boost(rows.withColumn("fold", F.explode(others)), ["fold", "rate", "limit"], names, F.col("label"), max(sizes), max(depths), "rate", "limit", bins=bins, key="key", **drawn)
        table = trees_.scores(model, rows, "label", sizes, [max(depths)])
    return table.groupBy(F.col("limit").alias("depth"), "rate", "trees").agg(F.sum("n").alias("n"), F.avg(F.sqrt("mse")).alias("rmse"))


def forest_search(train: DataFrame, held: DataFrame, features: list[str], label: str, classes: list, key: list[str],
                  sizes: list[int], depths: list[int]) -> DataFrame:
    """H8: (trees, depth, n, accuracy) of every setting on the hold-out, read off one forest of the largest setting
    (square root of the features tried at a node)."""
    return trees_.search(train, held, features, label, classes, key, sizes, depths, columns=max(1, int(len(features) ** 0.5)))


def _fold(key: str, folds: int):
    return F.pmod(F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long"), F.lit(folds)).cast("int")


def forest_cv(df: DataFrame, features: list[str], label: str, key: str, trees: int, depth: int, folds: int = 5) -> DataFrame:
    """(fold, n, mse) of a forest per fold, grown together on the rows of the other folds."""
    held = df.withColumn("fold", _fold(key, folds))
    others = F.filter(F.sequence(F.lit(0), F.lit(folds - 1)), lambda f: f != F.col("fold"))
    train = held.withColumn("fold", F.explode(others))
    forest = trees_.grow(train, ["fold"], features, [F.col(label)], [key], trees, depth)
    return trees_.scores(forest, held, label, [trees], [depth]).select("fold", "n", "mse")


def reg_boosted(max_iter: int = 50, max_depth: int = 4, step: float = 0.1, subsample: float = 0.8, columns: str = "0.8") -> GBTRegressor:
    """Rows and columns are subsampled for every tree (``columns``: share of features tried at a split)."""
    return GBTRegressor(maxIter=max_iter, maxDepth=max_depth, stepSize=step, subsamplingRate=subsample, featureSubsetStrategy=columns, seed=SEED)


def reg_forest(num_trees: int = 100, max_depth: int = 8) -> RandomForestRegressor:
    """H14."""
    return RandomForestRegressor(numTrees=num_trees, maxDepth=max_depth, seed=SEED)


def feature_importance(spark, model, names: list[str], min_importance: float = 0.001) -> DataFrame:
    """Importances sorted descending, those above ``min_importance``
    (a vector with one entry per feature)."""
    vals = model.featureImportances.toArray().tolist()
    df = spark.createDataFrame(list(zip(names, [float(v) for v in vals])), "feature string, importance double")
    return df.filter(F.col("importance") > min_importance).orderBy(F.col("importance").desc(), "feature")


def evaluator_f1() -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(metricName="f1")


def evaluator_accuracy() -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(metricName="accuracy")


def evaluator_rmse(label: str = "label") -> RegressionEvaluator:
    return RegressionEvaluator(metricName="rmse", labelCol=label)


def evaluator_mse(label: str = "label") -> RegressionEvaluator:
    return RegressionEvaluator(metricName="mse", labelCol=label)

