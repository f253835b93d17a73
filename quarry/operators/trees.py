"""Forests of many groups grown together, and searches that score many settings of one forest.

A forest per group is not a loop of fits: all trees of all groups grow level by
level. A level is one histogram aggregate keyed by (group, tree, node, feature,
bin) and one window over the bins, so a fit takes ``depth`` + 2 jobs whatever
the number of groups or trees. Rows are never copied per tree on disk: a row
meets its trees in flight, finds its nodes by joins with the (small, written)
split tables of the levels above, and is added up before anything is shuffled;
a group with most of the rows therefore costs no more than its histograms.

Labels are vectors of outputs: one number for regression, one indicator per
class for classification, where the reduction of the outputs' variance is the
reduction of the Gini impurity. Trees are bagged with Poisson(1) counts drawn
from a hash of the row's key and the tree's number, so a forest of 50 trees is
the first 50 of a forest of 200, and a tree cut at depth 4 is the tree grown to
depth 4: ``scores`` reads every (trees, depth) setting off one forest.

Boosted trees (``boost``) of all groups grow together too, a round after another:
each round's trees fit what the earlier ones left of the label. The state is one
row per training row with its bins and what is left; it is rewritten each round.
Rate and depth may be columns of the groups, so every setting of a search is a
group of one run, and ``scores`` reads all numbers of rounds off it. Groups that fit
a task are boosted whole in it (``intask``), the same trees without a job for each level.

Rows with a NULL or NaN feature take no part in a fit and get no prediction.
Equally good splits (to nine digits of the node's variance) go to the first
feature, then the lowest bin. A group whose rows cannot be split predicts its
(bagged) mean.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import gcd

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators import intask
from quarry.operators.intask import LEAST_SHARE, POISSON
from quarry.session import remove_path, written

cloudpickle.register_pickle_by_value(intask)  # executors need not find this package


def _usable(features: list[str]) -> Column:
    out = F.lit(True)
    for c in features:
        out = out & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return out


def _same(left: DataFrame, names: list[str], right: str) -> Column:
    """Null-safe equality of ``names`` with the columns prefixed ``right``."""
    out = F.lit(True)
    for c in names:
        out = out & left[c].eqNullSafe(F.col(f"{right}{c}"))
    return out


def _prefixed(df: DataFrame, names: list[str], prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") if c in names else F.col(c) for c in df.columns])


def bin_edges(rows: DataFrame, groups: list[str], features: list[str], outputs: list[Column], bins: int = 32) -> DataFrame:
    """Per group: ``__edges`` (for every feature at most bins - 1 rising quantiles) and ``__means`` of the outputs."""
    at = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    quantiles = F.array(*[F.array_distinct(F.percentile_approx(F.col(c).cast("double"), at, 10_000)) for c in features])
    return rows.groupBy(*groups).agg(quantiles.alias("__edges"), F.array(*[F.avg(o) for o in outputs]).alias("__means"))


@dataclass
class Forest:
    """``tables``: edges and means per group; ``roots``: (group, tree, value); ``levels``: the splits of each depth."""

    groups: list[str]
    features: list[str]
    trees: int
    tables: DataFrame
    roots: DataFrame
    levels: list[DataFrame]
    #: of boosted trees: a number, or the name of a group column
    rate: float | str | None = None

    def total(self, value: Column, trees: Column) -> Column:
        """What the summed ``value`` of so many trees says: its mean, or for boosted trees the sum times the rate."""
        if self.rate is None:
            return value / trees
        return value * (F.col(self.rate) if isinstance(self.rate, str) else F.lit(self.rate))

    def binned(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``__bins`` (a byte per feature) and ``__means`` of their group; rows of unknown groups are left out."""
        named = _prefixed(self.tables, self.groups, "__g_")
        joined = rows.join(named, _same(rows, self.groups, "__g_"))
        def place(i: int, value: Column) -> Column:
            return F.size(F.filter(F.col("__edges")[i], lambda e: e < value)).cast("tinyint")

        return joined.withColumn("__bins", F.array(*[place(i, F.col(c).cast("double")) for i, c in enumerate(self.features)])).drop("__edges", *[f"__g_{c}" for c in self.groups])

    def descend(self, met: DataFrame, levels: int, values: bool, kept: tuple[int, ...] = (), outer: bool = False) -> DataFrame:
        """(row, tree) pairs walked down ``levels`` levels: ``__node``, with ``values`` also ``__value`` there and ``__value{d}`` at the depths ``kept``.
        Pairs whose tree has no root are left out, with ``outer`` they stay without a value."""
        if values:
            roots = _prefixed(self.roots, self.groups, "__r_").withColumnRenamed("tree", "__r_tree")
            met = met.join(roots, _same(met, self.groups, "__r_") & (met["tree"] == F.col("__r_tree")), "left" if outer else "inner").drop("__r_tree", *[f"__r_{c}" for c in self.groups])
        met = met.withColumn("__node", F.lit(1))
        for d in range(levels + 1):
            if values and d in kept:
                met = met.withColumn(f"__value{d}", F.col("__value"))
            if d == levels:
                return met
            if d >= len(self.levels):
                continue
            splits = _prefixed(self.levels[d], self.groups, "__s_").withColumnsRenamed({"tree": "__s_tree", "node": "__s_node"})
            if not values:
                splits = splits.drop("left", "right")
            on = _same(met, self.groups, "__s_") & (met["tree"] == F.col("__s_tree")) & (met["__node"] == F.col("__s_node"))
            met = met.join(splits, on, "left").withColumn("__right", F.col("__bins")[F.col("feature")] > F.col("bin"))
            moved = {"__node": F.when(F.col("feature").isNull(), F.col("__node")).otherwise(2 * F.col("__node") + F.col("__right").cast("int"))}
            if values:
                moved["__value"] = F.when(F.col("feature").isNull(), F.col("__value")).when(F.col("__right"), F.col("right")).otherwise(F.col("left"))
            met = met.withColumns(moved).drop("feature", "bin", "left", "right", "__right", "__s_tree", "__s_node", *[f"__s_{c}" for c in self.groups])
        return met

    def outputs(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``__out``, the mean (boosted: the sum) over all trees of every output (NULL for rows that cannot be scored)."""
        numbered = rows.withColumn("__row", F.monotonically_increasing_id())
        met = self.binned(numbered.filter(_usable(self.features))).withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(self.trees - 1))))
        walked = self.descend(met, len(self.levels), True)
        # the pairs of a row sit side by side, so the sums leave the task once per row
        long = walked.select(*rows.columns, "__row", "__means", F.posexplode("__value").alias("__k", "__v"))
        sums = long.groupBy(*rows.columns, "__row", "__means", "__k").agg(self.total(F.sum("__v"), F.count("__v")).alias("__v"))
        out = sums.groupBy(*rows.columns, "__row", "__means").agg(F.transform(F.array_sort(F.collect_list(F.struct("__k", "__v"))), lambda x: x["__v"]).alias("__o"))
        scored = out.withColumn("__out", F.zip_with("__o", "__means", lambda o, m: o + m)).select(*rows.columns, "__out")
        unscored = rows.filter(~_usable(self.features)).withColumn("__out", F.lit(None).cast("array<double>"))
        return scored.unionByName(unscored)


def _unit(key: list[str], seed: int) -> Column:
    """A number from 0 to 1 drawn by the row's key and the tree's number."""
    return F.pmod(F.xxhash64(*key, "tree", F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)


def _pairs(rows: DataFrame, trees: int, key: list[str], seed: int) -> DataFrame:
    """Rows times the trees that drew them, with the number of draws as ``__w``."""
    met = rows.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    u = _unit(key, seed)
    draws = sum(((u >= p).cast("int") for p in POISSON), F.lit(0))
    return met.withColumn("__w", draws).filter("__w > 0")


def _tried(features: int, columns: int | None, seed: int) -> Column:
    """Indices of the features tried at a node: all, or ``columns`` of them by a step drawn from the node's hash."""
    if not columns or columns >= features:
        return F.sequence(F.lit(0), F.lit(features - 1))
    steps = [s for s in range(1, features) if gcd(s, features) == 1]
    draw = F.xxhash64("tree", "__node", F.lit(seed + 1))
    step = F.element_at(F.array(*[F.lit(s) for s in steps]), (F.pmod(draw, F.lit(len(steps))) + 1).cast("int"))
    start = F.pmod(F.shiftrightunsigned(draw, 20), F.lit(features))
    return F.transform(F.sequence(F.lit(0), F.lit(columns - 1)), lambda i: F.pmod(start + i * step, F.lit(features)).cast("int"))


def _best_splits(met: DataFrame, groups: list[str], features: int, outputs: int, columns: int | None, seed: int, least: int, ridge: float = 0.0) -> DataFrame:
    """The best split of every node: group, tree, node, feature, bin, left and right values. ``ridge`` is added to the rows of a node where its value is taken."""
    tried = met.withColumn("__f", F.explode(_tried(features, columns, seed)))
    # tree, node, feature and bin in one number: one key to hash and to sort by
    cell = F.shiftleft(F.col("tree").cast("long"), 40).bitwiseOR(F.shiftleft(F.col("__node").cast("long"), 20)).bitwiseOR(F.shiftleft(F.col("__f").cast("long"), 8))
    tried = tried.withColumn("__cell", cell.bitwiseOR(F.col("__bins")[F.col("__f")].cast("long")))
    w = F.col("__w")
    cells = tried.groupBy(*groups, "__cell").agg(F.sum(w).alias("__n"), F.sum(w * F.col("__square")).alias("__q"),
                                                 *[F.sum(w * F.col("__y")[k]).alias(f"__s{k}") for k in range(outputs)])
    cells = cells.withColumn("__line", F.shiftright("__cell", 8))
    upto = Window.partitionBy(*groups, "__line").orderBy("__cell").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*groups, "__line")
    names = ["__n", "__q", *[f"__s{k}" for k in range(outputs)]]
    cells = cells.withColumns({f"{c}_l": F.sum(c).over(upto) for c in names if c != "__q"} | {f"{c}_t": F.sum(c).over(whole) for c in names})
    n, left, right = F.col("__n_t"), F.col("__n_l"), F.col("__n_t") - F.col("__n_l")
    cells = cells.filter((left >= least) & (right >= least))
    n, left, right = n + ridge, left + ridge, right + ridge
    total = sum((F.col(f"__s{k}_t") * F.col(f"__s{k}_t") for k in range(outputs)), F.lit(0.0)) / n
    rest = [F.col(f"__s{k}_t") - F.col(f"__s{k}_l") for k in range(outputs)]
    parts = sum((F.col(f"__s{k}_l") * F.col(f"__s{k}_l") / left + rest[k] * rest[k] / right for k in range(outputs)), F.lit(0.0))
    share = F.round(F.try_divide(parts - total, F.col("__q_t") - total), 9)
    values = [F.array(*[F.col(f"__s{k}_l") / left for k in range(outputs)]).alias("left"), F.array(*[r / right for r in rest]).alias("right")]
    spread = F.col("__q_t") - total > LEAST_SHARE * F.col("__q_t")  # else all outputs are equal but for rounding
    place = F.col("__cell").bitwiseAND(F.lit((1 << 20) - 1))
    cells = cells.filter(spread & (share > LEAST_SHARE)).select(*groups, F.shiftright("__cell", 20).alias("__at"), F.struct(share.alias("share"), (-place).alias("place"), *values).alias("__split"))
    best = cells.groupBy(*groups, "__at").agg(F.max("__split").alias("__split")).withColumn("__place", -F.col("__split.place"))
    return best.select(*groups, F.shiftright("__at", 20).cast("int").alias("tree"), F.col("__at").bitwiseAND(F.lit((1 << 20) - 1)).cast("int").alias("node"),
                       F.shiftright("__place", 8).cast("int").alias("feature"), F.col("__place").bitwiseAND(F.lit(255)).cast("int").alias("bin"),
                       F.col("__split.left").alias("left"), F.col("__split.right").alias("right"))


def grow(rows: DataFrame, groups: list[str], features: list[str], outputs: list[Column], key: list[str], trees: int = 200, depth: int = 8,
         bins: int = 32, columns: int | None = None, least: int = 1, seed: int = 42, bagged: bool = True) -> Forest:
    """A forest per group in ``depth`` + 2 jobs. ``key`` names the columns that draw a row's bags; ``columns``: features tried at a node (all)."""
    if depth > 19 or bins > 128 or len(features) > 4096:
        raise ValueError("a tree has at most 19 levels, 4096 features and 128 bins")
    known = F.lit(True)
    for o in outputs:
        known = known & o.isNotNull()
    rows = rows.filter(_usable(features) & known)
    tables, _ = written(bin_edges(rows, groups, features, outputs, bins), "forest-edges")
    forest = Forest(groups, features, trees, tables, None, [])
    centred = F.transform(F.arrays_zip(F.array(*[o.cast("double") for o in outputs]).alias("o"), F.col("__means").alias("m")), lambda z: z["o"] - z["m"])
    base = forest.binned(rows).withColumn("__y", centred).withColumn("__square", F.aggregate("__y", F.lit(0.0), lambda a, y: a + y * y))
    base = base.select(*groups, *[F.col(k).alias(f"__k_{k}") for k in key], "__bins", "__y", "__square")
    base, _ = written(base, "forest-rows")
    keys = [f"__k_{k}" for k in key]
    met = _pairs(base, trees, keys, seed) if bagged else base.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).withColumn("__w", F.lit(1))
    mean = [(F.sum(F.col("__w") * F.col("__y")[k]) / F.sum("__w")) for k in range(len(outputs))]
    forest.roots, _ = written(met.groupBy(*groups, "tree").agg(F.array(*mean).alias("__value")), "forest-roots")
    for level in range(depth):
        here = forest.descend(met, level, False).filter(F.col("__node") >= 1 << level)
        splits, _ = written(_best_splits(here, groups, len(features), len(outputs), columns, seed, least), "forest-splits")
        if splits.isEmpty():
            break
        forest.levels.append(splits)
    return forest


def dealt(rows: DataFrame, keys: list[str], parts: int) -> DataFrame:
    """``rows`` by ``keys``, in so many more partitions than ``parts`` keys that few of these meet in one."""
    return rows.repartition(max(1, min(4 * parts, 2000)), *keys)


def _boosted_in_tasks(start: DataFrame, groups: list[str], features: int, count: int, rounds: int, depth: int, rate: float | str, limit: str | None,
                      ridge: float, least: int, sample: float, columns: int | None, seed: int) -> DataFrame:
    """Roots (level -1, value in ``left``) and splits of all rounds, each group's grown in one task."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = start.select(*groups, *[F.lit(0).alias(c) for c in ("level", "tree", "node", "feature", "bin")], F.col("__y").alias("left"), F.col("__y").alias("right")).schema
    names = to_arrow_schema(schema)

    def run(table: pa.Table) -> pa.Table:
        own = table.select(groups).slice(0, 1)
        value = lambda c: own.column(c)[0].as_py() if isinstance(c, str) else c
        keep: list = []
        for _ in intask.boosted(intask.matrix(table["__bins"], features), table["__h"].to_numpy(), intask.matrix(table["__y"], 1)[:, 0], rounds,
                                depth if limit is None else min(depth, value(limit)), value(rate), ridge, least, sample, columns, seed, keep=keep):
            pass
        out = [(-1, tree, 1, 0, 0, [root], [root]) for tree, root, _ in keep]
        out += [(level, tree, *map(int, row[:3]), row[3].tolist(), row[4].tolist()) for tree, _, splits in keep for level, found in enumerate(splits) for row in zip(*found)]
        repeated = [own.column(g).take(pa.array([0] * len(out), "int64")).cast(names.field(g).type) for g in groups]
        return pa.table([*repeated, *[pa.array(c, names.field(len(groups) + i).type) for i, c in enumerate(zip(*out))]], schema=names)

    return dealt(start.withColumn("__block", F.lit(0)), [*groups, "__block"], count).groupBy(*groups, "__block").applyInArrow(run, schema)


def boost(rows: DataFrame, groups: list[str], features: list[str], label: Column, rounds: int = 50, depth: int = 5, rate: float | str = 0.1,
          limit: str | None = None, ridge: float = 1.0, bins: int = 32, least: int = 1, key: str | None = None, sample: float = 1.0,
          columns: int | None = None, seed: int = 42) -> Forest:
    """Boosted regression trees per group (squared error, leaves shrunk by ``ridge``), one per round.

    ``rate``: a number or a group column; ``limit``: a group column with the depth of the group's own trees, at most
    ``depth``. A round's tree grows on a share ``sample`` of the rows, drawn from a hash of ``key`` and the round, and tries
    ``columns`` features at a node (all). Jobs depend on ``rounds`` and ``depth`` alone, and not even on these where every
    group fits a task. Rows with a NULL label take no part.
    """
    if depth > 19 or bins > 128 or len(features) > 4096:
        raise ValueError("a tree has at most 19 levels, 4096 features and 128 bins")
    if any(isinstance(c, str) and c not in groups for c in (rate, limit)):
        raise ValueError("rate and limit are columns of the groups")
    if sample < 1 and key is None:
        raise ValueError("rows are drawn by their key")
    spark, rows = rows.sparkSession, rows.filter(_usable(features) & label.isNotNull())
    tables, _ = written(bin_edges(rows, groups, features, [label], bins), "boost-edges")
    forest = Forest(groups, features, rounds, tables, None, [], rate)
    drawn_by = [F.col(key).alias("__k"), F.xxhash64(key).alias("__h")] if key else [F.lit(0).alias("__k"), F.lit(0).cast("long").alias("__h")]
    start = forest.binned(rows).select(*groups, "__bins", F.array(label.cast("double") - F.col("__means")[0]).alias("__y"), F.lit(0).alias("tree"), *drawn_by)
    state, path = written(start, "boost-rows")
    most, count = state.groupBy(*groups).count().agg(F.coalesce(F.max("count"), F.lit(0)), F.count(F.lit(1))).first()
    if intask.fits(most, len(features), 1) and count <= intask.MOST_GROUPS:
        found, _ = written(_boosted_in_tasks(state, groups, len(features), count, rounds, depth, rate, limit, ridge, least, sample, columns, seed), "boost-trees")
        remove_path(spark, path)
        forest.roots = found.filter("level = -1").select(*groups, "tree", F.col("left").alias("__value"))
        forest.levels = [found.filter(F.col("level") == d).drop("level") for d in range(depth)]
        return forest
    roots, levels, kind = [], [[] for _ in range(depth)], {}

    def keep(df: DataFrame, paths: list[str], name: str) -> DataFrame:
        out, at = written(df, f"boost-{name}")
        paths.append(at)
        kind[name] = out.schema
        return out

    # the round's number is a column, so that all rounds run the same compiled code
    for _ in range(rounds):
        met = state.withColumns({"__w": F.lit(1), "__square": F.col("__y")[0] * F.col("__y")[0]})
        if sample < 1:
            met = met.filter(_unit(["__k"], seed) < sample)
        mean = F.array(F.sum(F.col("__y")[0]) / (F.count(F.lit(1)) + ridge))
        one = Forest(groups, features, 1, tables, keep(met.groupBy(*groups, "tree").agg(mean.alias("__value")), roots, "roots"), [])
        for level in range(depth):
            here = one.descend(met, level, False).filter(F.col("__node") >= 1 << level)
            if limit is not None:
                here = here.filter(F.col(limit) > level)
            splits = keep(_best_splits(here, groups, len(features), 1, columns, seed, least, ridge), levels[level], "splits")
            if splits.isEmpty():
                break
            one.levels.append(splits)
        left = F.array(F.col("__y")[0] - forest.total(F.col("__value")[0], F.lit(1)))
        old = path
        # a group of which a round drew no row has no tree in it
        moved = one.descend(state, len(one.levels), True, outer=True).withColumn("__value", F.coalesce("__value", F.array(F.lit(0.0))))
        state, path = written(moved.select(*groups, "__bins", left.alias("__y"), (F.col("tree") + 1).alias("tree"), "__k", "__h"), "boost-rows")
        remove_path(spark, old)
    remove_path(spark, path)

    def together(paths: list[str], name: str) -> DataFrame:
        """The rounds' tables as one."""
        out, _ = written(spark.read.schema(kind[name]).parquet(*paths), f"boost-{name}")
        for at in paths:
            remove_path(spark, at)
        return out

    forest.roots = together(roots, "roots")
    forest.levels = [together(paths, "splits") for paths in levels if paths]
    return forest


def boosted_scores(rows: DataFrame, seen: DataFrame, fold: str, features: list[str], label: str, key: str, sizes: list[int], settings: Column, count: int,
                   ridge: float = 1.0, bins: int = 32, least: int = 1, sample: float = 1.0, columns: int | None = None, seed: int = 42) -> DataFrame:
    """(fold, rate, limit, trees, n, mse) of boosted trees for each fold and each of ``settings`` (structs of rate and limit, exploded): grown on
    ``seen``, the training rows of each fold, and scored on the fold's own ``rows``, each of the ``count`` runs whole in one task."""
    import numpy as np
    import pyarrow as pa

    usable = _usable(features) & F.col(label).isNotNull()
    seen, rows = seen.filter(usable), rows.filter(usable)
    tables, _ = written(bin_edges(seen, [fold], features, [F.col(label)], bins), "boost-edges")
    both = seen.withColumn("held", F.lit(False)).unionByName(rows.withColumn("held", F.lit(True)))
    binned = Forest([fold], features, max(sizes), tables, None, []).binned(both)
    base, _ = written(binned.select(fold, "held", "__bins", (F.col(label).cast("double") - F.col("__means")[0]).alias("__y"), F.xxhash64(key).alias("__h")), "boost-rows")
    width, wanted, kind = len(features), sorted(sizes), dict(base.dtypes)[fold]

    def run(table: pa.Table) -> pa.Table:
        held, all_bins, y = table["held"].to_numpy(), intask.matrix(table["__bins"], width), table["__y"].to_numpy()
        one, squares = table.slice(0, 1), []
        if held.any() and not held.all():
            grown = intask.boosted(all_bins[~held], table["__h"].to_numpy()[~held], y[~held], wanted[-1], one["limit"][0].as_py(), one["rate"][0].as_py(),
                                   ridge, least, sample, columns, seed, all_bins[held])
            squares = [(t + 1, float(np.square(said - y[held]).mean())) for t, said in enumerate(grown) if t + 1 in wanted]
        same = [one[c].take(pa.array([0] * len(squares), "int64")) for c in (fold, "rate", "limit")]
        return pa.table([*same, pa.array([t for t, _ in squares], "int32"), pa.array([int(held.sum())] * len(squares), "int64"), pa.array([m for _, m in squares], "float64")],
                        names=[fold, "rate", "limit", "trees", "n", "mse"])

    met = base.withColumn("s", settings).select("*", "s.rate", "s.limit").drop("s")
    keys = [fold, "rate", "limit"]
    return dealt(met, keys, count).groupBy(*keys).applyInArrow(run, f"`{fold}` {kind}, rate double, limit int, trees int, n bigint, mse double")


def class_outputs(label: str, classes: list) -> list[Column]:
    """Indicators of the classes of ``label``."""
    return [(F.col(label) == F.lit(c)).cast("double") for c in classes]


def predict(forest: Forest, rows: DataFrame, classes: list | None = None) -> DataFrame:
    """``rows`` with ``prediction``: the first output, or the class with the largest (the first of equals)."""
    scored = forest.outputs(rows)
    best = F.col("__out")[0]
    if classes is not None:
        best = F.element_at(F.array(*[F.lit(float(c)) for c in classes]), F.array_position("__out", F.array_max("__out")).cast("int"))
    return scored.withColumn("prediction", best).drop("__out")


def scores(forest: Forest, rows: DataFrame, label: str, sizes: list[int], depths: list[int], classes: list | None = None) -> DataFrame:
    """group columns, trees, depth, n and accuracy (with ``classes``) or mse for every setting, read off one forest.

    The values of a row are added up per depth and per stretch of trees between
    two sizes; running sums over the stretches give every size.
    """
    cuts = sorted(sizes)
    numbered = rows.withColumn("__row", F.monotonically_increasing_id()).filter(_usable(forest.features) & F.col(label).isNotNull())
    met = forest.binned(numbered).withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(cuts[-1] - 1))))
    walked = forest.descend(met, max(depths), True, tuple(depths))
    stretch = sum(((F.col("tree") >= c).cast("int") for c in cuts[:-1]), F.lit(0))
    by_depth = F.explode(F.array(*[F.struct(F.lit(d).alias("depth"), F.col(f"__value{d}").alias("value")) for d in depths]))
    width = len(classes) if classes is not None else 1
    long = walked.select(*forest.groups, "__row", F.col(label).alias("__label"), "__means", stretch.alias("__stretch"), by_depth.alias("__at"))
    keys = [*forest.groups, "__row", "__label", "__means", F.col("__at.depth").alias("depth")]
    part = long.groupBy(*keys, "__stretch").agg(*[F.sum(F.col("__at.value")[k]).alias(f"__o{k}") for k in range(width)])
    means = [F.col("__means")[k] for k in range(width)]
    return _measured(part, forest.groups, cuts, lambda k, trees: forest.total(k, trees), means, classes)


def _measured(part: DataFrame, groups: list[str], cuts: list[int], total, means: list[Column], classes: list | None) -> DataFrame:
    """group columns, trees, depth, n and measure from the sums ``__o{k}`` of (row, depth, stretch)."""
    width = len(means)
    run = Window.partitionBy(*groups, "__row", "depth").orderBy("__stretch").rowsBetween(Window.unboundedPreceding, 0)
    size = F.element_at(F.array(*[F.lit(c) for c in cuts]), F.col("__stretch") + 1)
    summed = part.withColumns({f"__o{k}": F.sum(f"__o{k}").over(run) for k in range(width)}).withColumn("trees", size)
    out = F.array(*[total(F.col(f"__o{k}"), F.col("trees")) + means[k] for k in range(width)])
    if classes is None:
        measure = F.avg(F.pow(out[0] - F.col("__label"), F.lit(2))).alias("mse")
    else:
        named = F.element_at(F.array(*[F.lit(float(c)) for c in classes]), F.array_position(F.col("__out"), F.array_max("__out")).cast("int"))
        measure = F.avg((named == F.col("__label")).cast("double")).alias("accuracy")
    return summed.withColumn("__out", out).groupBy(*groups, "trees", "depth").agg(F.count(F.lit(1)).alias("n"), measure)


#: Trees that one task of ``search`` grows.
PIECE = 13


def search(train: DataFrame, held: DataFrame, features: list[str], label: str, classes: list, key: list[str], sizes: list[int], depths: list[int],
           columns: int | None = None, bins: int = 32, least: int = 1, seed: int = 42) -> DataFrame:
    """``scores`` on ``held`` of the largest forest grown on ``train``: trees, depth, n and accuracy of every setting.

    Where the rows fit a task, the trees are dealt to tasks that have all rows: each grows its trees and walks the held rows
    down at once, so neither splits nor pairs of rows and trees are written, and sums per row, depth and stretch are all
    that comes back. Larger tables are grown and walked level by level."""
    import numpy as np
    import pyarrow as pa

    outputs, usable = class_outputs(label, classes), _usable(features) & F.col(label).isNotNull()
    train, held = train.filter(usable), held.filter(usable)
    width, cuts, wanted, many = len(features), sorted(sizes), sorted(depths), len(classes)
    if not intask.fits(train.count() + held.count(), width, many):
        return scores(grow(train, [], features, outputs, key, cuts[-1], wanted[-1], bins, columns, least, seed), held, label, sizes, depths, classes)
    tables, _ = written(bin_edges(train, [], features, outputs, bins), "forest-edges")
    means = [m or 0.0 for m in tables.first()["__means"]]  # a number per class
    taken = [*features, F.col(label).cast("double").alias("__label")]
    both = train.select(*taken, F.lit(False).alias("__held"), F.xxhash64(*key).alias("__h")).unionByName(
        held.select(*taken, F.lit(True).alias("__held"), F.monotonically_increasing_id().alias("__h")))
    base, path = written(Forest([], features, cuts[-1], tables, None, []).binned(both).select("__bins", "__label", "__held", "__h"), "forest-rows")
    pieces = [(first, min(first + PIECE, end), stretch) for stretch, (begin, end) in enumerate(zip([0, *cuts], cuts)) for first in range(begin, end, PIECE)]

    def run(table: pa.Table) -> pa.Table:
        out, all_bins, names, keys = table["__held"].to_numpy(), intask.matrix(table["__bins"], width), table["__label"].to_numpy(), table["__h"].to_numpy()
        first, end, stretch = pieces[table["__piece"][0].as_py()]
        seen, keys, rows, names, walked = all_bins[~out], keys[~out], keys[out], names, all_bins[out]
        codes, mean = np.searchsorted(np.array(classes, np.float64), names[~out]), np.array(means)
        sums = np.tile(mean * (end - first), (len(wanted), len(rows), 1))
        for tree in range(first, end):
            w = intask.bag(keys, tree, seed)
            drawn = np.flatnonzero(w)
            if len(drawn):
                for d, value in enumerate(intask.grown(seen[drawn], intask.Outputs(w[drawn].astype(np.float64), codes[drawn], mean), walked, tree, wanted[-1], columns, seed, least)):
                    if d in wanted:
                        sums[wanted.index(d)] += value
        n = 0 if out.all() else len(rows) * len(wanted)
        at = [np.tile(rows, len(wanted)), np.tile(names[out], len(wanted)), np.repeat(np.array(wanted, np.int32), len(rows)), np.full(len(rows) * len(wanted), stretch, np.int32)]
        flat = sums.reshape(-1, many)
        return pa.table([*[pa.array(c[:n]) for c in at], *[pa.array(np.ascontiguousarray(flat[:n, k])) for k in range(many)]],
                        names=["__row", "__label", "depth", "__stretch", *[f"__o{k}" for k in range(many)]])

    met = base.withColumn("__piece", F.explode(F.sequence(F.lit(0), F.lit(len(pieces) - 1))))
    kind = "__row bigint, __label double, depth int, __stretch int, " + ", ".join(f"__o{k} double" for k in range(many))
    long = dealt(met, ["__piece"], len(pieces)).groupBy("__piece").applyInArrow(run, kind)
    part = long.groupBy("__row", "__label", "depth", "__stretch").agg(*[F.sum(f"__o{k}").alias(f"__o{k}") for k in range(many)])
    # the sums hold the means of their trees
    table, _ = written(_measured(part, [], cuts, lambda value, trees: value / trees, [F.lit(0.0)] * many, classes), "forest-scores")
    remove_path(train.sparkSession, path)
    return table
