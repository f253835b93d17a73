"""Statistics on tables.

Moments, shares and intervals are single grouped aggregates (partial +
final). Quantiles are Spark's exact ``percentile`` (value counts per group)
or, on request, positions in one distributed order or ``percentile_approx``
(bounded sketch). Tail probabilities use
a pandas UDF on the aggregated rows only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import vocab as V
from quarry.functions.tails import normal_p_udf, t_p_udf
from quarry.operators.ordered import group_quantiles, rolling

def outcome_summary(df: DataFrame, group: str, x: str) -> DataFrame:
    """Mean, population sd and standard error (sd / sqrt(n)) per group."""
    return df.groupBy(group).agg(
        F.count(x).alias("n"),
        F.avg(x).alias("mean"),
        F.stddev_pop(x).alias("sd"),
        F.try_divide(F.stddev_pop(x), F.sqrt(F.count(x))).alias("se"),
    )


def positive_share(df: DataFrame, group: str, x: str) -> DataFrame:
    """Share of rows with x > 0 per group."""
    return df.groupBy(group).agg(F.avg(F.when(F.col(x) > 0, 1).otherwise(0)).alias("positive_share"))


def density_histogram(df: DataFrame, x: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between min and max (last bin closed), with count
    and density count / (n * width). One bin for each of ``bins``, empty ones
    too; without values no bins.

    The extremes and n are one scalar subquery, so no job runs while the plan
    is built; the bins' counts are one aggregate with partial sums.
    """
    ends = df.agg(F.struct(F.min(x).cast("double").alias("mn"), F.max(x).cast("double").alias("mx"), F.count(x).alias("n")).alias("e")).scalar()
    mn, mx, n = ends["mn"], ends["mx"], ends["n"]
    width = F.when(mx > mn, (mx - mn) / bins).otherwise(F.lit(1.0))
    at = F.least(F.floor((F.col(x) - mn) / width), F.lit(bins - 1)).cast("int")
    counts = df.filter(F.col(x).isNotNull()).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    count = F.coalesce(F.col("count"), F.lit(0)).cast("bigint")
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).filter(n > 0)
    return grid.join(F.broadcast(counts), "bin", "left").select(
        "bin", (mn + F.col("bin") * width).alias("bin_lo"), (mn + (F.col("bin") + 1) * width).alias("bin_hi"),
        count.alias("count"), (count / (n * width)).alias("density"),
    )


def expected_vs_observed(df: DataFrame, group: str, x: str, mu: float, sigma2: float) -> DataFrame:
    """E5: observed mean / standard error beside the theoretical ones for a
    game with per-trial mean ``mu`` and variance ``sigma2``."""
    return df.groupBy(group).agg(
        F.count(x).alias("n"),
        F.avg(x).alias("observed_mean"),
        F.try_divide(F.stddev_pop(x), F.sqrt(F.count(x))).alias("observed_se"),
        F.lit(float(mu)).alias("expected_mean"),
        F.sqrt(F.try_divide(F.lit(sigma2), F.count(x))).alias("expected_se"),
    )


def proportion_interval(p: Column, n: Column, z: float = V.Z_975) -> tuple[Column, Column]:
    """Normal 95 % interval of a proportion."""
    half = F.lit(z) * F.sqrt(F.try_divide(p * (1 - p), n))
    return p - half, p + half


def proportion_intervals(df: DataFrame, group: str, x: str) -> DataFrame:
    """E6 per group: share of x > 0 and its interval."""
    agg = df.groupBy(group).agg(F.count(x).alias("n"), F.avg(F.when(F.col(x) > 0, 1).otherwise(0)).alias("p"))
    lo, hi = proportion_interval(F.col("p"), F.col("n"))
    return agg.select(group, "n", F.col("p").alias("p"), lo.alias("lower"), hi.alias("upper"))


def interval_coverage(df: DataFrame, group: str, sample: str, x: str) -> DataFrame:
    """Per group, the share of sample intervals that contain the group's
    population share (the share over all of the group's rows)."""
    per_sample = df.groupBy(group, sample).agg(
        F.count(x).alias("n"), F.sum(F.when(F.col(x) > 0, 1).otherwise(0)).alias("k"))
    population = per_sample.groupBy(group).agg(F.try_divide(F.sum("k"), F.sum("n")).alias("p0"))
    p = F.try_divide(F.col("k"), F.col("n"))
    lo, hi = proportion_interval(p, F.col("n"))
    return (
        per_sample.join(population, group)
        .groupBy(group)
        .agg(F.count(F.lit(1)).alias("samples"),
             F.avg(F.when((F.col("p0") >= lo) & (F.col("p0") <= hi), 1).otherwise(0)).alias("coverage"))
    )


def daily_mean(df: DataFrame, date: str, cols: list[str]) -> DataFrame:
    """Mean of each column per date."""
    return df.groupBy(date).agg(*[F.avg(c).alias(f"mean_{c}") for c in cols])


def weighted_share(df: DataFrame, n: str, shares: dict[str, str]) -> DataFrame:
    """Per candidate, sum(n * share / 100) / sum(n). One aggregate for all
    candidates (a single scan), unpivoted to one row per candidate. The
    product sum is taken before the division by 100 so it is exact on
    integer inputs."""
    names = list(shares)
    wide = df.agg(F.sum(n).alias("total_n"),
                  *[(F.sum(F.col(n) * F.col(shares[c])) / 100).alias(f"v{i}") for i, c in enumerate(names)])
    stack = ", ".join(f"'{c}', v{i}" for i, c in enumerate(names))
    out = wide.selectExpr(f"stack({len(names)}, {stack}) AS (candidate, votes)", "total_n")
    return out.select("candidate", "total_n", F.col("votes").alias("votes"),
                      F.try_divide(F.col("votes"), F.col("total_n")).alias("share"))


def spread(df: DataFrame, n: str, share_a: str, share_b: str, z: float = V.Z_975) -> DataFrame:
    """Spread d = p_b - p_a of two shares with p_b = votes_b / (votes_a +
    votes_b), sd = 2 sqrt(p_b (1 - p_b) / m), 95 % interval and z = d / sd."""
    agg = df.agg(
        (F.sum(F.col(n) * F.col(share_a)) / 100).alias("votes_a"),
        (F.sum(F.col(n) * F.col(share_b)) / 100).alias("votes_b"),
    )
    m = F.col("votes_a") + F.col("votes_b")
    p_b = F.try_divide(F.col("votes_b"), m)
    d = p_b - (1 - p_b)
    sd = 2 * F.sqrt(F.try_divide(p_b * (1 - p_b), m))
    return agg.select(
        p_b.alias("p_b"), d.alias("d"), sd.alias("sd"),
        (d - F.lit(z) * sd).alias("lower"), (d + F.lit(z) * sd).alias("upper"),
        F.try_divide(d, sd).alias("z"),
    )


def spread_pvalue(spread_row: DataFrame) -> DataFrame:
    """Two-sided normal p-value of the spread's z (pandas UDF, one row)."""
    return spread_row.withColumn("p_value", normal_p_udf(F.col("z")))


def describe_by_group(df: DataFrame, group: str, cols: list[str], exact: bool | str = True) -> DataFrame:
    """Count, mean, sample sd, min, quartiles, max per (group, column).

    Columns are unpivoted first so one grouped aggregate serves them all.
    ``exact`` uses Spark's ``percentile`` (linear interpolation, like pandas);
    ``exact="sorted"`` gives the same quartiles for groups of any size: the
    values are put in one order over all groups instead of one buffer per
    group; otherwise ``percentile_approx`` with a bounded sketch.
    """
    long = df.unpivot(group, cols, "metric", "value")
    if exact == "sorted":
        return _describe_sorted(long, group)
    q = (F.percentile("value", [0.25, 0.5, 0.75]) if exact
         else F.percentile_approx("value", [0.25, 0.5, 0.75], 10000).cast("array<double>"))
    return long.groupBy(group, "metric").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        q.alias("__q"),
        F.max("value").alias("max"),
    ).select(group, "metric", "count", "mean", "std", "min",
             F.col("__q")[0].alias("q25"), F.col("__q")[1].alias("q50"),
             F.col("__q")[2].alias("q75"), "max")


def _describe_sorted(long: DataFrame, group: str) -> DataFrame:
    plain = long.groupBy(F.col(group).alias("__grp"), F.col("metric").alias("__metric")).agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    found = group_quantiles(long, [group, "metric"], "value", [0.25, 0.5, 0.75])
    both = plain.join(found, F.col("__grp").eqNullSafe(found[group]) & (F.col("__metric") == found["metric"]), "left")
    return both.select(F.col("__grp").alias(group), F.col("__metric").alias("metric"), "count", "mean", "std", "min",
                       *[F.col("quantiles")[i].alias(c) for i, c in enumerate(("q25", "q50", "q75"))], "max")


def group_moments(df: DataFrame, group: str, cols: list[str]) -> DataFrame:
    """Mean, sample sd and non-null n per (group, metric), one aggregate."""
    long = df.unpivot(group, cols, "metric", "value")
    return long.groupBy(group, "metric").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"), F.count("value").alias("n"))


def welch(df: DataFrame, group: str, cols: list[str], first, second) -> DataFrame:
    """Welch t statistic and degrees of freedom per metric, group
    ``first`` against ``second``: one conditional aggregate per metric over
    the unpivoted rows (a single scan, no self-join)."""
    long = df.unpivot(group, cols, "metric", "value")
    v1 = F.when(F.col(group) == F.lit(first), F.col("value"))
    v2 = F.when(F.col(group) == F.lit(second), F.col("value"))
    m = long.groupBy("metric").agg(
        F.count(v1).alias("n_1"), F.count(v2).alias("n_2"),
        F.avg(v1).alias("mean_1"), F.avg(v2).alias("mean_2"),
        F.stddev_samp(v1).alias("sd_1"), F.stddev_samp(v2).alias("sd_2"),
    )
    va, vb = F.try_divide(F.pow("sd_1", 2), F.col("n_1")), F.try_divide(F.pow("sd_2", 2), F.col("n_2"))
    t = F.try_divide(F.col("mean_1") - F.col("mean_2"), F.sqrt(va + vb))
    dof = F.try_divide(F.pow(va + vb, 2),
                       F.try_divide(F.pow(va, 2), F.col("n_1") - 1) + F.try_divide(F.pow(vb, 2), F.col("n_2") - 1))
    return m.select(
        "metric", "n_1", "n_2",
        F.col("mean_1").alias("mean_1"), F.col("mean_2").alias("mean_2"),
        F.col("sd_1").alias("sd_1"), F.col("sd_2").alias("sd_2"),
        t.alias("t_stat"), dof.alias("dof"),
    )


def welch_test(welch_rows: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Two-sided p-value from the Student t distribution (Welch dof) and
    the decision at ``alpha`` (pandas UDF on one row per metric)."""
    p = t_p_udf(F.col("t_stat"), F.col("dof"))
    return welch_rows.withColumn("p_value", p).withColumn(
        "decision", F.when(F.col("p_value") < alpha, "reject H0").otherwise("fail to reject H0"))


def correlation_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every column pair, one aggregate."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    wide = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    stack = ", ".join(f"'{a}', '{b}', c{i}" for i, (a, b) in enumerate(pairs))
    return wide.selectExpr(f"stack({len(pairs)}, {stack}) AS (col_a, col_b, corr)").withColumn("corr", F.col("corr"))


def rolling_mean(df: DataFrame, order: list[str], values: list[str], rows: int = 5,
                 series: str | None = None, partitions: int | None = None) -> DataFrame:
    """Mean of the current and ``rows - 1`` preceding rows (min 1 row) in
    the total order ``order``, optionally restarting per ``series``.

    A window without a partition would run in one task, and a window per
    series puts a hot series in one task; see ``ordered.rolling``: blocks of
    consecutive rows with a halo of ``rows - 1`` rows. NULL and NaN are missing.
    """
    return rolling(df, ([series] if series else []) + order, series, values, rows, partitions)
