"""Registered statistics queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import stats as ST
from quarry.plans.registry import ORACLES, query
from quarry.sources.fixtures import days, outcomes, polls, trial

O, PL, TR, DY = ("outcomes",), ("polls",), ("trial",), ("days",)
# A fair-odds check for a single-zero roulette bet on red: p = 18/38.
P_WIN = 18 / 38
MU = 2 * P_WIN - 1
SIGMA2 = 1 - MU * MU
DAY_COLS = ["temperature", "feels_like_temp", "humidity", "wind_speed", "total_users"]
POLL_ORDER = ["date", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "share_a", "share_b", "n", "pollster"]


DECIMALS = 6  # of reported statistics: engines add up in different orders


def rounded(df):
    """Double columns to DECIMALS places."""
    return df.select(*[F.round(c, DECIMALS).alias(c) if t == "double" else c for c, t in df.dtypes])


def r6(e: str) -> str:
    return f"round({e}, 6)"


@query("outcome_summary", f"""
SELECT grp, count(x) AS n, {r6('avg(x)')} AS mean, {r6('stddev_pop(x)')} AS sd,
       {r6('stddev_pop(x) / sqrt(count(x))')} AS se FROM outcomes GROUP BY grp""", O)
def q_outcome_summary(spark, sf):
    return rounded(ST.outcome_summary(outcomes(spark, sf), "grp", "x"))


@query("positive_share", f"""
SELECT grp, {r6('avg(CASE WHEN x > 0 THEN 1 ELSE 0 END)')} AS positive_share FROM outcomes GROUP BY grp""", O)
def q_positive_share(spark, sf):
    return rounded(ST.positive_share(outcomes(spark, sf), "grp", "x"))


@query("density_histogram", f"""
WITH s AS (SELECT min(x) AS mn, max(x) AS mx, count(x) AS n FROM outcomes),
w AS (SELECT mn, n, (mx - mn) / 50 AS width FROM s),
c AS (SELECT least(floor((x - mn) / width), 49) AS bin, count(*) AS cnt FROM outcomes, w WHERE x IS NOT NULL GROUP BY 1)
SELECT CAST(g.bin AS INTEGER) AS bin, {r6('mn + g.bin * width')} AS bin_lo, {r6('mn + (g.bin + 1) * width')} AS bin_hi,
       CAST(coalesce(cnt, 0) AS BIGINT) AS count, {r6('coalesce(cnt, 0) / (n * width)')} AS density
FROM range(50) g(bin) CROSS JOIN w LEFT JOIN c ON c.bin = g.bin""", O)
def q_density_histogram(spark, sf):
    return rounded(ST.density_histogram(outcomes(spark, sf), "x", 50))


@query("outcome_per_round", f"""
SELECT grp, count(x / rounds) AS n, {r6('avg(x / rounds)')} AS mean, {r6('stddev_pop(x / rounds)')} AS sd,
       {r6('stddev_pop(x / rounds) / sqrt(count(x / rounds))')} AS se FROM outcomes GROUP BY grp""", O)
def q_outcome_per_round(spark, sf):
    o = outcomes(spark, sf).withColumn("per_round", F.col("x") / F.col("rounds"))
    return rounded(ST.outcome_summary(o, "grp", "per_round"))


@query("expected_vs_observed", f"""
SELECT grp, count(s) AS n, {r6('avg(s)')} AS observed_mean, {r6('stddev_pop(s) / sqrt(count(s))')} AS observed_se,
       CAST({round(MU, 6)} AS DOUBLE) AS expected_mean, {r6(f'sqrt({SIGMA2!r} / count(s))')} AS expected_se
FROM (SELECT grp, CAST(sign(x) AS BIGINT) AS s FROM outcomes) GROUP BY grp""", O)
def q_expected_vs_observed(spark, sf):
    o = outcomes(spark, sf).withColumn("s", F.signum("x").cast("bigint"))
    return rounded(ST.expected_vs_observed(o, "grp", "s", MU, SIGMA2))


@query("proportion_interval", f"""
WITH a AS (SELECT grp, count(x) AS n, avg(CASE WHEN x > 0 THEN 1 ELSE 0 END) AS p FROM outcomes GROUP BY grp)
SELECT grp, n, {r6('p')} AS p, {r6('p - 1.959963984540054 * sqrt(p * (1 - p) / n)')} AS lower,
       {r6('p + 1.959963984540054 * sqrt(p * (1 - p) / n)')} AS upper FROM a""", O)
def q_proportion_interval(spark, sf):
    return rounded(ST.proportion_intervals(outcomes(spark, sf), "grp", "x"))


@query("interval_coverage", f"""
WITH s AS (SELECT grp, user_id, count(x) AS n, sum(CASE WHEN x > 0 THEN 1 ELSE 0 END) AS k FROM outcomes GROUP BY 1, 2),
p AS (SELECT grp, sum(k) / sum(n) AS p0 FROM s GROUP BY grp)
SELECT s.grp, count(*) AS samples,
  {r6('avg(CASE WHEN p0 >= k / n - 1.959963984540054 * sqrt((k / n) * (1 - k / n) / n) AND p0 <= k / n + 1.959963984540054 * sqrt((k / n) * (1 - k / n) / n) THEN 1 ELSE 0 END)')} AS coverage
FROM s JOIN p ON s.grp = p.grp GROUP BY s.grp""", O)
def q_interval_coverage(spark, sf):
    return rounded(ST.interval_coverage(outcomes(spark, sf), "grp", "user_id", "x"))


@query("daily_mean", f"""
SELECT date, {r6('avg(share_a)')} AS mean_share_a, {r6('avg(share_b)')} AS mean_share_b FROM polls GROUP BY date""", PL)
def q_daily_mean(spark, sf):
    return rounded(ST.daily_mean(polls(spark, sf), "date", ["share_a", "share_b"]))


@query("weighted_share", f"""
SELECT 'a' AS candidate, sum(n) AS total_n, {r6('sum(n * share_a) / 100')} AS votes,
       {r6('sum(n * share_a) / 100 / sum(n)')} AS share FROM polls
UNION ALL
SELECT 'b', sum(n), {r6('sum(n * share_b) / 100')}, {r6('sum(n * share_b) / 100 / sum(n)')} FROM polls""", PL)
def q_weighted_share(spark, sf):
    return rounded(ST.weighted_share(polls(spark, sf), "n", {"a": "share_a", "b": "share_b"}))


_SPREAD_SQL = f"""
WITH v AS (SELECT sum(n * share_a) / 100 AS va, sum(n * share_b) / 100 AS vb FROM polls),
p AS (SELECT vb / (va + vb) AS pb, va + vb AS m FROM v),
d AS (SELECT pb, pb - (1 - pb) AS d, 2 * sqrt(pb * (1 - pb) / m) AS sd FROM p)
SELECT {r6('pb')} AS p_b, {r6('d')} AS d, {r6('sd')} AS sd, {r6('d - 1.959963984540054 * sd')} AS lower,
       {r6('d + 1.959963984540054 * sd')} AS upper, {r6('d / sd')} AS z FROM d"""


@query("spread_test", _SPREAD_SQL, PL)
def q_spread_test(spark, sf):
    return rounded(ST.spread(polls(spark, sf), "n", "share_a", "share_b"))


# Simpson's rule on the normal density from |z| on.
@query("spread_pvalue", f"""
WITH v AS (SELECT sum(n * share_a) / 100 AS va, sum(n * share_b) / 100 AS vb FROM polls),
p AS (SELECT vb / (va + vb) AS pb, va + vb AS m FROM v),
d AS (SELECT pb, pb - (1 - pb) AS d, 2 * sqrt(pb * (1 - pb) / m) AS sd FROM p),
steps AS (SELECT abs(d / sd) + i * 40.0 / 8000 AS x, CASE WHEN i IN (0, 8000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS c FROM d, range(8001) r(i)),
tail AS (SELECT 2 * sum(c * exp(-x * x / 2)) * 40.0 / 8000 / 3 / sqrt(2 * pi()) AS p FROM steps)
SELECT {r6('pb')} AS p_b, {r6('d')} AS d, {r6('sd')} AS sd, {r6('d - 1.959963984540054 * sd')} AS lower,
       {r6('d + 1.959963984540054 * sd')} AS upper, {r6('d / sd')} AS z, {r6('p')} AS p_value FROM d, tail""", PL)
def q_spread_pvalue(spark, sf):
    return rounded(ST.spread_pvalue(ST.spread(polls(spark, sf), "n", "share_a", "share_b")))


@query("describe_by_group", f"""
SELECT grp, metric, count(value) AS count, {r6('avg(value)')} AS mean, {r6('stddev_samp(value)')} AS std,
       min(value) AS min, {r6('quantile_cont(value, 0.25)')} AS q25, {r6('quantile_cont(value, 0.5)')} AS q50,
       {r6('quantile_cont(value, 0.75)')} AS q75, max(value) AS max
FROM (UNPIVOT trial ON n_chars, toxic INTO NAME metric VALUE value) GROUP BY grp, metric""", TR)
def q_describe(spark, sf):
    return rounded(ST.describe_by_group(trial(spark, sf).drop("doc_id"), "grp", ["n_chars", "toxic"]))


@query("describe_by_group_sorted", ORACLES["describe_by_group"])
def q_describe_sorted(spark, sf):
    return rounded(ST.describe_by_group(trial(spark, sf).drop("doc_id"), "grp", ["n_chars", "toxic"], exact="sorted"))


@query("group_moments", f"""
SELECT grp, metric, {r6('avg(value)')} AS mean, {r6('stddev_samp(value)')} AS sd, count(value) AS n
FROM (UNPIVOT trial ON n_chars, toxic INTO NAME metric VALUE value) GROUP BY grp, metric""", TR)
def q_group_moments(spark, sf):
    m = ST.group_moments(trial(spark, sf).drop("doc_id"), "grp", ["n_chars", "toxic"])
    return rounded(m.select("grp", "metric", "mean", "sd", "n"))


_WELCH_SQL = f"""
WITH m AS (SELECT grp, metric, avg(value) AS mean, stddev_samp(value) AS sd, count(value) AS n
           FROM (UNPIVOT trial ON n_chars, toxic INTO NAME metric VALUE value) GROUP BY grp, metric),
j AS (SELECT a.metric, a.n AS n_1, b.n AS n_2, a.mean AS mean_1, b.mean AS mean_2, a.sd AS sd_1, b.sd AS sd_2,
             pow(a.sd, 2) / a.n AS va, pow(b.sd, 2) / b.n AS vb
      FROM m a JOIN m b ON a.metric = b.metric AND a.grp = 1 AND b.grp = 0)
SELECT metric, n_1, n_2, {r6('mean_1')} AS mean_1, {r6('mean_2')} AS mean_2, {r6('sd_1')} AS sd_1, {r6('sd_2')} AS sd_2,
       {r6('(mean_1 - mean_2) / sqrt(va + vb)')} AS t_stat,
       {r6('pow(va + vb, 2) / (pow(va, 2) / (n_1 - 1) + pow(vb, 2) / (n_2 - 1))')} AS dof FROM j"""


@query("welch_t", _WELCH_SQL, TR)
def q_welch_t(spark, sf):
    return rounded(ST.welch(trial(spark, sf).drop("doc_id"), "grp", ["n_chars", "toxic"], 1, 0))


# Simpson's rule on the t density as a power of the cosine, x = sqrt(dof) tan(a).
_WELCH_ROWS = _WELCH_SQL.strip()[5:].rsplit("SELECT metric, n_1", 1)[0]


@query("welch_test", f"""
WITH {_WELCH_ROWS},
s AS (SELECT *, (mean_1 - mean_2) / sqrt(va + vb) AS t, pow(va + vb, 2) / (pow(va, 2) / (n_1 - 1) + pow(vb, 2) / (n_2 - 1)) AS dof FROM j),
e AS (SELECT metric, dof, atan(abs(t) / sqrt(dof)) AS lo, least(pi() / 2, atan(abs(t) / sqrt(dof)) + 45 / sqrt(dof)) AS hi FROM s),
steps AS (SELECT metric, dof, (hi - lo) / 20000 AS h, lo + i * (hi - lo) / 20000 AS a,
                 CASE WHEN i IN (0, 20000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS c FROM e, range(20001) r(i)),
p AS (SELECT metric, 2 * sum(c * pow(greatest(cos(a), 0), dof - 1)) * max(h) / 3
             * exp(lgamma((max(dof) + 1) / 2) - lgamma(max(dof) / 2)) / sqrt(pi()) AS p_value FROM steps GROUP BY metric)
SELECT s.metric, n_1, n_2, {r6('mean_1')} AS mean_1, {r6('mean_2')} AS mean_2, {r6('sd_1')} AS sd_1, {r6('sd_2')} AS sd_2,
       {r6('t')} AS t_stat, {r6('dof')} AS dof, {r6('p_value')} AS p_value,
       CASE WHEN p_value < 0.05 THEN 'reject H0' ELSE 'fail to reject H0' END AS decision
FROM s JOIN p ON s.metric = p.metric""", TR)
def q_welch_test(spark, sf):
    return rounded(ST.welch_test(ST.welch(trial(spark, sf).drop("doc_id"), "grp", ["n_chars", "toxic"], 1, 0)))


@query("correlation_pairs", " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM days"
    for i, a in enumerate(DAY_COLS) for b in DAY_COLS[i + 1:]), DY)
def q_correlation_pairs(spark, sf):
    return rounded(ST.correlation_pairs(days(spark, sf), DAY_COLS))


@query("rolling_mean", f"""
SELECT *, {r6(f"avg(share_a) OVER (ORDER BY {', '.join(POLL_ORDER)} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)")} AS rolling_share_a,
          {r6(f"avg(share_b) OVER (ORDER BY {', '.join(POLL_ORDER)} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)")} AS rolling_share_b
FROM polls""", PL)
def q_rolling_mean(spark, sf):
    r = ST.rolling_mean(polls(spark, sf), POLL_ORDER, ["share_a", "share_b"], rows=5)
    return rounded(r)
