"""Registered rating and trust-graph queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import graph as G
from quarry.plans.registry import query
from quarry.plans.stats import rounded
from quarry.sources.fixtures import days, ratings, trust

RT, RTT = ("ratings",), ("ratings", "trust")
DEPTHS = range(1, 10)


@query("item_rating_stats", """
SELECT item_id, round(avg(label), 6) AS average_rating, round(var_samp(label), 6) AS variance_rating,
       count(label) AS number_of_reviews, min(label) AS min_rating, max(label) AS max_rating,
       median(label) AS median_rating FROM ratings GROUP BY item_id""", RT)
def q_item_stats(spark, sf):
    return rounded(G.item_rating_stats(ratings(spark, sf)))


@query("user_rating_stats", """
SELECT user_id, round(avg(label), 6) AS average_rating, round(var_samp(label), 6) AS variance_rating,
       count(label) AS number_of_ratings, median(label) AS median_of_ratings FROM ratings GROUP BY user_id""", RT)
def q_user_stats(spark, sf):
    return rounded(G.user_rating_stats(ratings(spark, sf)))


_DEG_SQL = """
SELECT coalesce(o.user_id, i.user_id) AS user_id, coalesce(o.n, 0) AS total_number_of_trustees,
       coalesce(i.n, 0) AS total_number_of_trusters
FROM (SELECT trustor AS user_id, count(*) AS n FROM trust GROUP BY 1) o
FULL JOIN (SELECT trustee AS user_id, count(*) AS n FROM trust GROUP BY 1) i ON o.user_id = i.user_id"""


@query("trust_degrees", _DEG_SQL, RTT)
def q_trust_degrees(spark, sf):
    return G.trust_degrees(trust(spark, sf))


@query("user_features", f"""
SELECT u.*, coalesce(d.total_number_of_trustees, 0) AS total_number_of_trustees,
       coalesce(d.total_number_of_trusters, 0) AS total_number_of_trusters
FROM (SELECT user_id, round(avg(label), 6) AS average_rating, round(var_samp(label), 6) AS variance_rating,
             count(label) AS number_of_ratings, median(label) AS median_of_ratings FROM ratings GROUP BY user_id) u
LEFT JOIN ({_DEG_SQL}) d ON u.user_id = d.user_id""", RTT)
def q_user_features(spark, sf):
    return rounded(G.user_features(ratings(spark, sf), trust(spark, sf)))


_BASE_SQL = """
WITH g AS (SELECT avg(label) AS global_mean FROM ratings),
bu AS (SELECT user_id, avg(label - global_mean) AS b_u FROM ratings, g GROUP BY user_id),
bi AS (SELECT item_id, avg(label - global_mean) AS b_i FROM ratings, g GROUP BY item_id),
b AS (SELECT r.user_id, r.item_id, r.label, g.global_mean, coalesce(bu.b_u, 0) AS b_u, coalesce(bi.b_i, 0) AS b_i
      FROM ratings r CROSS JOIN g LEFT JOIN bu ON r.user_id = bu.user_id LEFT JOIN bi ON r.item_id = bi.item_id)"""


@query("rating_baseline", _BASE_SQL + """
SELECT user_id, item_id, label, round(global_mean, 6) AS global_mean, round(b_u, 6) AS b_u, round(b_i, 6) AS b_i,
       round(global_mean + b_u + b_i, 6) AS baseline_pred, round(label - (global_mean + b_u + b_i), 6) AS residual FROM b""", RT)
def q_rating_baseline(spark, sf):
    out = G.rating_baseline(ratings(spark, sf))
    return out.select("user_id", "item_id", "label", *[
        F.round(c, 6).alias(c) for c in ["global_mean", "b_u", "b_i", "baseline_pred", "residual"]])


_TRUSTED_SQL = """
WITH e AS (SELECT DISTINCT trustor AS user_id, trustee AS nbr FROM trust),
c AS (SELECT r.user_id, r.item_id, n.label AS nbr_label
      FROM ratings r JOIN e ON r.user_id = e.user_id JOIN ratings n ON n.user_id = e.nbr AND n.item_id = r.item_id),
s AS (SELECT user_id, item_id, avg(nbr_label) AS a, var_pop(nbr_label) AS v, min(nbr_label) AS mn, max(nbr_label) AS mx,
             median(nbr_label) AS md, CAST(count(*) AS DOUBLE) AS n FROM c GROUP BY 1, 2)
SELECT r.user_id, r.item_id, r.label,
  round(coalesce(s.a, -1), 6) AS avg_rating_trustees, round(coalesce(s.v, -1), 6) AS var_rating_trustees,
  coalesce(s.mn, -1) AS min_rating_trustees, coalesce(s.mx, -1) AS max_rating_trustees,
  coalesce(s.md, -1) AS median_rating_trustees, coalesce(s.n, -1) AS num_trustees_rated
FROM ratings r LEFT JOIN s ON r.user_id = s.user_id AND r.item_id = s.item_id"""


@query("trusted_rating_stats", _TRUSTED_SQL, RTT)
def q_trusted(spark, sf):
    r = ratings(spark, sf)
    return rounded(G.trusted_rating_stats(r, r, trust(spark, sf)))


@query("khop_reach", "SELECT src, dst, CAST(hops AS INTEGER) AS hops FROM reach", ("ratings", "trust", "reach"))
def q_khop_reach(spark, sf):
    return G.khop_reach(trust(spark, sf), ratings(spark, sf).select("user_id"), max_depth=9)


def _khop_sql() -> str:
    cols = []
    for d in DEPTHS:
        v = f"CASE WHEN hops <= {d} THEN nbr_label END"
        cols += [f"round(avg({v}), 6) AS m{d}", f"round(stddev_pop({v}), 6) AS s{d}", f"count({v}) AS c{d}",
                 f"median({v}) AS md{d}", f"min({v}) AS mn{d}", f"max({v}) AS mx{d}"]
    outs = []
    for d in DEPTHS:
        outs += [f"coalesce(m{d}, -1) AS trust_mean{d}", f"coalesce(s{d}, -1) AS trust_std{d}",
                 f"coalesce(c{d}, 0) AS trust_count{d}", f"coalesce(md{d}, -1) AS median{d}",
                 f"coalesce(mn{d}, -1) AS min{d}", f"coalesce(mx{d}, -1) AS max{d}"]
    return f"""
WITH c AS (SELECT r.user_id, r.item_id, h.hops, n.label AS nbr_label
           FROM ratings r JOIN reach h ON r.user_id = h.src JOIN ratings n ON n.user_id = h.dst AND n.item_id = r.item_id),
s AS (SELECT user_id, item_id, {', '.join(cols)} FROM c GROUP BY 1, 2)
SELECT r.user_id, r.item_id, r.label, {', '.join(outs)}
FROM ratings r LEFT JOIN s ON r.user_id = s.user_id AND r.item_id = s.item_id"""


@query("khop_rating_stats", _khop_sql(), ("ratings", "trust", "reach"))
def q_khop_stats(spark, sf):
    r, t = ratings(spark, sf), trust(spark, sf)
    reach = G.khop_masks(t, r.select("user_id"), max_depth=max(DEPTHS))
    return rounded(G.khop_rating_stats(r, r, reach, DEPTHS))


@query("group_mse", """
WITH g AS (SELECT CAST(year AS VARCHAR) AS year, CAST(season_id AS VARCHAR) AS season_id, regr_count(total_users, temperature) AS n,
                  (regr_syy(total_users, temperature) - pow(regr_sxy(total_users, temperature), 2) / regr_sxx(total_users, temperature))
                    / regr_count(total_users, temperature) AS mse
           FROM days GROUP BY year, season_id)
SELECT year, season_id, CAST(n AS BIGINT) AS n, round(mse, 6) AS mse FROM g
UNION ALL
SELECT 'all', 'all', CAST(sum(n) AS BIGINT), round(sum(n * mse) / sum(n), 6) FROM g""", ("days",))
def q_group_mse(spark, sf):
    from quarry.operators.learn import group_line_mse

    return rounded(group_line_mse(days(spark, sf), ["year", "season_id"], "temperature", "total_users"))


def _determinant(names: list[str]) -> str:
    """Determinant of the covariance matrix of ``names`` by expansion along the first row."""
    def minor(rows, cols):
        if not rows:
            return "1"
        return "(" + " ".join(f"{'-' if k % 2 else '+'} c_{min(rows[0], c)}_{max(rows[0], c)} * {minor(rows[1:], cols[:k] + cols[k + 1:])}" for k, c in enumerate(cols)) + ")"

    every = tuple(range(len(names)))
    return minor(every, every)


_LINE = ["temperature", "humidity", "wind_speed", "total_users"]


# The variance left by a regression is the determinant of all covariances over that of the features'.
@query("group_mse_features", f"""
WITH c AS (SELECT year, season_id, count(*) AS n, {', '.join(f"covar_pop({a}, {b}) AS c_{i}_{j}" for i, a in enumerate(_LINE) for j, b in enumerate(_LINE) if i <= j)}
           FROM days GROUP BY year, season_id),
g AS (SELECT CAST(year AS VARCHAR) AS year, CAST(season_id AS VARCHAR) AS season_id, n, {_determinant(_LINE)} / {_determinant(_LINE[:3])} AS mse FROM c)
SELECT year, season_id, CAST(n AS BIGINT) AS n, round(mse, 6) AS mse FROM g
UNION ALL
SELECT 'all', 'all', CAST(sum(n) AS BIGINT), round(sum(n * mse) / sum(n), 6) FROM g""", ("days",))
def q_group_mse_features(spark, sf):
    from quarry.operators.learn import group_linear_mse

    return rounded(group_linear_mse(days(spark, sf), ["year", "season_id"], _LINE[:3], _LINE[3]))


@query("rating_features", f"""
WITH t AS ({_TRUSTED_SQL}),
u AS (SELECT u.*, coalesce(d.total_number_of_trustees, 0) AS total_number_of_trustees,
             coalesce(d.total_number_of_trusters, 0) AS total_number_of_trusters
      FROM (SELECT user_id, round(avg(label), 6) AS average_rating, round(var_samp(label), 6) AS variance_rating,
                   count(label) AS number_of_ratings, median(label) AS median_of_ratings FROM ratings GROUP BY user_id) u
      LEFT JOIN ({_DEG_SQL}) d ON u.user_id = d.user_id),
{_BASE_SQL.strip()[5:]},
res AS (SELECT user_id, item_id, round(label - (global_mean + b_u + b_i), 6) AS residual FROM b),
it AS (SELECT item_id, round(avg(label), 6) AS item_average_rating, round(var_samp(label), 6) AS item_variance_rating,
              count(label) AS item_number_of_reviews, min(label) AS item_min_rating, max(label) AS item_max_rating,
              median(label) AS item_median_rating FROM ratings GROUP BY item_id)
SELECT t.*, u.average_rating, u.variance_rating, u.number_of_ratings, u.median_of_ratings,
       u.total_number_of_trustees, u.total_number_of_trusters, res.residual,
       it.item_average_rating, it.item_variance_rating, it.item_number_of_reviews, it.item_min_rating,
       it.item_max_rating, it.item_median_rating
FROM t LEFT JOIN u ON t.user_id = u.user_id
LEFT JOIN res ON t.user_id = res.user_id AND t.item_id = res.item_id
LEFT JOIN it ON t.item_id = it.item_id""", RTT)
def q_rating_features(spark, sf):
    return rounded(G.rating_features(ratings(spark, sf), trust(spark, sf)).drop("baseline_pred"))
