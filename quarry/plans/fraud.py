"""Registered join and fraud-rule queries (D4-D6 in batch, J2, J8-J10, A7, C22)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import vocab as V
from quarry.operators import fraud as FR
from quarry.operators import reports as R
from quarry.operators import summary as SU
from quarry.operators.joins import append_new, left_enrich
from quarry.operators.ordered import asof_join
from quarry.plans import sqlparts as S
from quarry.plans.registry import query
from quarry.sources.fixtures import listings, neighbourhoods, transactions

TX = ("transactions",)
# Rule parameters fitted to the driver tables (FIXTURES.md section 3); the
# reference's values stay the operators' defaults.
AMOUNT_FACTOR = 3
VELOCITY = dict(window="24 hours", slide="12 hours", limit=5)
_DAY_US = 86_400_000_000
_HALF_DAY_US = _DAY_US // 2

_AMOUNT_SQL = f"""
WITH avgs AS (SELECT customer_id, avg(total_amount) AS customer_avg_trx_value FROM transactions GROUP BY customer_id)
SELECT t.transaction_id AS tx_id, '{V.FRAUD_AMOUNT}' AS fraud_type, t.customer_id, a.customer_avg_trx_value,
       t.total_amount AS transaction_amount, t.event_time
FROM transactions t JOIN avgs a ON t.customer_id = a.customer_id
WHERE t.total_amount > a.customer_avg_trx_value * 3"""

_VELOCITY_SQL = f"""
WITH x AS (SELECT customer_id, transaction_id, epoch_us(event_time) // {_HALF_DAY_US} AS b FROM transactions),
w AS (SELECT customer_id, transaction_id, make_timestamp((b - k) * {_HALF_DAY_US}) AS window_start
      FROM x, range(0, 2) r(k)),
a AS (SELECT customer_id, window_start, count(*) AS transaction_count FROM w GROUP BY 1, 2 HAVING count(*) > 5)
"""

_GEO_SQL = f"""
SELECT '{V.FRAUD_GEO}' AS fraud_type, t1.customer_id, t1.transaction_id AS tx_id_1,
       t2.transaction_id AS tx_id_2, t1.event_time AS event_time_1, t2.event_time AS event_time_2,
       sqrt(pow(t1.location_lat - t2.location_lat, 2) + pow(t1.location_lng - t2.location_lng, 2)) AS euclidean_distance
FROM transactions t1 JOIN transactions t2
  ON t1.customer_id = t2.customer_id AND t1.event_time < t2.event_time
 AND t2.event_time <= t1.event_time + INTERVAL 5 MINUTE
WHERE sqrt(pow(t1.location_lat - t2.location_lat, 2) + pow(t1.location_lng - t2.location_lng, 2)) > 0.5"""


def _amount(spark, sf):
    tx = transactions(spark, sf)
    return FR.amount_anomaly(tx, R.customer_summary(tx), AMOUNT_FACTOR)


def _velocity(spark, sf):
    return FR.velocity_alerts(transactions(spark, sf), **VELOCITY)


def _geo(spark, sf):
    return FR.geo_alerts(transactions(spark, sf))


@query("amount_anomaly", _AMOUNT_SQL, TX)
def q_amount_anomaly(spark, sf):
    return _amount(spark, sf)


@query("velocity_alerts", _VELOCITY_SQL + f"""
SELECT '{V.FRAUD_VELOCITY}' AS fraud_type, customer_id, window_start,
       window_start + INTERVAL 24 HOUR AS window_end, transaction_count FROM a""", TX)
def q_velocity_alerts(spark, sf):
    return _velocity(spark, sf)


@query("velocity_members", _VELOCITY_SQL + """
SELECT a.customer_id, a.window_start, a.window_start + INTERVAL 24 HOUR AS window_end, w.transaction_id AS tx_id
FROM a JOIN w ON a.customer_id = w.customer_id AND a.window_start = w.window_start""", TX)
def q_velocity_members(spark, sf):
    tx = transactions(spark, sf)
    alerts = FR.velocity_alerts(tx, **VELOCITY)
    return FR.velocity_members(tx, alerts, VELOCITY["window"], VELOCITY["slide"])


@query("geo_alerts", _GEO_SQL, TX)
def q_geo_alerts(spark, sf):
    return _geo(spark, sf)


@query("alerts_union", f"""
WITH am AS ({_AMOUNT_SQL}),
{_VELOCITY_SQL.strip()[5:]},
ge AS ({_GEO_SQL})
SELECT tx_id AS key, fraud_type,
  json_object('tx_id', tx_id, 'fraud_type', fraud_type,
              'customer_avg_trx_value', CAST(round(customer_avg_trx_value, 2) AS DECIMAL(20, 2)),
              'transaction_amount', transaction_amount)::VARCHAR AS value FROM am
UNION ALL
SELECT customer_id, '{V.FRAUD_VELOCITY}', json_object('fraud_type', '{V.FRAUD_VELOCITY}', 'customer_id', customer_id,
  'transaction_ids', ids, 'transaction_count', transaction_count, 'window_start', strftime(window_start, '%Y-%m-%d %H:%M:%S'),
  'window_end', strftime(window_start + INTERVAL 24 HOUR, '%Y-%m-%d %H:%M:%S'))::VARCHAR
FROM a JOIN (SELECT customer_id, window_start, list(transaction_id ORDER BY encode(transaction_id)) AS ids FROM w GROUP BY 1, 2) USING (customer_id, window_start)
UNION ALL
SELECT customer_id, fraud_type, json_object('fraud_type', fraud_type, 'customer_id', customer_id,
  'tx_id_1', tx_id_1, 'tx_id_2', tx_id_2, 'event_time_1', strftime(event_time_1, '%Y-%m-%d %H:%M:%S.%f'),
  'event_time_2', strftime(event_time_2, '%Y-%m-%d %H:%M:%S.%f'),
  'euclidean_distance', CAST(round(euclidean_distance, 6) AS DECIMAL(20, 6)))::VARCHAR FROM ge""", TX)
def q_alerts_union(spark, sf):
    velocity = _velocity(spark, sf)
    members = FR.velocity_members(transactions(spark, sf), velocity, VELOCITY["window"], VELOCITY["slide"])
    return FR.alerts_union(_amount(spark, sf), FR.velocity_records(velocity, members), _geo(spark, sf))


# Insert-if-absent: the archive already holds everything before 2024-01-20;
# the new batch replays from 2024-01-15 and re-delivers its tail from 01-25.
@query("archive_new_rows", """
SELECT DISTINCT transaction_id, customer_id, total_amount, event_time FROM transactions
WHERE event_time >= TIMESTAMP '2024-01-20'""", TX)
def q_archive_new_rows(spark, sf):
    tx = transactions(spark, sf).select("transaction_id", "customer_id", "total_amount", "event_time")
    archived = tx.filter(F.col("event_time") < F.lit("2024-01-20").cast("timestamp"))
    batch = tx.filter(F.col("event_time") >= F.lit("2024-01-15").cast("timestamp"))
    batch = batch.unionByName(tx.filter(F.col("event_time") >= F.lit("2024-01-25").cast("timestamp")))
    return append_new(batch, archived, "transaction_id")


# Merge law: partials up to 01-16 merged with a delta replayed from 01-14
# must equal the customer-type report over all rows (no double counting).
@query("summary_merge", f"""
SELECT customer_type,
  {S.category_measures(with_count=True)}
FROM transactions GROUP BY customer_type""", TX)
def q_summary_merge(spark, sf):
    tx = transactions(spark, sf)
    cut = lambda op, d: tx.filter(op(F.col("event_time"), F.lit(d).cast("timestamp")))
    existing = SU.partials(cut(lambda a, b: a < b, "2024-01-16"), "customer_type", SU.CATEGORY)
    delta = SU.partials(cut(lambda a, b: a >= b, "2024-01-14"), "customer_type", SU.CATEGORY)
    return SU.merge_summary(existing, delta, "customer_type", SU.CATEGORY)


@query("listing_enrich", """
SELECT l.*, n.neighbourhood, n.neighbourhood_group, n.latitude, n.longitude
FROM listings l LEFT JOIN neighbourhoods n ON l.neighbourhood_id = n.neighbourhood_id""", ("listings", "neighbourhoods"))
def q_listing_enrich(spark, sf):
    return left_enrich(listings(spark, sf), neighbourhoods(spark, sf), "neighbourhood_id")


@query("listing_rollup", """
SELECT n.neighbourhood_group, count(l.name) AS n_listings, round(sum(l.price), 2) AS total_price,
       avg(n.latitude) AS avg_latitude, avg(n.longitude) AS avg_longitude
FROM listings l LEFT JOIN neighbourhoods n ON l.neighbourhood_id = n.neighbourhood_id
GROUP BY n.neighbourhood_group""", ("listings", "neighbourhoods"))
def q_listing_rollup(spark, sf):
    j = left_enrich(listings(spark, sf), neighbourhoods(spark, sf), "neighbourhood_id")
    return j.groupBy("neighbourhood_group").agg(
        F.count("name").alias("n_listings"),
        F.round(F.sum("price"), 2).alias("total_price"),
        F.avg("latitude").alias("avg_latitude"),
        F.avg("longitude").alias("avg_longitude"),
    )


@query("asof_last_decline", """
WITH d AS (SELECT customer_id, event_time, max(transaction_id) AS transaction_id FROM transactions WHERE status = 'declined' GROUP BY 1, 2)
SELECT l.transaction_id, l.customer_id, l.event_time,
       CASE WHEN d.event_time >= l.event_time - INTERVAL 2 DAY THEN d.event_time END AS matched_ts,
       CASE WHEN d.event_time >= l.event_time - INTERVAL 2 DAY THEN d.transaction_id END AS matched_transaction_id
FROM (SELECT * FROM transactions WHERE status = 'approved') l ASOF LEFT JOIN d ON l.customer_id = d.customer_id AND l.event_time >= d.event_time""",
       ("transactions",))
def q_asof_last_decline(spark, sf):
    """Each approved transaction with its customer's last declined one, if that was within two days."""
    t = transactions(spark, sf).select("transaction_id", "customer_id", "event_time", "status")
    approved = t.filter("status = 'approved'").drop("status")
    return asof_join(approved, t.filter("status = 'declined'"), "customer_id", "event_time", ["transaction_id"], tolerance="2 DAYS")
