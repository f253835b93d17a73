"""Fraud rules (D4-D6) as functions of a transaction DataFrame.

Each works on a batch DataFrame and on a stream: give a stream a watermark
first (see ``quarry.streaming.jobs``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import vocab as V
from quarry.operators.joins import euclid, interval_join


def amount_anomaly(tx: DataFrame, customer_avgs: DataFrame, factor: float = V.AMOUNT_FACTOR) -> DataFrame:
    """A transaction above ``factor`` x its customer's average value.

    The reference left-joins and then requires a non-null average, i.e. an
    inner join (quirk Q5). The averages table has one row per customer;
    Catalyst / AQE broadcast it only when its measured size allows.
    """
    avgs = customer_avgs.select("customer_id", F.col("avg_trx_value").alias("customer_avg_trx_value"))
    return (
        tx.join(avgs, on="customer_id", how="inner")
        .filter(F.col("total_amount") > F.col("customer_avg_trx_value") * F.lit(factor))
        .select(
            F.col("transaction_id").alias("tx_id"),
            F.lit(V.FRAUD_AMOUNT).alias("fraud_type"),
            "customer_id",
            "customer_avg_trx_value",
            F.col("total_amount").alias("transaction_amount"),
            "event_time",
        )
    )


def velocity_alerts(tx: DataFrame, window: str = "2 minutes", slide: str = "1 minute",
                    limit: int = V.VELOCITY_LIMIT) -> DataFrame:
    """More than ``limit`` transactions of one customer in a sliding window.

    Only counts are aggregated (partial aggregation, skew-safe). The member
    transaction ids come from :func:`velocity_members` in long form, so no
    group is ever collected into one array.
    """
    return (
        tx.groupBy(F.window("event_time", window, slide).alias("window"), "customer_id")
        .agg(F.count(F.lit(1)).alias("transaction_count"))
        .filter(F.col("transaction_count") > limit)
        .select(
            F.lit(V.FRAUD_VELOCITY).alias("fraud_type"),
            "customer_id",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "transaction_count",
        )
    )


def velocity_members(tx: DataFrame, alerts: DataFrame, window: str = "2 minutes",
                     slide: str = "1 minute") -> DataFrame:
    """Ids of the transactions behind each velocity alert, one row per id.

    Each transaction is assigned to its sliding windows (the same expansion
    Spark uses for ``window``) and equi-joined to the alerts on
    (customer, window start).
    """
    assigned = tx.select(
        "customer_id", F.col("transaction_id").alias("tx_id"),
        F.window("event_time", window, slide).start.alias("window_start"),
    )
    return alerts.select("customer_id", "window_start", "window_end").join(
        assigned, on=["customer_id", "window_start"], how="inner"
    )


def geo_alerts(tx: DataFrame, within: str = V.GEO_WINDOW, threshold: float = V.GEO_THRESHOLD, later: DataFrame | None = None) -> DataFrame:
    """Two transactions of a customer within ``within`` whose locations are
    more than ``threshold`` apart (time-bucketed interval self-join; with
    ``later`` the second transaction comes from there)."""
    def places(df: DataFrame) -> DataFrame:
        return df.select(
            F.col("transaction_id").alias("tx_id"), "customer_id", "event_time",
            F.col("location_lat").alias("lat"), F.col("location_lng").alias("lng"),
        )

    pairs = interval_join(places(tx), places(tx if later is None else later), "customer_id", "event_time", within, "t1_", "t2_")
    dist = euclid(F.col("t1_lat"), F.col("t1_lng"), F.col("t2_lat"), F.col("t2_lng"))
    return (
        pairs.withColumn("euclidean_distance", dist)
        .filter(F.col("euclidean_distance") > threshold)
        .select(
            F.lit(V.FRAUD_GEO).alias("fraud_type"),
            F.col("t1_customer_id").alias("customer_id"),
            F.col("t1_tx_id").alias("tx_id_1"),
            F.col("t2_tx_id").alias("tx_id_2"),
            F.col("t1_event_time").alias("event_time_1"),
            F.col("t2_event_time").alias("event_time_2"),
            "euclidean_distance",
        )
    )


IDS_PER_ALERT = 1000


def velocity_records(alerts: DataFrame, members: DataFrame) -> DataFrame:
    """D5 alerts with their ``transaction_ids``.

    A window with more than about IDS_PER_ALERT transactions gives several
    records, each with a part of the ids, so no array grows with a hot customer.
    """
    parts = F.ceil(F.col("transaction_count") / F.lit(IDS_PER_ALERT)).cast("int")
    part = F.pmod(F.xxhash64("tx_id"), parts)
    key = ["fraud_type", "customer_id", "window_start", "window_end", "transaction_count"]
    both = alerts.join(members.drop("window_end"), ["customer_id", "window_start"]).withColumn("part", part)
    return both.groupBy(*key, "part").agg(F.array_sort(F.collect_list("tx_id")).alias("transaction_ids")).drop("part")


def alerts_union(amount: DataFrame, velocity: DataFrame, geo: DataFrame) -> DataFrame:
    """A7 / 2.7: the three alert streams on one topic as (key, fraud_type, value JSON).

    Amount alerts are keyed by transaction, the others by customer.
    ``velocity`` is the output of :func:`velocity_records`.
    """
    a = amount.select(F.col("tx_id").alias("key"), "fraud_type",
                      F.to_json(F.struct(
                          "tx_id", "fraud_type",
                          F.round("customer_avg_trx_value", 2).cast("decimal(20,2)").alias("customer_avg_trx_value"),
                          "transaction_amount")).alias("value"))
    v = velocity.select(F.col("customer_id").alias("key"), "fraud_type",
                        F.to_json(F.struct("fraud_type", "customer_id", "transaction_ids", "transaction_count",
                                           F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                                           F.date_format("window_end", "yyyy-MM-dd HH:mm:ss").alias("window_end"))).alias("value"))
    second = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    g = geo.select(F.col("customer_id").alias("key"), "fraud_type",
                   F.to_json(F.struct("fraud_type", "customer_id", "tx_id_1", "tx_id_2",
                                      F.date_format("event_time_1", second).alias("event_time_1"),
                                      F.date_format("event_time_2", second).alias("event_time_2"),
                                      F.round("euclidean_distance", 6).cast("decimal(20,6)").alias("euclidean_distance"))).alias("value"))
    return a.unionByName(v).unionByName(g)
