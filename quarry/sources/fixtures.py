"""Deterministic projections of the input tables onto the reference's schemas.

Each projection is integer arithmetic on the driver tables so Spark and the
DuckDB oracle (``quarry.plans.views``) produce identical rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import vocab as V
from quarry.sources.tables import load


def pick(values: list, index: Column) -> Column:
    """values[index] for a 0-based integer column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def props_k(col: str = "props") -> Column:
    return F.get_json_object(F.col(col), "$.k").cast("int")


def transactions_from_events(events: DataFrame) -> DataFrame:
    """One flattened transaction per event (FIXTURES.md section 3)."""
    eid = F.col("event_id")
    amount = (F.round(F.col("value") * 100) * 1000).cast("bigint")
    base = events.select(
        eid,
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("user_id"),
        F.col("event_type"),
        amount.alias("amount"),
        props_k().alias("k"),
    )
    method = pick(V.PAYMENT_METHODS, eid % 4)
    declined = eid % 20 == 0
    has_device = (eid % 4 == 0) | (eid % 4 == 2)  # online, mobile
    device = lambda field: F.when(has_device, pick([d[field] for d in V.DEVICE_LIBRARY], eid % 3))
    vat = F.expr("(amount * 9) div 100")
    return base.select(
        eid.cast("string").alias("transaction_id"),
        F.col("event_time"),
        F.concat(F.lit("cust_"), F.col("user_id").cast("string")).alias("customer_id"),
        F.concat(F.lit("merch_"), (F.col("k") % 50).cast("string")).alias("merchant_id"),
        F.col("event_type").alias("merchant_category"),
        method.alias("payment_method"),
        F.col("amount"),
        F.when(declined, "declined").otherwise("approved").alias("status"),
        pick(V.COMMISSION_TYPES, eid % 3).alias("commission_type"),
        F.expr("amount div 50").alias("commission_amount"),
        vat.alias("vat_amount"),
        (F.col("amount") + vat).alias("total_amount"),
        pick(V.CUSTOMER_TYPES, F.col("user_id") % 3).alias("customer_type"),
        F.when(eid % 50 == 7, F.lit(5)).otherwise(1 + eid % 3).cast("int").alias("risk_level"),
        F.when(declined, pick(V.FAILURE_REASONS, F.expr("(event_id div 20) % 4"))).alias("failure_reason"),
        (F.lit(V.BASE_LAT) + ((eid * 7919) % 2000 - 1000) / 1000).alias("location_lat"),
        (F.lit(V.BASE_LNG) + ((eid * 104729) % 2000 - 1000) / 1000).alias("location_lng"),
        device("os").alias("device_os"),
        device("app_version").alias("device_app_version"),
        device("device_model").alias("device_model"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from_events(load(spark, sf_dir, "events"))


def raw_messages_from_transactions(tx: DataFrame) -> DataFrame:
    """Topic-shaped rows (key, value JSON, timestamp) of the transaction events.

    ``timestamp`` is the record's ingestion time (the event time). Deliberately
    broken rows for validation: event_id % 97 = 0 carries a wrong total,
    % 101 = 0 an unknown device os, % 103 = 0 an event time two days before
    its ingestion time. Times are serialised like the producer: ISO, ms, ``Z``.
    """
    eid = F.col("transaction_id").cast("bigint")
    ts = F.when(eid % 103 == 0, F.col("event_time") - F.expr("INTERVAL 2 DAYS")).otherwise(F.col("event_time"))
    os_ = F.when(eid % 101 == 0, F.lit("Symbian")).otherwise(F.col("device_os"))
    device = F.when(
        F.col("device_os").isNotNull(),
        F.create_map(
            F.lit("os"), os_,
            F.lit("app_version"), F.col("device_app_version"),
            F.lit("device_model"), F.col("device_model"),
        ),
    ).otherwise(F.expr("cast(map() as map<string,string>)"))
    event = F.struct(
        F.col("transaction_id"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"),
        "customer_id", "merchant_id", "merchant_category", "payment_method", "amount",
        F.create_map(F.lit("lat"), F.col("location_lat"), F.lit("lng"), F.col("location_lng")).alias("location"),
        device.alias("device_info"),
        "status", "commission_type", "commission_amount", "vat_amount",
        (F.col("total_amount") + F.when(eid % 97 == 0, 1).otherwise(0)).alias("total_amount"),
        "customer_type", "risk_level", "failure_reason",
    )
    return tx.select(
        F.col("customer_id").alias("key"),
        F.to_json(event).alias("value"),
        F.col("event_time").alias("timestamp"),
    )


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_messages_from_transactions(transactions_from_events(load(spark, sf_dir, "events")))


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patient-shaped rows from orders, customer, lineitem and part.

    One row per order: first ship date and the sorted distinct part types of
    its lines (NULL when the order has no lines). The per-order aggregate is a
    shuffle on l_orderkey; part is joined by key before it.
    """
    orders = load(spark, sf_dir, "orders")
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate")
    part = load(spark, sf_dir, "part").select("p_partkey", "p_type")
    per_order = (
        lines.join(part, lines.l_partkey == part.p_partkey)
        .groupBy("l_orderkey")
        .agg(
            F.min("l_shipdate").alias("first_ship"),
            F.concat_ws(",", F.array_sort(F.collect_set("p_type"))).alias("part_types"),
        )
    )
    yes_no = F.when(F.col("o_orderkey") % 2 == 0, "Yes").otherwise("No")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
        .join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")
        .select(
            F.col("o_orderkey").alias("patient_id"),
            F.concat((150 + F.col("o_orderkey") % 50).cast("string"), F.lit("cm")).alias("height"),
            (50 + F.col("o_custkey") % 60).alias("weight"),
            F.to_date("o_orderdate").alias("diagnosis_date"),
            F.to_date("first_ship").alias("surgery_date"),
            F.col("o_orderpriority").alias("stage"),
            F.col("c_mktsegment").alias("segment"),
            F.col("part_types").alias("symptoms"),
            yes_no.alias("family_history"),
        )
    )


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing rows from supplier (price = account balance)."""
    return load(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("listing_id"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("price"),
        F.col("s_nationkey").alias("neighbourhood_id"),
    )


def neighbourhoods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbourhoods from nation, grouped by region."""
    nation = load(spark, sf_dir, "nation")
    region = load(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        F.col("n_nationkey").alias("neighbourhood_id"),
        F.col("n_name").alias("neighbourhood"),
        F.col("r_name").alias("neighbourhood_group"),
        F.col("n_nationkey").cast("double").alias("latitude"),
        F.col("n_regionkey").cast("double").alias("longitude"),
    )


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome rows from events: group = event type, x = value - 50 (in cents,
    integer), rounds = 1 + user_id % 10."""
    e = load(spark, sf_dir, "events")
    return e.select(
        "event_id",
        F.col("event_type").alias("grp"),
        (F.round(F.col("value") * 100).cast("bigint") - 5000).alias("x"),
        (1 + F.col("user_id") % 10).alias("rounds"),
        F.col("user_id"),
    )


def polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Poll rows from lineitem: shares in percent (integer valued), n = quantity."""
    li = load(spark, sf_dir, "lineitem")
    return li.select(
        F.to_date("l_shipdate").alias("date"),
        F.round(F.col("l_discount") * 1000).alias("share_a"),
        F.round(F.col("l_tax") * 1000).alias("share_b"),
        F.col("l_quantity").alias("n"),
        F.col("l_returnflag").alias("pollster"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
    )


def trial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-group trial rows: labels joined to documents; group = quality."""
    labels = load(spark, sf_dir, "labels")
    docs = load(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return labels.join(docs, "doc_id").select(
        "doc_id", F.col("quality").alias("grp"), F.col("n_chars").cast("double").alias("n_chars"),
        F.col("toxic").cast("double").alias("toxic"),
    )


def days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rows from lineitem by ship date (integer sums, so exact).

    One aggregate shuffled by the ship date; the output has one row per date.
    """
    li = load(spark, sf_dir, "lineitem")
    cents = lambda c, m: F.round(F.col(c) * m).cast("bigint")
    d = li.groupBy(F.to_date("l_shipdate").alias("date")).agg(
        F.count(F.lit(1)).alias("total_users"),
        F.sum("l_quantity").alias("__q"),
        F.sum(cents("l_discount", 100)).alias("__d"),
        F.sum(cents("l_tax", 100)).alias("__t"),
        F.sum(cents("l_extendedprice", 100)).alias("__p"),
    )
    n = F.col("total_users")
    return d.select(
        "date",
        F.quarter("date").alias("season_id"),
        (F.year("date") % 2).alias("year"),
        F.month("date").alias("month"),
        ((F.dayofweek("date") + 5) % 7).alias("weekday"),
        (F.col("__q") / n).alias("temperature"),
        (F.col("__d") / n).alias("feels_like_temp"),
        (F.col("__t") / n).alias("humidity"),
        (F.col("__p") / n / 100000).alias("wind_speed"),
        "total_users",
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating per (user, item) from all events: twenty items for every
    hundred users, item = 20 * (user_id // 100) + props.k % 20,
    label = 1 + (max(event_id) % 9) / 2 (1.0 .. 5.0 in halves)."""
    e = load(spark, sf_dir, "events")
    item = (F.floor(F.col("user_id") / 100) * 20 + props_k() % 20).cast("int")
    return (
        e.groupBy("user_id", item.alias("item_id"))
        .agg(F.max("event_id").alias("__m"))
        .select("user_id", "item_id", (1 + (F.col("__m") % 9) / 2).alias("label"))
    )


def trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trust edges (trustor -> trustee) from all events: distinct
    (user_id, user_id + 1 + props.k % 10). Users, edges and the graph's
    diameter grow with the events; no depth reaches everybody."""
    e = load(spark, sf_dir, "events")
    return (
        e.select(F.col("user_id").alias("trustor"), (F.col("user_id") + 1 + props_k() % 10).cast("bigint").alias("trustee"))
        .distinct()
    )
