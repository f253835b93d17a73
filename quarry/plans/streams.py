"""Registered streaming queries (D1-D13): each runs a real Structured
Streaming query over the events file (availableNow trigger, checkpoint in the
shared folder) and returns what the sink holds afterwards.

Oracle: append mode emits a window once the watermark (max event time minus
the delay) passes its end, so the SQL keeps windows with
``window_end <= max(event_time) - delay``; complete mode and stateless
queries see every row.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import vocab as V
from quarry.operators import reports as R
from quarry.operators import summary as SU
from quarry.operators.ingest import transactions_from_messages
from quarry.plans import sqlparts as S
from quarry.plans.fraud import AMOUNT_FACTOR, VELOCITY, _AMOUNT_SQL, _GEO_SQL, _HALF_DAY_US
from quarry.plans.registry import ORACLES, query
from quarry.session import scratch_path
from quarry.sources.fixtures import raw_messages_from_transactions, transactions, transactions_from_events
from quarry.sources.sinks import load_summary
from quarry.sources.streams import event_file_stream, read_summary
from quarry.sources.tables import load
from quarry.streaming import jobs as J
from quarry.streaming import runner
from quarry.streaming.platform import Platform
from quarry.streaming.store import Archive, PartialStore, read_epochs, write_epoch

TX = ("transactions",)


def _stream(spark, sf):
    return event_file_stream(spark, sf, glob="events.parquet")


def _closed(delay: str, width: str = "1 minute", unit: str = "minute") -> str:
    return (f"date_trunc('{unit}', event_time) + INTERVAL {width} <= "
            f"(SELECT max(event_time) FROM transactions) - INTERVAL {delay}")


@query("stream_commission_by_type", f"""
SELECT date_trunc('minute', event_time) AS window_start, date_trunc('minute', event_time) + INTERVAL 1 MINUTE AS window_end,
       commission_type, CAST(sum(commission_amount) AS BIGINT) AS total_commission
FROM transactions WHERE {_closed('10 SECOND')} GROUP BY 1, 2, 3""", TX)
def q_stream_commission_by_type(spark, sf):
    return runner.run_to_table(spark, J.commission_by_type(_stream(spark, sf)), "commission_by_type")


@query("stream_commission_ratio", f"""
SELECT date_trunc('minute', event_time) AS window_start, date_trunc('minute', event_time) + INTERVAL 1 MINUTE AS window_end,
       merchant_category, sum(commission_amount) / nullif(sum(total_amount), 0) AS commission_ratio
FROM transactions WHERE {_closed('10 SECOND')} GROUP BY 1, 2, 3""", TX)
def q_stream_commission_ratio(spark, sf):
    return runner.run_to_table(spark, J.commission_ratio(_stream(spark, sf)), "commission_ratio")


_MERCHANT_WINDOWS = """
SELECT date_trunc('minute', event_time) AS window_start, date_trunc('minute', event_time) + INTERVAL 1 MINUTE AS window_end,
       merchant_id, CAST(sum(commission_amount) AS BIGINT) AS total_commission
FROM transactions {where} GROUP BY 1, 2, 3"""


@query("stream_top_merchants", f"""
SELECT * FROM ({_MERCHANT_WINDOWS.format(where='')}) ORDER BY window_end DESC, total_commission DESC, merchant_id LIMIT 10""", TX)
def q_stream_top_merchants(spark, sf):
    top = J.top_merchants_global(J.merchant_commission(_stream(spark, sf)))
    return runner.run_to_table(spark, top, "top_merchants", mode="complete")


@query("window_top_merchants", f"""
SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY total_commission DESC, merchant_id) AS INTEGER) AS rank
FROM ({_MERCHANT_WINDOWS.format(where='WHERE ' + _closed('20 SECOND'))})
QUALIFY rank <= 10""", TX)
def q_window_top_merchants(spark, sf):
    out = scratch_path(spark, "window-top-out")

    def sink(batch, epoch):
        write_epoch(J.top_per_window(batch), out, epoch)

    runner.run_foreach(spark, J.merchant_commission(_stream(spark, sf)), "window-top", sink)
    return read_epochs(spark, out).drop("epoch")


@query("stream_amount_anomaly", _AMOUNT_SQL, TX)
def q_stream_amount(spark, sf):
    # As in the reference: a batch job stores the customer summary keyed by
    # _id (A6); every micro-batch reads it anew and joins it (A3).
    path = scratch_path(spark, "customer-summary")
    load_summary(R.customer_summary(transactions(spark, sf)), path, id_column="customer_id")
    out = scratch_path(spark, "amount-out")

    def averages():
        return read_summary(spark, path, "_id", ["avg_trx_value"]).withColumnRenamed("_id", "customer_id")

    runner.run_foreach(spark, _stream(spark, sf), "amount", J.amount_sink(averages, out, factor=AMOUNT_FACTOR))
    return read_epochs(spark, out).drop("epoch")


@query("stream_velocity_alerts", f"""
WITH x AS (SELECT customer_id, epoch_us(event_time) // {_HALF_DAY_US} AS b FROM transactions),
w AS (SELECT customer_id, make_timestamp((b - k) * {_HALF_DAY_US}) AS window_start FROM x, range(0, 2) r(k))
SELECT '{V.FRAUD_VELOCITY}' AS fraud_type, customer_id, window_start, window_start + INTERVAL 24 HOUR AS window_end,
       count(*) AS transaction_count
FROM w GROUP BY customer_id, window_start
HAVING count(*) > 5 AND window_start + INTERVAL 24 HOUR <= (SELECT max(event_time) FROM transactions) - INTERVAL 2 MINUTE""", TX)
def q_stream_velocity(spark, sf):
    return runner.run_to_table(spark, J.velocity(_stream(spark, sf), **VELOCITY), "velocity")


@query("stream_geo_alerts", _GEO_SQL, TX)
def q_stream_geo(spark, sf):
    return runner.run_to_table(spark, J.geo(_stream(spark, sf)), "geo")


def _summary_stream(spark, sf, key, spec, name):
    store = PartialStore(scratch_path(spark, f"{name}-store"), key, spec)
    runner.run_foreach(spark, J.summary_partials(_stream(spark, sf), key, spec), name, store.write)
    return store.summary(spark)


_CLOSED20 = _closed("20 SECOND")


@query("stream_customer_type", f"""
SELECT customer_type, {S.category_measures(with_count=True)}
FROM transactions WHERE {_CLOSED20} GROUP BY customer_type""", TX)
def q_stream_customer_type(spark, sf):
    return _summary_stream(spark, sf, "customer_type", SU.CATEGORY, "customer-type")


@query("stream_customer", f"""
SELECT customer_id, {S.party_measures()}
FROM transactions WHERE {_CLOSED20} GROUP BY customer_id""", TX)
def q_stream_customer(spark, sf):
    return _summary_stream(spark, sf, "customer_id", SU.PARTY, "customer")


@query("stream_merchant_category", f"""
SELECT merchant_category, {S.category_measures(with_count=True)}
FROM transactions WHERE {_CLOSED20} GROUP BY merchant_category""", TX)
def q_stream_merchant_category(spark, sf):
    return _summary_stream(spark, sf, "merchant_category", SU.CATEGORY, "merchant-category")


@query("stream_merchant", f"""
SELECT merchant_id, {S.party_measures()}
FROM transactions WHERE {_CLOSED20} GROUP BY merchant_id""", TX)
def q_stream_merchant(spark, sf):
    return _summary_stream(spark, sf, "merchant_id", SU.PARTY, "merchant")


@query("stream_daily", f"""
SELECT CAST(event_time AS DATE) AS date, {S.daily_measures()}
FROM transactions WHERE {_closed('20 SECOND', '1 DAY', 'day')} GROUP BY 1""", TX)
def q_stream_daily(spark, sf):
    store = PartialStore(scratch_path(spark, "daily-store"), "date", SU.DAILY)
    runner.run_foreach(spark, J.daily_partials(_stream(spark, sf)), "daily", store.write)
    return store.summary(spark)


@query("stream_archive", """
SELECT DISTINCT transaction_id, customer_id, total_amount, event_time FROM transactions""", TX)
def q_stream_archive(spark, sf):
    archive = Archive(scratch_path(spark, "archive"), "transaction_id")
    src = _stream(spark, sf).select("transaction_id", "customer_id", "total_amount", "event_time")
    runner.run_foreach(spark, src, "archive", archive.write)
    return archive.read(spark)


def _platform_sql() -> str:
    """The batch alerts over the accepted rows of the raw messages; velocity windows that the watermark has passed."""
    body = ORACLES["alerts_union"]
    body = body[body.index("am AS ("):].replace("transactions", "accepted").replace(
        "HAVING count(*) > 5", "HAVING count(*) > 5 AND window_start + INTERVAL 24 HOUR <= (SELECT max(event_time) FROM accepted) - INTERVAL 2 MINUTE")
    return f"WITH accepted AS (SELECT * EXCLUDE (ingest_time, error_code) FROM validated WHERE error_code IS NULL),\n{body}"


@query("stream_platform_alerts", _platform_sql(), ("transactions", "raw_flat", "validated"))
def q_stream_platform_alerts(spark, sf):
    """Raw messages through the one sink that splits them: the alerts of its committed epochs, with member ids."""
    accepted = transactions_from_messages(raw_messages_from_transactions(transactions_from_events(load(spark, sf, "events"))))
    averages = R.customer_summary(accepted).select("customer_id", "avg_trx_value")
    platform = Platform(scratch_path(spark, "platform"), lambda: averages, amount_factor=AMOUNT_FACTOR, velocity=VELOCITY)
    platform.start(raw_messages_from_transactions(_stream(spark, sf))).awaitTermination()
    return platform.read(spark, "alerts")
