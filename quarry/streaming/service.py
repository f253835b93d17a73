"""All streaming queries of the transaction platform in one session.

``start_all`` starts the reference's set of queries -- commission by type and
by category, top merchants, the three fraud rules, five running summaries and
the raw archive -- over one transaction stream, each with its own
checkpoint and sink under ``root`` (a shared folder on a cluster). Triggers
default to the reference's 20 s / 1 min; tests pass ``availableNow``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quarry.operators import summary as SU
from quarry.operators.ingest import transactions_from_messages
from quarry.streaming import jobs as J
from quarry.streaming.runner import start
from quarry.streaming.store import Archive, PartialStore

SUMMARIES = {
    "customer_type": ("customer_type", SU.CATEGORY),
    "customer": ("customer_id", SU.PARTY),
    "merchant_category": ("merchant_category", SU.CATEGORY),
    "merchant": ("merchant_id", SU.PARTY),
}


def start_all(
    spark: SparkSession,
    tx: DataFrame,
    root: str,
    customer_avgs: DataFrame,
    fast: dict | None = None,
    slow: dict | None = None,
    velocity: dict | None = None,
    amount_factor: float | None = None,
) -> dict[str, StreamingQuery]:
    """Start every streaming query over the transaction stream ``tx``.

    ``customer_avgs``: the customer averages, or a function that reads them
    anew for each micro-batch (a summary that a batch job rewrites).
    """
    fast = fast or {"processingTime": "20 seconds"}
    slow = slow or {"processingTime": "1 minute"}
    root = root.rstrip("/")
    q: dict[str, StreamingQuery] = {}

    def files(name, df, mode="append", trigger=fast):
        q[name] = start(df, f"{root}/_checkpoints/{name}", mode, "parquet", f"{root}/{name}", trigger, name)

    def each(name, df, fn, trigger=slow, mode="append"):
        q[name] = start(df, f"{root}/_checkpoints/{name}", mode, fn, trigger=trigger, name=name)

    files("commission_by_type", J.commission_by_type(tx))
    files("commission_ratio", J.commission_ratio(tx))

    def top_sink(batch, epoch):
        batch.write.mode("overwrite").parquet(f"{root}/top_merchants")

    each("top_merchants", J.top_merchants_global(J.merchant_commission(tx)), top_sink, fast, "complete")
    amount_kw = {"factor": amount_factor} if amount_factor is not None else {}
    read_averages = customer_avgs if callable(customer_avgs) else lambda: customer_avgs
    each("amount_alerts", tx, J.amount_sink(read_averages, f"{root}/amount_alerts", **amount_kw))
    files("velocity_alerts", J.velocity(tx, **(velocity or {})), trigger=slow)
    files("geo_alerts", J.geo(tx), trigger=slow)
    for name, (key, spec) in SUMMARIES.items():
        store = PartialStore(f"{root}/{name}_summary", key, spec)
        each(f"{name}_summary", J.summary_partials(tx, key, spec), store.write)
    daily = PartialStore(f"{root}/daily_summary", "date", SU.DAILY)
    each("daily_summary", J.daily_partials(tx), daily.write)
    archive = Archive(f"{root}/archive", "transaction_id")
    each("archive", tx.select("transaction_id", "customer_id", "total_amount", "event_time"), archive.write, fast)
    return q


def start_from_messages(spark: SparkSession, raw: DataFrame, root: str, customer_avgs, **kw) -> dict[str, StreamingQuery]:
    """``start_all`` over the accepted transactions of raw (key, value, timestamp) messages, e.g. of ``read_topic``."""
    return start_all(spark, transactions_from_messages(raw), root, customer_avgs, **kw)
