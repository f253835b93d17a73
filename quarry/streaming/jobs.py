"""Streaming queries D1-D11 as functions of a transaction stream.

Every function takes a (streaming or batch) DataFrame of flattened
transactions and returns the aggregate the query writes; watermarks are
applied here so the same function gives the append-mode result on a stream
and the full result on a batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators import fraud as FR
from quarry.operators import summary as SU


def commission_by_type(tx: DataFrame, delay: str = "10 seconds", window: str = "1 minute") -> DataFrame:
    """Commission per type per tumbling window."""
    return (
        tx.withWatermark("event_time", delay)
        .groupBy(F.window("event_time", window).alias("window"), "commission_type")
        .agg(F.sum("commission_amount").alias("total_commission"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                "commission_type", "total_commission")
    )


def commission_ratio(tx: DataFrame, delay: str = "10 seconds", window: str = "1 minute") -> DataFrame:
    """Commission / value per category per window."""
    return (
        tx.withWatermark("event_time", delay)
        .groupBy(F.window("event_time", window).alias("window"), "merchant_category")
        .agg(F.try_divide(F.sum("commission_amount"), F.sum("total_amount")).alias("commission_ratio"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                "merchant_category", "commission_ratio")
    )


def merchant_commission(tx: DataFrame, delay: str = "20 seconds", window: str = "1 minute") -> DataFrame:
    """Commission per merchant per window (input of D3a / D3b)."""
    return (
        tx.withWatermark("event_time", delay)
        .groupBy(F.window("event_time", window).alias("window"), "merchant_id")
        .agg(F.sum("commission_amount").alias("total_commission"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                "merchant_id", "total_commission")
    )


def top_merchants_global(commission: DataFrame, k: int = 10) -> DataFrame:
    """The reference's "top merchants": one global limit over (window end
    desc, commission desc) -- not ten per window (quirk Q4). Complete mode."""
    return commission.orderBy(F.col("window_end").desc(), F.col("total_commission").desc(), "merchant_id").limit(k)


def top_per_window(batch: DataFrame, k: int = 10) -> DataFrame:
    """Ten per window. Ranking is refused on a stream, so this runs on
    each micro-batch of closed windows (append mode emits a window once)."""
    w = Window.partitionBy("window_start").orderBy(F.col("total_commission").desc(), "merchant_id")
    return batch.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def summary_partials(tx: DataFrame, key: str, spec: SU.SummarySpec, delay: str = "20 seconds",
                     window: str = "1 minute") -> DataFrame:
    """Windowed partials of a summary (sums and counts only)."""
    return (
        tx.withWatermark("event_time", delay)
        .groupBy(F.col(key), F.window("event_time", window).alias("window"))
        .agg(*[agg().alias(name) for name, agg in spec.sums.items()])
        .select(key, F.col("window.start").alias("window_start"), *spec.sums.keys())
    )


def daily_partials(tx: DataFrame, delay: str = "20 seconds") -> DataFrame:
    """Daily partials keyed by the date."""
    return (
        tx.withWatermark("event_time", delay)
        .groupBy(F.window("event_time", "1 day").alias("window"))
        .agg(*[agg().alias(name) for name, agg in SU.DAILY.sums.items()])
        .select(F.to_date("window.start").alias("date"), F.col("window.start").alias("window_start"),
                *SU.DAILY.sums.keys())
    )


def velocity(tx: DataFrame, delay: str = "2 minutes", **kw) -> DataFrame:
    """D5 on a stream."""
    return FR.velocity_alerts(tx.withWatermark("event_time", delay), **kw)


def geo(tx: DataFrame, delay: str = "10 minutes", **kw) -> DataFrame:
    """D6 on a stream: stream-stream interval self-join with watermarks."""
    return FR.geo_alerts(tx.withWatermark("event_time", delay), **kw)


def amount_sink(read_averages, path: str, **kw):
    """D4 on a stream: a foreachBatch sink that checks each micro-batch
    against the customer averages as ``read_averages()`` finds them then, so a
    summary that is rewritten between triggers is picked up. (The file list of
    a static side is fixed when the query starts and fails once it is gone.)
    """
    from quarry.streaming.store import write_epoch

    def sink(batch: DataFrame, epoch_id: int) -> None:
        write_epoch(FR.amount_anomaly(batch, read_averages(), **kw), path, epoch_id)

    return sink
