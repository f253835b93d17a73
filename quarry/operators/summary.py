"""Running summaries kept as mergeable partials.

A summary is stored as partial rows keyed by (key, window_start) holding only
sums and counts. Averages and ratios are derived on read. Merging a delta:

* a partial that already exists for the same (key, window_start) is
  *replaced*, not added, so replaying a micro-batch cannot double count
  (the reference adds, quirk Q8);
* everything is sums and counts, so the read-side aggregate is exact and
  independent of merge order (quirk Q7 disappears: there is no stored
  average to re-weight).

The replace step is a window over (key, window_start), at most one existing
and one new row per group, so no group can grow with the data.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators import measures as M


@dataclass(frozen=True)
class SummarySpec:
    sums: dict[str, Callable[[], Column]]         # partial name -> aggregate over raw rows
    averages: dict[str, tuple[str, str]] = field(default_factory=dict)   # out -> (sum, count)
    ratios: dict[str, tuple[str, str]] = field(default_factory=dict)     # out -> (num, den)
    order: list[str] = field(default_factory=list)                       # output column order


CATEGORY = SummarySpec(
    sums={
        "total_commissions": lambda: F.sum("commission_amount"),
        "total_successful_txns": lambda: M.count_if(M.approved()),
        "total_failed_txns": lambda: M.count_if(M.declined()),
        "total_transaction_value": lambda: F.sum("total_amount"),
        "total_value_approved": lambda: M.sum_if(M.approved(), "total_amount"),
        "total_value_declined": lambda: M.sum_if(M.declined(), "total_amount"),
        "total_commission_approved": lambda: M.sum_if(M.approved(), "commission_amount"),
        "total_commission_declined": lambda: M.sum_if(M.declined(), "commission_amount"),
        "total_count": lambda: F.count(F.lit(1)),
        "risk_sum": lambda: F.sum("risk_level").cast("bigint"),
    },
    averages={
        "avg_commission_per_transaction": ("total_commissions", "total_count"),
        "avg_risk_level": ("risk_sum", "total_count"),
    },
    ratios={"commission_to_transaction_ratio": ("total_commissions", "total_transaction_value")},
    order=[
        "total_commissions", "avg_commission_per_transaction", "commission_to_transaction_ratio",
        "total_successful_txns", "total_failed_txns", "total_transaction_value", "total_value_approved",
        "total_value_declined", "total_commission_approved", "total_commission_declined", "total_count",
        "avg_risk_level",
    ],
)

PARTY = SummarySpec(
    sums={
        "total_trxs": lambda: F.count(F.lit(1)),
        "total_trx_value": lambda: F.sum("total_amount"),
        "total_commissions": lambda: F.sum("commission_amount"),
        "approved_trxs": lambda: M.count_if(M.approved()),
        "declined_trxs": lambda: M.count_if(M.declined()),
    },
    averages={
        "avg_commission": ("total_commissions", "total_trxs"),
        "avg_trx_value": ("total_trx_value", "total_trxs"),
    },
    order=["total_trxs", "total_trx_value", "total_commissions", "avg_commission", "avg_trx_value",
           "approved_trxs", "declined_trxs"],
)

DAILY = SummarySpec(
    sums={
        "total_transactions": lambda: F.count(F.lit(1)),
        "approved_transactions": lambda: M.count_if(M.approved()),
        "declined_transactions": lambda: M.count_if(M.declined()),
        "risk_sum": lambda: F.sum("risk_level").cast("bigint"),
        "total_transaction_value": lambda: F.sum("total_amount"),
        "total_commissions": lambda: F.sum("commission_amount"),
    },
    averages={"avg_risk_level": ("risk_sum", "total_transactions")},
    order=["total_transactions", "approved_transactions", "declined_transactions", "avg_risk_level",
           "total_transaction_value", "total_commissions"],
)


def partials(tx: DataFrame, key: str, spec: SummarySpec, window: str = "1 minute") -> DataFrame:
    """Windowed partials of ``spec`` per (key, window_start): what a stream
    summary emits per micro-batch (D7-D11) and what the store keeps."""
    return (
        tx.groupBy(F.col(key), F.window("event_time", window).start.alias("window_start"))
        .agg(*[agg().alias(name) for name, agg in spec.sums.items()])
    )


def merge_partials(existing: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """Replace-or-insert ``delta`` into ``existing`` by (key, window_start)."""
    tagged = existing.withColumn("__prio", F.lit(0)).unionByName(delta.withColumn("__prio", F.lit(1)))
    newest = Window.partitionBy(key, "window_start").orderBy(F.col("__prio").desc())
    return tagged.withColumn("__rn", F.row_number().over(newest)).filter("__rn = 1").drop("__rn", "__prio")


def read_summary(parts: DataFrame, key: str, spec: SummarySpec) -> DataFrame:
    """Fold partials to one row per key and derive averages and ratios."""
    folded = parts.groupBy(key).agg(*[F.sum(n).cast("bigint").alias(n) for n in spec.sums])
    for out, (num, den) in {**spec.averages, **spec.ratios}.items():
        folded = folded.withColumn(out, F.try_divide(F.col(num), F.col(den)))
    return folded.select(key, *spec.order)


def merge_summary(existing: DataFrame, delta: DataFrame, key: str, spec: SummarySpec) -> DataFrame:
    """Merged partials folded to the summary."""
    return read_summary(merge_partials(existing, delta, key), key, spec)
