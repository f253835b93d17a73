"""Joins the reference needs beyond a plain equi-join.

* interval self-join: equi key plus a time range. Joining on the key alone
  would compare every pair of a hot key's rows; instead both sides carry a
  time bucket of the range's width and each left row is matched against its
  own bucket and the next one, so work is bounded by the rows that can
  actually fall inside the range. AQE's skew join splits a hot (key, bucket).
* as-of lookup: last calendar date before / first on or after each row.
  Every day between two calendar dates has the same two neighbours, so the
  gaps are spread to days (bounded by the date range) and joined on the date.
* insert-if-absent: left anti join against the target plus de-duplication.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _seconds(interval: str) -> int:
    num, unit = interval.split()
    unit = unit.lower().rstrip("s")
    scale = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit]
    return int(num) * scale


def interval_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    ts: str,
    within: str,
    left_prefix: str = "l_",
    right_prefix: str = "r_",
) -> DataFrame:
    """Pairs (l, r) with l.key = r.key and l.ts < r.ts <= l.ts + within.

    Works on batch DataFrames and on streams (give both sides a watermark;
    the range condition lets Spark expire state).
    """
    width = _seconds(within)
    bucket = lambda c: F.floor(F.unix_micros(F.col(c)) / F.lit(width * 1_000_000)).cast("bigint")
    l = left.select(*[F.col(c).alias(left_prefix + c) for c in left.columns])
    r = right.select(*[F.col(c).alias(right_prefix + c) for c in right.columns])
    lts, rts = left_prefix + ts, right_prefix + ts
    # A right row at most `width` later lies in the left row's bucket or the next.
    l = l.withColumn("__b", F.explode(F.array(bucket(lts), bucket(lts) + 1)))
    r = r.withColumn("__b", bucket(rts))
    cond = (
        (F.col(left_prefix + key) == F.col(right_prefix + key))
        & (l["__b"] == r["__b"])
        & (F.col(lts) < F.col(rts))
        & (F.col(rts) <= F.col(lts) + F.expr(f"INTERVAL {within}"))
    )
    return l.join(r, cond, "inner").drop(l["__b"]).drop(r["__b"])


def append_new(batch: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``target``, one per key.

    ``dropDuplicates`` keeps one row per key (identical copies in practice);
    the anti join is a shuffle on the key (or a broadcast when the target is
    small enough for AQE).
    """
    return batch.dropDuplicates([key]).join(target.select(key), on=key, how="left_anti")


def isin_calendar(df: DataFrame, date_col: str, calendar: DataFrame, cal_col: str = "date",
                  out: str = "is_holiday") -> DataFrame:
    """0/1 membership of ``date_col`` in a date set (left join on the date).

    Whether the calendar is broadcast is left to its size.
    """
    cal = calendar.select(F.col(cal_col).alias("__d")).distinct().withColumn("__hit", F.lit(1))
    joined = df.join(cal, df[date_col] == F.col("__d"), "left")
    return joined.withColumn(out, F.coalesce(F.col("__hit"), F.lit(0))).drop("__d", "__hit")


def asof_distance(
    df: DataFrame,
    date_col: str,
    calendar: DataFrame,
    cal_col: str = "date",
    prev_out: str = "days_since_prev",
    next_out: str = "days_until_next",
) -> DataFrame:
    """Days since the last calendar date strictly before each row's date,
    and days until the first calendar date on or after it (0 on the day).

    Two neighbouring calendar dates are the answer for every day between them:
    the calendar's gaps are spread to one row per day and meet the rows by an
    equi-join. Only the calendar itself is put in order, never the rows' dates.
    """
    from pyspark.sql import Window

    cal = calendar.select(F.col(cal_col).alias("__d")).filter(F.col("__d").isNotNull()).distinct()
    # days before the first and after the last calendar date have one neighbour
    ends = df.select(F.col(date_col).alias("__d")).union(cal).agg(F.min("__d").alias("lo"), F.max("__d").alias("hi"))
    outer = ends.select(F.explode(F.array(F.date_sub("lo", 1), F.date_add("hi", 1))).alias("__d"), F.lit(False).alias("__real"))
    marks = cal.withColumn("__real", F.lit(True)).unionByName(outer.filter(F.col("__d").isNotNull()))
    order = Window.orderBy("__d")  # calendar dates and two more
    gaps = marks.select("__d", "__real", F.lead("__d").over(order).alias("__to"), F.lead("__real").over(order).alias("__to_real"))
    gaps = gaps.filter(F.col("__to").isNotNull())
    days = gaps.select("*", F.explode(F.sequence(F.date_add("__d", 1), F.col("__to"))).alias("__day"))
    per_date = days.select(
        "__day",
        F.when(F.col("__real"), F.datediff(F.col("__day"), F.col("__d"))).alias(prev_out),
        F.when(F.col("__to_real"), F.datediff(F.col("__to"), F.col("__day"))).alias(next_out),
    )
    return df.join(per_date, df[date_col] == per_date["__day"], "left").drop("__day")


def left_enrich(df: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    """Left join of a fact with a dimension; Catalyst/AQE choose the strategy."""
    return df.join(dim, on=on, how=how)


def euclid(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Planar distance on coordinates."""
    return F.sqrt(F.pow(lat1 - lat2, 2) + F.pow(lng1 - lng2, 2))
