"""Feature engineering on daily rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import vocab as V
from quarry.functions.holidays import holiday_calendar
from quarry.operators.joins import asof_distance, isin_calendar



def season_demean(df: DataFrame, group: str, cols: list[str]) -> DataFrame:
    """``adjusted_<c>`` = c - mean of c over the row's group.

    A grouped aggregate joined back on the group key (not a window, which
    would put a whole group in one task); the per-group table has one row per
    group, so AQE broadcasts it when small.
    """
    means = df.groupBy(group).agg(*[F.avg(c).alias(f"__mean_{c}") for c in cols])
    out = df.join(means, group, "left")
    for c in cols:
        out = out.withColumn(f"adjusted_{c}", F.col(c) - F.col(f"__mean_{c}"))
    return out.drop(*[f"__mean_{c}" for c in cols])


def cyclic(col: Column, period: float) -> tuple[Column, Column]:
    """sin and cos of 2*pi*col/period."""
    rad = F.lit(2 * math.pi) * col / F.lit(float(period))
    return F.sin(rad), F.cos(rad)


def cyclic_features(df: DataFrame, periods: dict[str, float]) -> DataFrame:
    out = df
    for c, p in periods.items():
        s, co = cyclic(F.col(c), p)
        out = out.withColumn(f"{c}_sin", s).withColumn(f"{c}_cos", co)
    return out


def power_features(df: DataFrame, cols: list[str], powers: list[int] = (2, 3)) -> DataFrame:
    """explicit powers (the reference's loop also produced x^0 and x^1, quirk Q12)."""
    out = df
    for c in cols:
        for p in powers:
            term = F.col(c)
            for _ in range(p - 1):
                term = term * F.col(c)
            out = out.withColumn(f"{c}_{p}", term)
    return out


def interaction_features(df: DataFrame) -> DataFrame:
    """products and differences of the weather columns."""
    return (
        df.withColumn("temp_minus_feels", F.col("temperature") - F.col("feels_like_temp"))
        .withColumn("temp_x_humidity", F.col("temperature") * F.col("humidity"))
        .withColumn("wind_feels_diff", F.col("wind_speed") * F.col("temp_minus_feels"))
    )


def calendar_flags(df: DataFrame, date: str = "date", cutoff: str = "2019-11-01") -> DataFrame:
    """weekend (weekday 5, 6 with Monday = 0), winter break (Dec, Jan),
    Thanksgiving week (MM-dd within 11-20..11-30), on/after ``cutoff``."""
    md = F.date_format(F.col(date), "MM-dd")
    return (
        df.withColumn("is_weekend", F.col("weekday").isin(5, 6).cast("int"))
        .withColumn("is_winter_break", F.col("month").isin(12, 1).cast("int"))
        .withColumn("is_thanksgiving_week", md.between("11-20", "11-30").cast("int"))
        .withColumn("after_cutoff", (F.col(date) >= F.to_date(F.lit(cutoff))).cast("int"))
    )


def daylight_hours(month: Column, latitude: float = V.DAYLIGHT_LATITUDE) -> Column:
    """day length estimate from the month's solar declination."""
    decl = F.lit(-V.DECLINATION_AMPLITUDE) * F.cos(F.radians(F.lit(360.0 / 12) * (month + 1)))
    x = -F.tan(F.radians(F.lit(latitude))) * F.tan(F.radians(decl))
    return F.lit(24.0) - F.lit(24 / math.pi) * F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), x)))


def holiday_flag(df: DataFrame, date: str = "date") -> DataFrame:
    """1 on a public holiday (calendar from date rules, J7 join)."""
    return isin_calendar(df, date, holiday_calendar(df, date), out="is_holiday")


def holiday_distance(df: DataFrame, date: str = "date") -> DataFrame:
    """F8: days since the previous holiday (strictly before) and until the
    next (the day itself counts as 0) -- quirk Q17 kept."""
    return asof_distance(df, date, holiday_calendar(df, date),
                         prev_out="days_to_prev_holiday", next_out="days_to_next_holiday")


def one_hot(df: DataFrame, col: str, levels: list, prefix: str | None = None, drop: bool = True) -> DataFrame:
    """one 0/1 column per known level."""
    prefix = prefix or f"{col}_"
    out = df.select(*df.columns, *[(F.col(col) == F.lit(v)).cast("int").alias(f"{prefix}{v}") for v in levels])
    return out.drop(col) if drop else out


def seasonal_index(df: DataFrame, date: str = "date") -> DataFrame:
    """ISO week cycle, weekday and day-of-month cycles, and their sum of sines."""
    out = df.withColumn("week_of_year", F.weekofyear(date)).withColumn("day", F.dayofmonth(date))
    ws, wc = cyclic(F.col("week_of_year"), 52)
    ds, dc = cyclic(F.col("day"), 31)
    wds, _ = cyclic(F.col("weekday"), 7)
    return (
        out.withColumn("week_sin", ws).withColumn("week_cos", wc)
        .withColumn("day_in_month_sin", ds).withColumn("day_in_month_cos", dc)
        .withColumn("seasonal_index", F.col("week_sin") + wds + F.col("day_in_month_sin"))
    )
