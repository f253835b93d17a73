"""Registered feature-engineering queries (F1-F10, W2) over the daily rows."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from quarry.functions.holidays import holiday_calendar
from quarry.operators import features as FE
from quarry.plans.registry import query
from quarry.sources.fixtures import days

DY, DH = ("days",), ("days", "holidays")
WEATHER = ["temperature", "humidity", "wind_speed", "feels_like_temp"]
CUTOFF = "1999-11-01"  # the reference's cut-off date moved into this data's range
TWO_PI = repr(2 * math.pi)


def r(c, d=6):
    return F.round(F.col(c), d).alias(c)


def s(e: str, d: int = 6) -> str:
    return f"round({e}, {d})"


@query("season_demean", "SELECT date, season_id, " + ", ".join(
    f"{s(f'{c} - avg({c}) OVER (PARTITION BY season_id)')} AS adjusted_{c}" for c in WEATHER) + " FROM days", DY)
def q_season_demean(spark, sf):
    out = FE.season_demean(days(spark, sf), "season_id", WEATHER)
    return out.select("date", "season_id", *[r(f"adjusted_{c}") for c in WEATHER])


@query("cyclic_features", f"""
SELECT date, {s(f'sin({TWO_PI} * month / 12.0)', 9)} AS month_sin, {s(f'cos({TWO_PI} * month / 12.0)', 9)} AS month_cos,
       {s(f'sin({TWO_PI} * weekday / 7.0)', 9)} AS weekday_sin, {s(f'cos({TWO_PI} * weekday / 7.0)', 9)} AS weekday_cos
FROM days""", DY)
def q_cyclic(spark, sf):
    out = FE.cyclic_features(days(spark, sf), {"month": 12, "weekday": 7})
    return out.select("date", *[r(c, 9) for c in ["month_sin", "month_cos", "weekday_sin", "weekday_cos"]])


# Row-wise IEEE arithmetic is identical in both engines: no rounding here.
@query("power_features", """
SELECT date, temperature * temperature AS temperature_2, temperature * temperature * temperature AS temperature_3,
       humidity * humidity AS humidity_2, humidity * humidity * humidity AS humidity_3 FROM days""", DY)
def q_power(spark, sf):
    out = FE.power_features(days(spark, sf), ["temperature", "humidity"], [2, 3])
    return out.select("date", "temperature_2", "temperature_3", "humidity_2", "humidity_3")


@query("interaction_features", """
SELECT date, temperature - feels_like_temp AS temp_minus_feels, temperature * humidity AS temp_x_humidity,
       wind_speed * (temperature - feels_like_temp) AS wind_feels_diff FROM days""", DY)
def q_interaction(spark, sf):
    out = FE.interaction_features(days(spark, sf))
    return out.select("date", "temp_minus_feels", "temp_x_humidity", "wind_feels_diff")


@query("calendar_flags", f"""
SELECT date, CAST(weekday IN (5, 6) AS INTEGER) AS is_weekend, CAST(month IN (12, 1) AS INTEGER) AS is_winter_break,
       CAST(strftime(date, '%m-%d') BETWEEN '11-20' AND '11-30' AS INTEGER) AS is_thanksgiving_week,
       CAST(date >= DATE '{CUTOFF}' AS INTEGER) AS after_cutoff FROM days""", DY)
def q_calendar_flags(spark, sf):
    out = FE.calendar_flags(days(spark, sf), cutoff=CUTOFF)
    return out.select("date", "is_weekend", "is_winter_break", "is_thanksgiving_week", "after_cutoff")


@query("daylight_hours", f"""
SELECT date, month, {s(f'24.0 - {24 / math.pi!r} * acos(least(1.0, greatest(-1.0, -tan(radians(40.7128)) * tan(radians(-23.44 * cos(radians(30.0 * (month + 1))))))))', 9)} AS daylight
FROM days""", DY)
def q_daylight(spark, sf):
    d = days(spark, sf)
    return d.select("date", "month", F.round(FE.daylight_hours(F.col("month")), 9).alias("daylight"))


@query("holiday_calendar", "SELECT date, name FROM holidays", DH)
def q_holiday_calendar(spark, sf):
    return holiday_calendar(days(spark, sf))


@query("holiday_flag", """
SELECT d.date, CASE WHEN EXISTS (SELECT 1 FROM holidays h WHERE h.date = d.date) THEN 1 ELSE 0 END AS is_holiday
FROM days d""", DH)
def q_holiday_flag(spark, sf):
    return FE.holiday_flag(days(spark, sf)).select("date", "is_holiday")


@query("holiday_distance", """
SELECT d.date,
  CAST(date_diff('day', (SELECT max(h.date) FROM holidays h WHERE h.date < d.date), d.date) AS INTEGER) AS days_to_prev_holiday,
  CAST(date_diff('day', d.date, (SELECT min(h.date) FROM holidays h WHERE h.date >= d.date)) AS INTEGER) AS days_to_next_holiday
FROM days d""", DH)
def q_holiday_distance(spark, sf):
    return FE.holiday_distance(days(spark, sf)).select("date", "days_to_prev_holiday", "days_to_next_holiday")


@query("one_hot", "SELECT date, " + ", ".join(
    f"CAST(season_id = {v} AS INTEGER) AS season_id_{v}" for v in (1, 2, 3, 4)) + " FROM days", DY)
def q_one_hot(spark, sf):
    return FE.one_hot(days(spark, sf).select("date", "season_id"), "season_id", [1, 2, 3, 4])


@query("seasonal_index", f"""
SELECT date, CAST(weekofyear(date) AS INTEGER) AS week_of_year,
  {s(f'sin({TWO_PI} * weekofyear(date) / 52.0)', 9)} AS week_sin, {s(f'cos({TWO_PI} * weekofyear(date) / 52.0)', 9)} AS week_cos,
  {s(f'sin({TWO_PI} * dayofmonth(date) / 31.0)', 9)} AS day_in_month_sin, {s(f'cos({TWO_PI} * dayofmonth(date) / 31.0)', 9)} AS day_in_month_cos,
  {s(f'sin({TWO_PI} * weekofyear(date) / 52.0) + sin({TWO_PI} * weekday / 7.0) + sin({TWO_PI} * dayofmonth(date) / 31.0)', 9)} AS seasonal_index
FROM days""", DY)
def q_seasonal_index(spark, sf):
    out = FE.seasonal_index(days(spark, sf))
    cols = ["week_sin", "week_cos", "day_in_month_sin", "day_in_month_cos", "seasonal_index"]
    return out.select("date", "week_of_year", *[r(c, 9) for c in cols])
