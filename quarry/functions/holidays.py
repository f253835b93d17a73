"""A public-holiday calendar generated from date rules, as a DataFrame.

Fixed values (the federal holiday rules used by the reference's holiday
library): New Year's Day 1 Jan; Martin Luther
King Jr. Day third Monday of January; Washington's Birthday third Monday of
February; Memorial Day last Monday of May; Juneteenth 19 Jun from 2021;
Independence Day 4 Jul; Labor Day first Monday of September; Columbus Day
second Monday of October; Veterans Day 11 Nov; Thanksgiving fourth Thursday
of November; Christmas Day 25 Dec. A fixed-date holiday on a Saturday is
also observed on the Friday before, one on a Sunday on the Monday after; the
Friday before New Year's Day lies in the old year.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUNDAY, MONDAY, THURSDAY, SATURDAY = 1, 2, 5, 7  # Spark dayofweek

# (name, month, day) fixed-date rules; (name, month, weekday, n) n-th weekday
# rules (n = -1: last); Juneteenth's first year.
FIXED = [("New Year's Day", 1, 1), ("Juneteenth", 6, 19), ("Independence Day", 7, 4),
         ("Veterans Day", 11, 11), ("Christmas Day", 12, 25)]
NTH = [("Martin Luther King Jr. Day", 1, MONDAY, 3), ("Washington's Birthday", 2, MONDAY, 3),
       ("Memorial Day", 5, MONDAY, -1), ("Labor Day", 9, MONDAY, 1), ("Columbus Day", 10, MONDAY, 2),
       ("Thanksgiving", 11, THURSDAY, 4)]
JUNETEENTH_FROM = 2021


def nth_weekday(year: Column, month: int, weekday: int, n: int) -> Column:
    if n > 0:
        first = F.make_date(year, F.lit(month), F.lit(1))
        offset = (F.lit(weekday) - F.dayofweek(first) + 7) % 7 + 7 * (n - 1)
        return F.date_add(first, offset.cast("int"))
    last = F.last_day(F.make_date(year, F.lit(month), F.lit(1)))
    return F.date_sub(last, ((F.dayofweek(last) - F.lit(weekday) + 7) % 7).cast("int"))


def holiday_calendar(dates: DataFrame, date_col: str = "date", margin: int = 1) -> DataFrame:
    """(date, name) for every year from min(year) - margin to max(year) + margin
    of ``dates``; the year range comes from one global aggregate, the
    expansion is a Spark ``explode`` -- nothing is collected."""
    years = dates.agg(F.min(F.year(date_col)).alias("lo"), F.max(F.year(date_col)).alias("hi")).select(
        F.explode(F.sequence(F.col("lo") - margin, F.col("hi") + margin)).alias("y"))
    rules = []
    for name, month, day in FIXED:
        d = F.make_date(F.col("y"), F.lit(month), F.lit(day))
        if name == "Juneteenth":
            d = F.when(F.col("y") >= JUNETEENTH_FROM, d)
        rules.append(F.struct(d.alias("date"), F.lit(name).alias("name")))
        before = F.make_date(F.col("y") + 1, F.lit(1), F.lit(1)) if (month, day) == (1, 1) else d
        for weekday, first, shift in ((SATURDAY, before, -1), (SUNDAY, d, 1)):
            seen = F.when(F.dayofweek(first) == weekday, F.date_add(first, shift))
            rules.append(F.struct(seen.alias("date"), F.lit(f"{name} (observed)").alias("name")))
    for name, month, weekday, n in NTH:
        rules.append(F.struct(nth_weekday(F.col("y"), month, weekday, n).alias("date"), F.lit(name).alias("name")))
    return years.select(F.explode(F.array(*rules)).alias("h")).select("h.date", "h.name").filter(F.col("date").isNotNull())
