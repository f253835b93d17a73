"""Column expressions for calendar parts and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions import vocab as V


def part_of_day(hour: Column) -> Column:
    """Morning 6-11, Afternoon 12-17, Evening 18-23, else Night.

    A ``CASE`` expression instead of a Python UDF: it stays inside whole-stage
    codegen, and a NULL hour gives NULL instead of raising.
    """
    expr = None
    for label, lo, hi in V.DAY_PARTS:
        cond = (hour >= lo) & (hour < hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return F.when(hour.isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise(V.DAY_PART_ELSE))


def calendar_parts(ts: Column) -> dict[str, Column]:
    return {
        "date": F.to_date(ts),
        "hour": F.hour(ts),
        "day_of_week": F.dayofweek(ts),
        "month": F.month(ts),
        "year": F.year(ts),
        "week_of_year": F.weekofyear(ts),
        "day": F.dayofmonth(ts),
        "month_day": F.date_format(ts, "MM-dd"),
    }
