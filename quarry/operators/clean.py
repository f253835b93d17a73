"""Cleaning and column functions.

All are projections, filters, joins or aggregates; nothing is fetched to the
driver, and no job runs while a plan is built but for the tables that number
the tokens of a dictionary (``multi_hot_indices``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.ordered import numbered
from quarry.session import written


def drop_nulls(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in any (or the given) column."""
    return df.na.drop(how="any", subset=subset)


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, null_count, row_count) for every column, one pass."""
    aggs = [F.count(F.lit(1)).alias("__rows")] + [
        F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(df.columns)
    ]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', n_{i}" for i, c in enumerate(df.columns))
    return wide.selectExpr(f"stack({len(df.columns)}, {stack}) AS (column_name, null_count)", "__rows AS row_count")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """B11."""
    return df.select(col).distinct()


def strip_unit(col: Column, unit: str) -> Column:
    """B12: '170cm' -> 170.0; anything that is not a number -> NULL."""
    return F.regexp_replace(F.trim(col), f"\\s*{unit}$", "").try_cast("double")


def map_codes(col: Column, mapping: dict[str, int]) -> Column:
    """Label -> code after trim + lower-case; unknown labels -> NULL."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k.strip().lower()), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), F.lower(F.trim(col)))


def presence_flag(col: Column) -> Column:
    """1 when a value is present, else 0."""
    return col.isNotNull().cast("int")


def tokens(col: Column, sep: str = ",") -> Column:
    """Trimmed, non-empty tokens of a delimited list."""
    return F.filter(F.transform(F.split(col, sep), lambda t: F.trim(t)), lambda t: t != "")


def token_dictionary(df: DataFrame, col: str, sep: str = ",") -> DataFrame:
    """Sorted distinct tokens of a list column (a distributed distinct)."""
    return df.select(F.explode(tokens(F.col(col), sep)).alias("token")).distinct().orderBy("token")


def multi_hot_indices(df: DataFrame, col: str, out: str = "indices", sep: str = ",") -> DataFrame:
    """B16 for a dictionary of any size: each row's sorted token positions.

    Tokens are numbered from 0 in sorted order. The numbers come from a range
    partition of the distinct tokens (rows counted per partition, offsets
    added), and reach the rows by a join, so no dictionary is held anywhere as
    a whole. A row without tokens has an empty array.
    """
    words = df.select(F.explode(F.array_distinct(tokens(F.col(col), sep))).alias("token")).distinct()
    codes = numbered(words, [F.col("token").asc()], "tokens", out="__k")
    keyed, _ = written(df.withColumn("__id", F.monotonically_increasing_id()), "token-rows")
    toks = F.array_distinct(tokens(F.col(col), sep))
    got = keyed.select("__id", F.explode(toks).alias("token")).join(codes, "token").groupBy("__id").agg(F.array_sort(F.collect_set("__k")).alias("__codes"))
    return keyed.join(got, "__id", "left").select(*df.columns, F.coalesce("__codes", F.array().cast("array<bigint>")).alias(out))


def multi_hot(df: DataFrame, col: str, dictionary: list[str], prefix: str, sep: str = ",") -> DataFrame:
    """One 0/1 column per token of the caller's dictionary, all in a single projection."""
    toks = tokens(F.col(col), sep)
    flags = [
        F.coalesce(F.array_contains(toks, t).cast("int"), F.lit(0)).alias(f"{prefix}{t}") for t in dictionary
    ]
    return df.select(*df.columns, *flags)


def token_count(col: Column, sep: str = ",") -> Column:
    """Number of tokens; 0 for NULL or empty."""
    return F.coalesce(F.size(tokens(col, sep)), F.lit(0))


def days_between(later: Column, earlier: Column) -> Column:
    """Whole days from ``earlier`` to ``later``."""
    return F.datediff(later, earlier)


def whole_years(days: Column) -> Column:
    """Days // 365 with floor semantics (negative gaps round down)."""
    return F.floor(days / 365).cast("int")


def ratio_feature(weight: Column, height_cm: Column) -> Column:
    """Weight / (height in metres)^2, NULL when height is 0 or NULL."""
    return F.try_divide(weight, F.pow(height_cm / 100, 2))


def minmax_scale(df: DataFrame, col: str, lo: float = 0.0, hi: float = 1.0, out: str | None = None) -> DataFrame:
    """Map ``col`` linearly onto [lo, hi] (a constant column to lo).

    Min and max are scalar subqueries: nothing runs while the plan is built,
    and there is no join and no single-partition window.
    """
    ends = df.agg(F.min(col).alias("mn"), F.max(col).alias("mx"))
    mn, mx = ends.select("mn").scalar(), ends.select("mx").scalar()
    scaled = F.try_divide(F.col(col) - mn, (mx - mn).cast("double")) * F.lit(hi - lo) + F.lit(lo)
    return df.withColumn(out or f"{col}_scaled", F.when(mn == mx, F.lit(float(lo))).otherwise(scaled).cast("double"))
