"""Registry of named queries: key -> (callable(spark, sf_dir) -> DataFrame, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from quarry.plans.views import with_views

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def as_input_time(df):
    """Event times are stored as timestamp_ntz in the input tables and are
    processed as UTC timestamps (watermarks need that type); results hand
    them back in the input's type, so they compare with SQL engines' naive
    TIMESTAMP as they are."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import TimestampType

    if not any(isinstance(f.dataType, TimestampType) for f in df.schema.fields):
        return df
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ])


def query(key: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register ``fn(spark, sf_dir)`` under ``key`` with its DuckDB oracle."""

    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")

        def run(spark, sf_dir):
            return as_input_time(fn(spark, sf_dir))

        run.__name__, run.__doc__, run.__wrapped__ = fn.__name__, fn.__doc__, fn
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = with_views(sql, *views) if views else sql
        return fn

    return deco


def load_all() -> None:
    """Import every plan module so their ``@query`` decorators run."""
    from quarry.plans import cleaning, features, fraud, graph, ingest, learn, payments, stats, streams  # noqa: F401
