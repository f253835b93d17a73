"""Scans of the input tables (parquet) and of CSV files with a fixed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan of one input table; Catalyst prunes columns and pushes filters."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_table(spark: SparkSession, path: str, schema: StructType, header: bool = True) -> DataFrame:
    """CSV scan with an explicit schema (A1).

    No inference pass over the data, and a missing value arrives as a real
    NULL -- never as the text "NaN" (quirk Q2 of the reference).
    """
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .option("nanValue", "NaN")
        .csv(path)
    )
