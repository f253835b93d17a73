"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import remove_path, scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: ASCII white space that separates words.
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Cuts the lineage with data that every executor can read again: a lost
    executor costs the tasks it ran, not the steps before.
    """
    return stored(df, tag).rows


class Table(NamedTuple):
    """A table in the shared checkpoint folder that its writer deletes when no step reads it any more."""

    rows: DataFrame
    path: str

    def delete(self) -> None:
        remove_path(self.rows.sparkSession, self.path)


def stored(df: DataFrame, tag: str) -> Table:
    """As ``saved``, for a table that its writer deletes."""
    path = scratch_path(df.sparkSession, f"llm-{tag}")
    df.write.parquet(path)
    return Table(df.sparkSession.read.schema(df.schema).parquet(path), path)


def bucketed(df: DataFrame, tag: str, key: str, buckets: int) -> Table:
    """As ``saved``, bucketed by ``key``: joins on ``key`` of tables with as many buckets shuffle nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{tag}")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    df.write.format("parquet").option("path", path).bucketBy(buckets, key).saveAsTable(name)
    rows = spark.read.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only, not the files
    return Table(rows, path)


@contextmanager
def batches_of(spark: SparkSession, size: int) -> Iterator[None]:
    """Jobs run inside pass Arrow batches of about ``size`` bytes at most."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def private(df: DataFrame, *names: str) -> list[str]:
    """``names`` as column names that ``df`` does not have, whatever the case of its own."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` is the same and faster when all is ASCII."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def hash60(*parts: Column) -> Column:
    """Non-negative 60-bit hash of the parts' text (null: empty); the same rule is one line of SQL elsewhere."""
    joined = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("long")


def fold(doc_id: Column, k: int) -> Column:
    """``crc32(doc_id as text) mod k``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(k)).cast("int")
