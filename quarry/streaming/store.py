"""Exactly-once summary store and archive on plain parquet.

A replayed epoch replaces exactly its own rows, so a restart after a failure
never double counts (unlike the reference's additive upserts, quirk Q8).
Plain tables (alerts, the archive) keep a partition ``epoch=<id>`` that is
overwritten; summaries and the archive's keys live in a ``KeyedStore``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from quarry.operators import summary as SU
from quarry.session import path_exists
from quarry.streaming.keyed import KeyedStore


def write_epoch(df: DataFrame, path: str, epoch_id: int, *partitions: str) -> None:
    """foreachBatch sink, idempotent per epoch: a replayed epoch replaces its own rows."""
    # an empty copy keeps the columns for readers that come before the first row
    df.limit(0).write.mode("overwrite").parquet(f"{path}_columns")
    (
        df.withColumn("epoch", F.lit(int(epoch_id)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions, "epoch")
        .parquet(path)
    )


def read_epochs(spark: SparkSession, path: str) -> DataFrame:
    """All rows written so far with their ``epoch``; empty before the first row."""
    columns = spark.read.parquet(f"{path}_columns").schema.add("epoch", IntegerType())
    if not path_exists(spark, path):
        return spark.createDataFrame([], columns)
    return spark.read.schema(columns).parquet(path)


class PartialStore:
    """Windowed partials of a summary, kept in a ``KeyedStore`` by (key, window).

    Every micro-batch adds one entry; after ``compact_after`` of them the touched
    buckets are merged. ``fold(before)`` also adds up the windows that begin
    before a time to one row per key, so the store does not grow with the age
    of the stream; such windows are final (in append mode a window is emitted
    once, in order of the watermark), and a replayed epoch that still holds
    them adds nothing.
    """

    def __init__(self, path: str, key: str, spec: SU.SummarySpec, window_col: str = "window_start", buckets: int = 16, compact_after: int | None = 20):
        self.path, self.key, self.spec, self.window_col, self.compact_after = path, key, spec, window_col, compact_after
        self.rows = KeyedStore(path, [key, window_col], buckets)

    def write(self, partials: DataFrame, epoch_id: int) -> None:
        folded = self.rows.manifest(partials.sparkSession)["note"]
        if folded is not None:
            partials = partials.filter(F.col(self.window_col) >= F.lit(folded).cast(partials.schema[self.window_col].dataType))
        self.rows.upsert(partials, epoch_id, self.compact_after)

    def compact(self, spark: SparkSession) -> int:
        return self.rows.compact(spark)

    def fold(self, spark: SparkSession, before: str) -> None:
        """Adds up all windows that begin before ``before`` (a time as text) per key."""
        def add_up(rows: DataFrame) -> DataFrame:
            old = F.col(self.window_col).isNull() | (F.col(self.window_col) < F.lit(before).cast(rows.schema[self.window_col].dataType))
            none = F.lit(None).cast(rows.schema[self.window_col].dataType).alias(self.window_col)
            sums = rows.filter(old).groupBy(self.key).agg(none, *[F.sum(c).cast(rows.schema[c].dataType).alias(c) for c in self.spec.sums], F.max("epoch").alias("epoch"))
            return rows.filter(~old).unionByName(sums)

        self.rows.compact(spark, add_up, before)

    def latest(self, spark: SparkSession) -> DataFrame:
        """Newest partial per (key, window); a NULL window holds the folded ones."""
        return self.rows.read(spark).drop("epoch")

    def summary(self, spark: SparkSession) -> DataFrame:
        return SU.read_summary(self.latest(spark), self.key, self.spec)


class Archive:
    """Raw archive, insert if absent by key (J8) on every micro-batch.

    A key is archived once, whatever its event time. The keys are kept apart in
    a ``KeyedStore`` with a Bloom filter per bucket: a batch probes the filters
    of its buckets and reads keys only where one may be present, so a batch of
    new keys reads (nearly) no key of the archive. False positives cost a read
    and change nothing. ``lookback_days`` is an opt-in for sources that repeat
    a key only near its own event time: then only the archive dates that the
    batch spans, and that many before, are read. A replayed epoch is checked
    against the other epochs and replaces its own rows; the rows are written
    before their keys, so a batch that died in between is repeated in full.
    """

    def __init__(self, path: str, key: str, time_col: str = "event_time", lookback_days: int | None = None, buckets: int = 64, compact_after: int = 20):
        self.path, self.key, self.time_col, self.lookback, self.compact_after = path, key, time_col, lookback_days, compact_after
        self.keys = KeyedStore(f"{path}_keys", [key], buckets, bloom=True)

    def write(self, batch: DataFrame, epoch_id: int) -> None:
        from quarry.operators.joins import append_new

        spark = batch.sparkSession
        batch = batch.withColumn("date", F.to_date(self.time_col))
        if self.lookback is not None:
            new = batch.dropDuplicates([self.key])
            if path_exists(spark, self.path):
                existing = read_epochs(spark, self.path).filter(F.col("epoch") != int(epoch_id))
                span = batch.agg(F.min("date").alias("lo"), F.max("date").alias("hi")).first()  # one row
                if span["lo"] is not None:
                    existing = existing.filter(F.col("date").between(F.date_sub(F.lit(span["lo"]), self.lookback), F.lit(span["hi"])))
                new = append_new(batch, existing, self.key)
            write_epoch(new, self.path, epoch_id, "date")
            return
        if not self.keys.exists(spark) and path_exists(spark, self.path):  # an archive from before there were keys
            self.keys.upsert(read_epochs(spark, self.path).filter(F.col("epoch") != int(epoch_id)).select(self.key), -1)
        new = append_new(batch, self.keys.known(batch, int(epoch_id)), self.key) if self.keys.exists(spark) else batch.dropDuplicates([self.key])
        write_epoch(new, self.path, epoch_id, "date")
        self.keys.upsert(new.select(self.key), epoch_id, self.compact_after)

    def read(self, spark: SparkSession) -> DataFrame:
        return read_epochs(spark, self.path).drop("epoch", "date")
