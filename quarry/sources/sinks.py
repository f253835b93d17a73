"""Sinks (A5, A6, A8, A11): distributed writers, nothing passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """A5: one folder per report, header, overwrite."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def load_summary(df: DataFrame, path: str, id_column: str | None = None, partition_by: list[str] | None = None) -> None:
    """Replace a keyed summary table, the key column renamed to ``_id``
    (the reference's store convention); written by the executors."""
    out = df.withColumnRenamed(id_column, "_id") if id_column else df
    writer = out.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_predictions(df: DataFrame, path: str, id_col: str = "id", value_col: str = "prediction",
                      header: str = "Label") -> None:
    """(id, value) export as CSV."""
    write_report(df.select(F.col(id_col).alias("id"), F.col(value_col).alias(header)), path)


def console(df: DataFrame, checkpoint: str, mode: str = "append", trigger: dict | None = None):
    """Console sink for a stream (debugging)."""
    return (df.writeStream.format("console").outputMode(mode).option("checkpointLocation", checkpoint)
            .option("truncate", False).trigger(**(trigger or {"availableNow": True})).start())


def topic_sink(df: DataFrame, servers: str, topic: str, checkpoint: str, trigger: dict | None = None):
    """A stream of (key, value) records to a topic (Spark's Kafka sink;
    its package must be on the classpath). ``checkpoint`` is mandatory: the
    reference's topic writers had none, so a restart re-sent everything."""
    return (df.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
            .writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "20 seconds"})).start())
