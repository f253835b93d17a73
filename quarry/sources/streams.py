"""Stream sources (A2, A4) and the static side of stream-static joins (A3).

Topics are read with Spark's Kafka source when its package is on the
classpath; tests and local runs use the file source over parquet with the
same downstream functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.sources.fixtures import transactions_from_events


def read_topic(spark: SparkSession, servers: str, topic: str, starting: str = "earliest") -> DataFrame:
    """A2: a topic as a stream of (key, value, timestamp, ...) records.

    Earliest offsets and ``failOnDataLoss=false`` as in the reference.
    Requires the spark-sql-kafka package (not bundled).
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", "false")
        .load()
    )


def drain_topic(spark: SparkSession, servers: str, topic: str, ending: str = "latest") -> DataFrame:
    """A4: a bounded batch read of a topic (earliest to ``ending`` offsets)."""
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("endingOffsets", ending)
        .option("failOnDataLoss", "false")
        .load()
    )


def event_file_stream(spark: SparkSession, directory: str, glob: str = "*.parquet",
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Events (driver-table schema) from the parquet files of ``directory``
    matching ``glob``, as a stream flattened to transactions.

    The file source takes files in the order of their modification times. With
    ``max_files_per_trigger`` files of equal times may come in any order, and
    then rows of a file read after a later one can fall behind the watermark."""
    directory = directory.rstrip("/")
    schema = spark.read.option("pathGlobFilter", glob).parquet(directory).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return transactions_from_events(reader.parquet(directory))


def read_summary(spark: SparkSession, path: str, key: str, value_cols: list[str], fmt: str = "parquet") -> DataFrame:
    """A3: a keyed summary table as the static side of a stream-static join."""
    return spark.read.format(fmt).load(path).select(key, *value_cols)
