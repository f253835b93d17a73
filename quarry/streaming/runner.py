"""Start streaming queries with a mandatory checkpoint (D14-D16) and bring
their results back as DataFrames.

Output and checkpoints live under the session's shared checkpoint folder
(``spark.checkpoint.dir``), never in a machine-local temp folder on a cluster.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quarry.session import scratch_path


def start(
    df: DataFrame,
    checkpoint: str,
    mode: str = "append",
    sink: str | Callable | None = None,
    output: str | None = None,
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start ``df`` with a checkpoint (required). ``sink`` is a format name
    (parquet files at ``output``) or a foreachBatch callable."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    if callable(sink):
        return writer.foreachBatch(sink).start()
    return writer.format(sink or "parquet").option("path", output).start()


def run_to_table(spark: SparkSession, df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream to completion over the available input (availableNow) into
    parquet files, then read the files back."""
    out, ckpt = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    if mode == "complete":
        # File sinks take append only; a complete result is rewritten per epoch.
        sink = lambda batch, epoch: batch.write.mode("overwrite").parquet(out)
        q = start(df, ckpt, mode, sink)
    else:
        q = start(df, ckpt, mode, "parquet", out)
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(out) if mode != "complete" else spark.read.parquet(out)


def run_foreach(spark: SparkSession, df: DataFrame, name: str, fn: Callable, mode: str = "append") -> None:
    """Run a stream to completion with a foreachBatch callback."""
    q = start(df, scratch_path(spark, f"{name}-ckpt"), mode, fn)
    q.awaitTermination()


def await_any(spark: SparkSession, timeout: float | None = None) -> bool:
    """Several queries in one session; block until one ends."""
    return spark.streams.awaitAnyTermination(timeout) if timeout else spark.streams.awaitAnyTermination()
