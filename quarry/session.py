"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every quarry job relies on: UTC wall clock (event times are stored
# as timestamp_ntz and must not shift), adaptive execution, no UI server.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.forceDeleteTempCheckpointLocation": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "quarry",
    shuffle_partitions: int = 8,
    conf: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with quarry's base configuration.

    ``master`` defaults to ``local[$QUARRY_CPUS or 8]``; on a cluster pass
    ``None`` via spark-submit and the master from the launcher wins.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is None:
        master = os.environ.get("QUARRY_MASTER", f"local[{os.environ.get('QUARRY_CPUS', '8')}]")
    if master:  # "" leaves the master to spark-submit
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.setdefault("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "8g"))
    if conf:
        settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` (what a cluster sets to shared storage).
    Only in local mode, where all tasks share the machine's disk, an unset
    folder is replaced by a fresh one under the system temp directory; on a
    cluster it is an error.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)  # named in the conf but not yet registered
        return current.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="quarry-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its own file system; a failing store raises."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique sub-path of the checkpoint folder for one job's output."""
    import uuid

    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df, tag: str, partition_by: tuple[str, ...] = ()):
    """(``df`` written as Parquet into the checkpoint folder and read back, its path): lineage ends at files that every executor can read."""
    path = scratch_path(df.sparkSession, tag)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a table of ``written`` that no step reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def cut_lineage(df):
    """Reliable checkpoint of ``df`` into the shared checkpoint folder.

    A reliable checkpoint writes the data in a second job after the first
    action; persisting first lets that job read the blocks instead of
    recomputing the whole plan. The cache is dropped once the checkpoint
    files exist (they, not executor memory, back the returned DataFrame, so
    it survives executor loss).
    """
    from pyspark import StorageLevel

    checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out
