"""Training-data pipeline over ``documents``: five stages of ``quarry.llm``, each written as Parquet and read again.

While a stage runs, Arrow batches hold at most ``BATCH_BYTES``: a Python worker
then holds a few batches of texts instead of a few times the session's limit
(64 MB by default), which is what an executor with several workers has to pay.

Defined results: null texts are empty; an empty table passes as an empty table;
repeated rows count as near duplicates of each other; every other column is
carried along unchanged, whatever its name; all stages but the last return the
columns of their input, the last adds ``slot`` and ``shard``.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from quarry.llm.common import saved, table
from quarry.llm.decontaminate import decontaminate
from quarry.llm.jaccard import keep_one
from quarry.llm.mixing import mixed
from quarry.llm.quality import keep_good
from quarry.llm.sharding import assign_shards


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Importance resampling towards good labelled texts; rejected documents go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"), mode="document")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their target weights: documents repeat or stay out."""
    return mixed(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets its slot and shard."""
    return assign_shards(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: The first stage fits a model on hashed n-grams, which SQL does not express; the stages are tested one by one.
ORACLE_SQL = None


BATCH_BYTES = 4 << 20
_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """The session's Arrow batches hold at most BATCH_BYTES until the end."""
    before = spark.conf.get(_LIMIT)
    spark.conf.set(_LIMIT, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_LIMIT, before)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with small_batches(spark):
        for name, stage in STAGES[:-1]:
            docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
