"""The registered queries: one per operator, over its whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import sql
from quarry.llm.common import table


def op1_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.brown import score

    return score(table(spark, sf_dir, "documents"))


def op2_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.embeddings import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.quality import resample

    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.licenses import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"))


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.jaccard import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.langid import identify

    return identify(table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.sharding import assign_shards

    return assign_shards(table(spark, sf_dir, "documents").select("doc_id", "source", "lang"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.mixing import mix_documents

    return mix_documents(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.decontaminate import contamination

    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.rules import BASE, apply_rules

    return apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select("doc_id", *BASE, "base_failed", "kept", "score")


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.repair import repair_damaged

    return repair_damaged(table(spark, sf_dir, "conversations"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.negatives import hard_negatives

    return hard_negatives(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_brown, op2_embeddings, op3_quality, op4_licenses, op5_jaccard, op6_toxicity, op7_language, op8_sharding, op9_mixing, op10_decontamination, op11_quality_rules, op12_conversations, op13_hard_negatives)
}

ORACLES: dict[str, str] = {"op8_sharding": sql.sharding(), "op9_mixing": sql.mixing(), "op10_decontamination": sql.decontamination(), "op12_conversations": sql.conversations(), "op13_hard_negatives": sql.hard_negatives()}
