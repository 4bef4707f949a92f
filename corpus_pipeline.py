"""The corpus pipeline: stages over ``documents``, each stored and read again as the next
one's documents. All stages but the last return the columns of ``documents``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tamarind.llm import decontaminate, near_dedup, packing, quality_rules, toxicity
from tamarind.llm.common import prepared, stored, table

# Similarity of near-duplicates in percent; tests/llm/test_corpus_pipeline.py holds the
# stage against all pairs at this threshold.
NEAR_PERCENT = 80


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that weak supervision does not predict toxic."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie inside the compression bands."""
    prepared(spark)
    return quality_rules.keep_good(docs)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    prepared(spark)
    return near_dedup.keep_one(docs, percent=NEAR_PERCENT)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of the documents that are left, one row per piece."""
    prepared(spark)
    return packing.packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", keep_civil),
    ("quality_rules", keep_good),
    ("near_dedup", keep_distinct),
    ("decontamination", keep_clean),
    ("packing", pack),
]

# A label model, compression ratios, tilings and tokens cannot be expressed in SQL; the
# stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
