"""Training corpus from raw documents: quality, exact and near copies, mix, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderstream.llm import exact_dedup, mixing, packing, quality, simhash
from orderstream.llm.common import documents, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the limits of their language and source; the others go."""
    return quality.drop_low_quality(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.drop_exact_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates."""
    return simhash.drop_near_duplicates(docs, shingle=4, radius=4)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.repeat_documents(docs)


def length_buckets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, or piece of one, in a batch of its length bucket."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("mixing", source_mix),
    ("packing", length_buckets),
]

# Neither SimHash nor the seeded mix can be written in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each on what its predecessor stored."""
    rows = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        rows = stored(stage(spark, rows, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, rows, sf_dir)
