"""Registered queries of this subpackage: name -> (spark, folder of the tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderstream.llm import (
    exact_dedup,
    hard_negatives,
    html_text,
    lexical,
    lm_scoring,
    mixing,
    packing,
    pii,
    quality,
    simhash,
    substring_dedup,
    token_output,
    warc,
)
from orderstream.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines and sentences that an earlier one has."""
    return substring_dedup.remove_repeats(documents(spark, sf_dir))


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as packed rows of token ids."""
    return token_output.pack_tokens(documents(spark, sf_dir))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts; the upper half of the ids is the new batch."""
    return exact_dedup.dedup(documents(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality.judge(documents(spark, sf_dir)).drop("lang", "source", "n_lines")


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document."""
    return lm_scoring.score_documents(documents(spark, sf_dir))


def op6_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in a batch of its length bucket."""
    return packing.pack(documents(spark, sf_dir))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under SimHash distance of at most 4."""
    found = simhash.near_duplicates(documents(spark, sf_dir), shingle=4, radius=4)
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and places of personal data in every document."""

    def of_kind(spans: Column, kind: str) -> Column:
        return F.filter(spans, lambda s: s["kind"] == kind)

    def listed(spans: Column) -> Column:
        each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(each, ",")

    found = pii.personal_data(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["base"])
    counts = [F.size(of_kind(base, kind)).cast("bigint").alias(f"n_{kind}") for kind in pii.BASE_KINDS]
    digest = F.sha2(listed(base).cast("binary"), 256)
    return found.select(
        "doc_id", *counts, digest.alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.withColumn("n_chars", F.char_length("text").cast("bigint"))


def op11_hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh has a wrong label."""
    label = F.col("label").cast("bigint")
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives.mine(rows)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return lexical.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as it is read back from the archives written of all pages."""
    index = warc.write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return warc.read_records(index, payloads=False).drop("url")


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_substring_dedup,
        op2_token_output,
        op3_exact_dedup,
        op4_quality_rules,
        op5_lm_scoring,
        op6_length_buckets,
        op7_simhash_near_dedup,
        op8_personal_data,
        op9_mixing,
        op10_html_extraction,
        op11_hard_negative_mining,
        op12_ranked_search,
        op13_warc,
    )
}
