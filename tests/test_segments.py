"""Topics of the registered streams are cut so that a batch has work for all cores."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from orderstream.plans import catalog
from orderstream.sinks.messages import publish
from orderstream.sources.messages import segment_count
from orderstream.streaming import jobs

ORDERS = 640_000


@pytest.fixture(scope="module")
def many_orders(spark, tmp_path_factory):
    """A folder of tables with enough orders for segments of more than the least size."""
    folder = str(tmp_path_factory.mktemp("many"))
    orders = spark.range(ORDERS).select(
        F.col("id").alias("o_orderkey"),
        (F.col("id") * 7919 % 100_003).alias("o_custkey"),
        F.element_at(F.array(F.lit("O"), F.lit("P"), F.lit("F")), (F.col("id") % 3 + 1).cast("int"))
        .alias("o_orderstatus"),
        (F.col("id") % 1000 / 4).alias("o_totalprice"),
        F.timestamp_seconds(F.lit(800_000_000) + F.col("id")).alias("o_orderdate"),
    )
    orders.write.parquet(f"{folder}/orders.parquet")
    nations = spark.range(25).select(
        F.col("id").alias("n_nationkey"), F.concat(F.lit("N"), F.col("id").cast("string")).alias("n_name")
    )
    nations.write.parquet(f"{folder}/nation.parquet")
    return folder


def test_a_batch_of_orders_has_a_segment_for_every_core(spark, many_orders):
    settings = catalog._stream(spark, many_orders, "segments")
    segments = segment_count(spark, settings, settings.source_topic)
    assert settings.max_files_per_trigger >= spark.sparkContext.defaultParallelism
    assert segments >= 4 * settings.max_files_per_trigger


@pytest.mark.parametrize("count", [0, 1, 7, 8, 1500, 150_000])
def test_small_topics_keep_their_eight_segments(spark, count):
    size = catalog._segment_size(spark, count)
    assert 1 <= size <= max(count // 8, 1)
    assert size == max(count // 8, 1) or size >= 10_000


def test_large_topics_have_segments_of_bounded_size(spark):
    assert catalog._segment_size(spark, 10**12) == 1_000_000


def test_reports_read_the_etl_topic_in_batches_of_its_own_segments(spark, many_orders, monkeypatch):
    started = []
    start = jobs.start_report

    def noted(spark, settings, report, rows):
        started.append((settings, start(spark, settings, report, rows)))
        return started[-1][1]

    monkeypatch.setattr(jobs, "start_report", noted)
    catalog.s_two_jobs(spark, many_orders)
    for settings, query in started:
        segments = segment_count(spark, settings, settings.etl_topic)
        assert settings.max_files_per_trigger == segments // 4
        read = [step["numInputRows"] for step in query.recentProgress if step["numInputRows"]]
        assert sum(read) == ORDERS and len(read) >= 4


def test_each_arrival_has_a_segment_for_every_core_per_batch(spark, many_orders):
    read = 0
    for settings, _ in catalog._arriving(spark, many_orders, "arriving", F.col("partition") == 0):
        segments = segment_count(spark, settings, settings.etl_topic)
        assert settings.max_files_per_trigger >= spark.sparkContext.defaultParallelism
        assert settings.max_files_per_trigger == (segments - read) // 4
        read = segments


def test_both_state_stores_read_one_topic_and_keep_the_same_sums(spark, many_orders, monkeypatch):
    published = []

    def noted(messages, settings, topic, size):
        published.append(topic)
        publish(messages, settings, topic, size)

    monkeypatch.setattr(catalog, "publish", noted)
    rows = catalog.s_state_read_back(spark, many_orders).collect()
    assert len(published) == 2
    by_store = {
        store: {row.city: row.in_state for row in rows if row.store == store} for store in ("default", "rocksdb")
    }
    assert by_store["default"] == by_store["rocksdb"]
    assert all(row.in_state == row.stored for row in rows)
    assert sum(by_store["default"].values()) == sum(i % 1000 / 4 for i in range(ORDERS))
