"""Streams give what the batch query gives, also after a stop, a replay or a late row."""

from __future__ import annotations

import datetime
import os
import re
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from orderstream import session
from orderstream.config import Settings
from orderstream.operators import counts, geo, reports
from orderstream.operators import messages as msg
from orderstream.operators.etl import order_etl
from orderstream.plans import catalog, tables
from orderstream.sinks import fields, hashes
from orderstream.sinks.messages import publish
from orderstream.sources import messages as messages_source
from orderstream.sources.messages import read_messages
from orderstream.streaming import batches, control, jobs, state

SCHEMA = "value STRING, timestamp TIMESTAMP, partition INT, offset BIGINT"
START = datetime.datetime(2024, 11, 6)


@pytest.fixture
def settings(tmp_path):
    return Settings(
        source_format="files",
        topic_root=str(tmp_path / "topics"),
        checkpoint_root=str(tmp_path / "checkpoints"),
        store_path=str(tmp_path / "store"),
        key_cities=("A", "B"),
        max_files_per_trigger=1,
        trigger={"availableNow": True},
    )


def post(spark, settings, rows, topic="orderEtlTopic"):
    """One segment of ETL messages: (position, money, province, city)."""
    made = [
        (f'{{"orderMoney":"{money}","province":"{province}","city":"{city}"}}',
         START + datetime.timedelta(seconds=at), 0, at)
        for at, money, province, city in rows
    ]
    publish(spark.createDataFrame(made, SCHEMA).coalesce(1), settings, topic)


def report(spark, settings, which):
    rows = msg.report_rows(read_messages(spark, settings, settings.etl_topic), msg.POSITION)
    query = jobs.start_report(spark, settings, which, rows)
    query.awaitTermination()
    return query


def amounts(df):
    return {row[0]: row[1] for row in df.collect()}


def test_update_batches_hold_changed_groups_only(spark, settings):
    post(spark, settings, [(1, "4", "P", "A"), (2, "1.5", "P", "B")])
    report(spark, settings, jobs.CITY)
    post(spark, settings, [(3, "1.25", "P", "A")])
    query = report(spark, settings, jobs.CITY)
    written = hashes.written(spark, settings.store_path).where(F.col("run") == str(query.id))
    batches = written.select("batch", "field", "value").collect()
    assert sorted(tuple(b) for b in batches) == [(0, "A", "4.0"), (0, "B", "1.5"), (1, "A", "5.25")]
    assert amounts(jobs.stored_city_amounts(spark, settings.store_path)) == {"A": 5.25, "B": 1.5}


def test_total_goes_on_after_a_restart(spark, settings):
    post(spark, settings, [(1, "4", "P", "A")])
    report(spark, settings, jobs.TOTAL)
    assert jobs.stored_total(spark, settings.store_path).first().total_amt == 4.0
    post(spark, settings, [(2, "4", "P", "A"), (3, "abc", "P", "A")])
    report(spark, settings, jobs.TOTAL)
    assert jobs.stored_total(spark, settings.store_path).first().total_amt == 8.0


def test_an_uncommitted_batch_is_run_again_with_the_same_result(spark, settings):
    post(spark, settings, [(1, "4", "P", "A")])
    post(spark, settings, [(2, "3", "Q", "B")])
    report(spark, settings, jobs.PROVINCE)
    before = amounts(jobs.stored_amounts(spark, settings.store_path, jobs.PROVINCE))
    drop_last_commit(settings.checkpoint(jobs.PROVINCE.name))
    report(spark, settings, jobs.PROVINCE)
    assert amounts(jobs.stored_amounts(spark, settings.store_path, jobs.PROVINCE)) == before
    assert before == {"P": 4.0, "Q": 3.0}


def test_latest_row_ignores_late_older_rows(spark, settings):
    post(spark, settings, [(5, "50", "P", "A"), (6, "1", "P", "C")])
    report(spark, settings, jobs.KEY_CITY_LATEST)
    post(spark, settings, [(3, "30", "Q", "A"), (4, "40", "Q", "B")])
    report(spark, settings, jobs.KEY_CITY_LATEST)
    stored = jobs.stored_cities(spark, settings.store_path).collect()
    assert sorted(tuple(r) for r in stored) == [("A", "50.0", "P"), ("B", "40.0", "Q")]


def test_late_rows_add_to_the_sums(spark, settings):
    post(spark, settings, [(5, "50", "P", "A")])
    post(spark, settings, [(3, "30", "P", "A"), (1, "2", "P", "C")])
    report(spark, settings, jobs.KEY_CITY_AMOUNT)
    assert amounts(jobs.stored_amounts(spark, settings.store_path, jobs.KEY_CITY_AMOUNT)) == {"A": 80.0}


def sums(spark, settings):
    messages = read_messages(spark, settings, settings.etl_topic)
    query = jobs.start_sums(spark, settings, msg.report_rows(messages, msg.POSITION))
    query.awaitTermination()
    return query


def stored_sums(spark, settings):
    stored = hashes.read_hashes(spark, settings.store_path).collect()
    return {(r.key, r.field): r.value for r in stored}


def drop_last_commit(folder):
    """As if the query had stopped after storing its last batch, before noting so."""
    newest = max(int(name) for name in os.listdir(f"{folder}/commits") if name.isdigit())
    for name in (f"{newest}", f".{newest}.crc"):
        if os.path.exists(f"{folder}/commits/{name}"):
            os.remove(f"{folder}/commits/{name}")


def test_sums_together_store_what_single_reports_store(spark, settings, tmp_path):
    batches = [
        [(1, "4.10", "P", "A"), (2, "1.5", "P", "B"), (3, "0.015", "Q", "C")],
        [(4, "0.20", "P", "A"), (5, "abc", "R", "D"), (6, "7", "Q", "A")],
        [(7, "1e20", "Q", "C"), (8, "2", "P", "B")],
    ]
    single = replace(
        settings, store_path=str(tmp_path / "single"), checkpoint_root=str(tmp_path / "single-ckpt")
    )
    for rows in batches:
        post(spark, settings, rows)
        sums(spark, settings)
        for which in jobs.SUMS:
            report(spark, single, which)
        assert stored_sums(spark, settings) == stored_sums(spark, single)
    before = stored_sums(spark, settings)
    assert before[("orders:citymoney:global", "A")] == "11.3"
    drop_last_commit(settings.checkpoint(jobs.PLACES_QUERY))
    sums(spark, settings)
    assert stored_sums(spark, settings) == before


@pytest.mark.parametrize("long_list", [0, 1000])
def test_place_fields_are_the_fields_of_all_reports(spark, settings, monkeypatch, long_list):
    """Also for missing names, names that read ``null``, odd amounts and no rows at all."""
    monkeypatch.setattr(reports, "LONG_LIST", long_list)
    chosen = replace(settings, key_cities=("A", "null", "A.b", "none"))
    rows = [
        (1.25, "P", "A"), (1e20, "P", "A"), (-1e20, "Q", "A"), (0.005, None, "null"), (2.0, "null", None),
        (float("inf"), "R", "A.b"), (None, "S", "C"), (3.0, "", ""), (1e-300, "Q", "null"),
    ]
    for some in (rows, rows[6:7], []):
        places = reports.amt_by_place(
            spark.createDataFrame(some, "money DOUBLE, province STRING, city STRING")
        )
        found = sorted(tuple(r) for r in jobs.place_fields(places, chosen).collect())
        single = [r for which in jobs.SUMS for r in which.fields(which.stream(places, chosen), chosen).collect()]
        assert found == sorted(tuple(r) for r in single)


def test_a_batch_of_all_sums_reads_its_state_once(spark, settings):
    post(spark, settings, [(i, "2", "P", f"city {i % 7}") for i in range(50)])
    assert sums(spark, settings).lastProgress["stateOperators"][0]["numRowsTotal"] == 7


def test_sums_together_start_over_on_a_new_checkpoint(spark, settings, tmp_path):
    post(spark, settings, [(1, "4", "P", "A")])
    sums(spark, settings)
    again = replace(settings, checkpoint_root=str(tmp_path / "new"))
    sums(spark, again)
    assert jobs.stored_total(spark, settings.store_path).first().total_amt == 4.0


def test_missing_places_are_summed_together_too(spark, settings):
    lines = [('{"orderMoney":"4"}', START, 0, 1), ('{"orderMoney":"1","province":"P"}', START, 0, 2)]
    publish(spark.createDataFrame(lines, SCHEMA), settings, settings.etl_topic)
    sums(spark, settings)
    assert jobs.stored_total(spark, settings.store_path).first().total_amt == 5.0
    assert amounts(jobs.stored_city_amounts(spark, settings.store_path)) == {None: 5.0}
    provinces = amounts(jobs.stored_amounts(spark, settings.store_path, jobs.PROVINCE))
    assert provinces == {None: 4.0, "P": 1.0}


def test_chart_skips_the_hash_of_city_sums(spark, settings):
    post(spark, settings, [(1, "4", "P", "A"), (2, "5", "Q", "B"), (3, "6", "Q", "Z")])
    report(spark, settings, jobs.CITY)
    report(spark, settings, jobs.KEY_CITY_LATEST)
    keys = {r.key for r in hashes.read_hashes(spark, settings.store_path, "orders:citymoney:").collect()}
    assert keys == {"orders:citymoney:global", "orders:citymoney:A", "orders:citymoney:B"}
    provinces = {r.province for r in jobs.stored_cities(spark, settings.store_path).collect()}
    assert provinces == {"P", "Q"}


def test_a_city_called_like_the_hash_of_sums(spark, settings):
    named = replace(settings, key_cities=("A", "globalville", "global"))
    post(spark, named, [(1, "4", "P", "A"), (2, "7", "Q", "globalville"), (3, "1", "R", "global")])
    report(spark, named, jobs.CITY)
    report(spark, named, jobs.KEY_CITY_LATEST)
    expected = {"A": 4.0, "globalville": 7.0, "global": 1.0}
    assert amounts(jobs.stored_city_amounts(spark, named.store_path)) == expected
    cities = jobs.stored_cities(spark, named.store_path).collect()
    assert {r.city: float(r.money) for r in cities} == expected


def test_the_latest_row_may_lack_a_province(spark, settings):
    post(spark, settings, [(1, "4", "P", "A")])
    report(spark, settings, jobs.KEY_CITY_LATEST)
    line = [('{"orderMoney":"5","city":"A"}', START + datetime.timedelta(seconds=9), 0, 9)]
    publish(spark.createDataFrame(line, SCHEMA), settings, settings.etl_topic)
    report(spark, settings, jobs.KEY_CITY_LATEST)
    stored = jobs.stored_cities(spark, settings.store_path).collect()
    assert [tuple(r) for r in stored] == [("A", "5.0", None)]


def test_sums_of_sums_are_exact(spark):
    """Huge totals, and cents that doubles cannot tell apart once they are added up."""
    rows = [(9_000_000_000_000.01 - i, f"P{i % 7}", f"C{i % 40}") for i in range(2000)]
    rows += [(None, "P0", "C0"), (None, None, None)]
    frame = spark.createDataFrame(rows, "money DOUBLE, province STRING, city STRING")
    places = reports.amt_by_place(frame)
    for which in (reports.amt_total, reports.amt_by_province, reports.amt_by_city):
        assert {tuple(r) for r in which(places).collect()} == {tuple(r) for r in which(frame).collect()}


def test_a_batch_is_not_published_behind_a_stream(spark, sf_dir, settings):
    index = geo.build_index(split(spark, sf_dir))
    messages = tables.order_messages(spark, sf_dir)
    publish(messages, settings, settings.source_topic, 500)
    jobs.start_etl(spark, settings, index).awaitTermination()
    with pytest.raises(ValueError, match="belongs to a stream"):
        publish(messages, settings, settings.etl_topic)


def test_a_batch_needs_a_query(spark):
    with pytest.raises(RuntimeError, match="streaming query"):
        jobs._run(spark)


def test_every_batch_is_in_the_table(spark, settings, tmp_path):
    """More batches than the progress reports keep, also those of a query started again."""
    table = str(tmp_path / "batches")
    assert batches.read_batches(spark, table).collect() == []
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        with batches.batch_table(spark, table) as log:
            for at in range(8):
                post(spark, settings, [(at, "1", "P", "A"), (at + 100, "1", "P", "B")])
            log.wait(report(spark, settings, jobs.CITY))
            drop_last_commit(settings.checkpoint(jobs.CITY.name))
            post(spark, settings, [(50, "1", "P", "A")])
            log.wait(report(spark, settings, jobs.CITY))
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    rows = batches.read_batches(spark, table).orderBy("batch_id").collect()
    assert [(r.query, r.batch_id, r.input_rows) for r in rows] == [
        (jobs.CITY.name, at, 2 if at < 8 else 1) for at in range(9)
    ]
    assert rows[0].state_rows == 2 and rows[0].batch_ms > 0
    assert spark.read.parquet(table).count() == 10
    # Nothing is written once the table is closed.
    post(spark, settings, [(60, "1", "P", "A")])
    report(spark, settings, jobs.CITY)
    assert spark.read.parquet(table).count() == 10


def test_jobs_note_their_batches_and_counts(spark, sf_dir, settings, tmp_path):
    noted = replace(
        settings, batch_table=str(tmp_path / "batches"), region_path=str(tmp_path / "ranges"),
        max_files_per_trigger=2,
    )
    tables.region_ranges(spark, sf_dir).write.parquet(noted.region_path)
    messages = tables.mixed_messages(spark, sf_dir)
    publish(messages, noted, noted.source_topic, 500)
    jobs.run_etl(spark, noted)
    jobs.run_reports(spark, noted, sums_together=True)
    rows = batches.read_batches(spark, noted.batch_table)
    assert {r.query for r in rows.collect()} == {jobs.ETL_QUERY, jobs.PLACES_QUERY, jobs.KEY_CITY_LATEST.name}
    expected = tuple(catalog.etl_counts(spark, sf_dir).first())
    assert tuple(batches.observed_sums(rows, *counts.ALL).first()) == expected


def test_a_topic_may_start_at_its_end(spark, settings):
    latest = replace(settings, file_start="latest")
    post(spark, latest, [(1, "4", "P", "A")])
    report(spark, latest, jobs.TOTAL)
    time.sleep(0.01)
    for at in (2, 3):
        post(spark, latest, [(at, "10", "P", "A")])
        report(spark, latest, jobs.TOTAL)
    assert jobs.stored_total(spark, latest.store_path).first().total_amt == 20.0


def test_a_cap_of_messages_holds_for_file_topics(spark, settings):
    capped = replace(settings, max_files_per_trigger=None, max_offsets_per_trigger=5)
    for at in range(0, 14, 2):
        post(spark, capped, [(at, "1", "P", "A"), (at + 1, "1", "P", "A")])
    query = report(spark, capped, jobs.TOTAL)
    read = [step["numInputRows"] for step in query.recentProgress if step["numInputRows"]]
    assert read == [4, 4, 4, 2]
    # A segment is never cut.
    assert messages_source.files_per_batch(spark, replace(capped, max_offsets_per_trigger=1), capped.etl_topic) == 1


@pytest.mark.parametrize("store", ["default", "rocksdb"])
def test_sums_go_on_in_another_number_of_stores(spark, settings, tmp_path, store):
    old = replace(settings, state_store=store)
    rows = [(at, f"{at}.25", f"P{at % 3}", f"C{at % 7}") for at in range(1, 40)]
    post(spark, old, [*rows, (99, "0.001", "P1", "C1"), (98, "abc", "P9", "C9")])
    sums(spark, old)
    before = stored_sums(spark, old)
    read = messages_source.newest_segment(spark, old, old.etl_topic)
    new = replace(old, state_partitions=9, checkpoint_root=str(tmp_path / "wide"), file_start=read)
    seed = str(tmp_path / "seed")
    with pytest.raises(ValueError, match="checkpoint of its own"):
        state.widen(spark, old, replace(old, state_partitions=9), seed)
    state.widen(spark, old, new, seed)

    def run():
        lines = read_messages(spark, new, new.etl_topic)
        state.start_seeded_sums(spark, new, msg.report_rows(lines, msg.POSITION), seed).awaitTermination()

    run()
    assert stored_sums(spark, new) == before
    time.sleep(0.01)
    post(spark, new, [(200, "1000.5", "P1", "C1"), (201, "7", "PX", "CX")])
    run()
    checkpoint = new.checkpoint(jobs.PLACES_QUERY)
    assert state.state_width(spark, checkpoint) == 9
    assert state.state_width(spark, old.checkpoint(jobs.PLACES_QUERY)) == settings.state_partitions
    everything = replace(
        settings, store_path=str(tmp_path / "all"), checkpoint_root=str(tmp_path / "all-ckpt"), max_files_per_trigger=9
    )
    sums(spark, everything)
    assert stored_sums(spark, new) == stored_sums(spark, everything)
    kept = state.place_sums(spark, new)
    assert {r.city for r in kept.collect()} == {f"C{i}" for i in range(7)} | {"C9", "CX"}


def test_reports_share_the_cores_fairly(spark, settings):
    """Each query's jobs run in a pool of its own; the caller's pool stays as it was."""
    seen = {}

    def note(batch, batch_id):
        context = batch.sparkSession.sparkContext
        seen[context.getLocalProperty("sql.streaming.queryId")] = context.getLocalProperty(control.POOL)

    post(spark, settings, [(1, "4", "P", "A")])
    spark.sparkContext.setLocalProperty(control.POOL, "mine")
    lines = read_messages(spark, settings, settings.etl_topic)
    queries = [
        control.start(spark, lines.writeStream.foreachBatch(note), name, settings) for name in ("one", "two")
    ]
    for query in queries:
        query.awaitTermination()
    assert spark.sparkContext.getLocalProperty(control.POOL) == "mine"
    spark.sparkContext.setLocalProperty(control.POOL, None)
    assert seen == {queries[0].id: "one", queries[1].id: "two"}


def test_reports_go_on_while_one_has_a_long_batch(spark, settings):
    """Forty slow tasks wait for four cores; two other queries run their batches meanwhile."""
    post(spark, settings, [(1, "4", "P", "A")])
    ended = {}

    def slow(batch, batch_id):
        wait = F.expr("reflect('java.util.concurrent.locks.LockSupport', 'parkNanos', 1500000000L)")
        batch.sparkSession.range(0, 40, 1, 40).select(wait).write.format("noop").mode("overwrite").save()
        ended["slow"] = time.monotonic()

    lines = read_messages(spark, settings, settings.etl_topic)
    long = control.start(spark, lines.writeStream.foreachBatch(slow), "slow", settings)
    while not any(job for job in spark.sparkContext.statusTracker().getActiveStageIds()):
        time.sleep(0.02)
    rows = msg.report_rows(lines, msg.POSITION)
    quick = [jobs.start_report(spark, settings, which, rows) for which in (jobs.TOTAL, jobs.KEY_CITY_LATEST)]
    for query in quick:
        query.awaitTermination()
        ended[query.name] = time.monotonic()
    long.awaitTermination()
    assert max(ended, key=ended.get) == "slow"
    assert jobs.stored_total(spark, settings.store_path).first().total_amt == 4.0


def test_file_topics_cap_bytes_and_start_late(spark, settings):
    capped = replace(settings, max_files_per_trigger=None, max_bytes_per_trigger=1)
    for at in range(3):
        post(spark, capped, [(at, "1", "P", "A")])
    query = report(spark, capped, jobs.TOTAL)
    assert len([step for step in query.recentProgress if step["numInputRows"]]) == 3
    late = replace(
        settings, starting_time="2024-11-06T00:00:02Z", store_path=f"{settings.store_path}2",
        checkpoint_root=f"{settings.checkpoint_root}2",
    )
    report(spark, late, jobs.TOTAL)
    assert jobs.stored_total(spark, late.store_path).first().total_amt == 1.0


def test_reports_run_side_by_side_under_their_own_names(spark, settings):
    post(spark, settings, [(1, "4", "P", "A")])
    endless = replace(settings, trigger={"processingTime": "1 second"})
    rows = msg.report_rows(read_messages(spark, endless, endless.etl_topic), msg.POSITION)
    queries = [jobs.start_report(spark, endless, one, rows) for one in jobs.REPORTS]
    try:
        assert len({q.name for q in queries}) == len({q.id for q in queries}) == len(jobs.REPORTS)
        assert all(q.isActive for q in queries)
        with pytest.raises(Exception, match="already"):
            jobs.start_report(spark, endless, jobs.TOTAL, rows)
        for query in queries:
            query.processAllAvailable()
    finally:
        for query in queries:
            control.stop_gracefully(query)
    assert not any(q.isActive for q in queries)
    assert jobs.stored_total(spark, settings.store_path).first().total_amt == 4.0


def test_stop_on_marker(spark, settings, tmp_path):
    post(spark, settings, [(1, "4", "P", "A")])
    marker = str(tmp_path / "stop")
    endless = replace(settings, trigger={"processingTime": "0 seconds"}, stop_state_file=marker)
    rows = msg.report_rows(read_messages(spark, endless, endless.etl_topic), msg.POSITION)
    query = jobs.start_report(spark, endless, jobs.TOTAL, rows)
    query.processAllAvailable()
    assert not session.path_exists(spark, marker)
    os.mkdir(marker)
    control.run_all(spark, [query], marker, poll_seconds=0.2)
    assert not query.isActive


def test_a_busy_query_stops_after_its_batch(spark, settings):
    """Batches follow each other without a pause, yet each one started is committed."""
    for at in range(12):
        post(spark, settings, [(at, "1", "P", "A")])
    endless = replace(settings, trigger={"processingTime": "0 seconds"})
    rows = msg.report_rows(read_messages(spark, endless, endless.etl_topic), msg.POSITION)
    query = jobs.start_report(spark, endless, jobs.TOTAL, rows)
    while query.lastProgress is None:
        query.awaitTermination(0.05)
    control.stop_gracefully(query, grace_seconds=30)
    assert not query.isActive
    report(spark, settings, jobs.TOTAL)
    assert jobs.stored_total(spark, settings.store_path).first().total_amt == 12.0


def test_a_failing_query_is_reported(spark, settings):
    post(spark, settings, [(1, "4", "P", "A")])
    lines = read_messages(spark, settings, settings.etl_topic)
    broken = lines.select(F.raise_error(F.lit("boom")).alias("value"), *msg.POSITION)
    writer = broken.writeStream.format("noop")
    query = control.start(spark, writer, "broken", settings)
    with pytest.raises(Exception, match="boom"):
        control.run_all(spark, [query], poll_seconds=0.2)


def test_state_partitions_and_store_kind(spark, settings):
    post(spark, settings, [(1, "4", "P", "A"), (2, "5", "P", "B")])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    query = report(spark, replace(settings, state_store="rocksdb", state_partitions=2), jobs.CITY)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert query.lastProgress["stateOperators"][0]["numShufflePartitions"] == 2
    folders = os.listdir(f"{settings.checkpoint(jobs.CITY.name)}/state/0")
    assert sorted(name for name in folders if name.isdigit()) == ["0", "1"]
    assert amounts(jobs.stored_city_amounts(spark, settings.store_path)) == {"A": 4.0, "B": 5.0}


def test_progress_rows(spark, settings):
    post(spark, settings, [(1, "4", "P", "A")])
    post(spark, settings, [(2, "4", "P", "A"), (3, "4", "P", "A")])
    query = report(spark, settings, jobs.TOTAL)
    rows = control.progress_rows(spark, [query]).where("input_rows > 0").orderBy("batch_id").collect()
    assert {r.query for r in rows} == {jobs.TOTAL.name}
    assert sorted(r.input_rows for r in rows) == [1, 2]


def test_external_sink_gets_wide_rows(spark, settings, monkeypatch):
    got = []
    monkeypatch.setattr(
        fields, "write_external",
        lambda rows, table, key, _: got.append((table, key, [r.asDict() for r in rows.collect()])),
    )
    external = replace(settings, store_format="my.sink")
    post(spark, settings, [(1, "4", "P", "A"), (2, "5", "P", "C")])
    sums(spark, external)
    assert [(table, key) for table, key, _ in got] == [
        ("orders:money", "type"), ("orders:provincemoney", "province"),
        ("orders:citymoney", "total"), ("orders:keycityamount", "city"),
    ]
    assert got[2][2] == [{"total": "global", "amounts": {"A": 4.0, "C": 5.0}}]
    got.clear()
    for which in (jobs.TOTAL, jobs.CITY, jobs.KEY_CITY_LATEST):
        report(spark, external, which)
    assert got == [
        ("orders:money", "type", [{"global": 9.0, "type": "total"}]),
        ("orders:citymoney", "total", [{"total": "global", "amounts": {"A": 4.0, "C": 5.0}}]),
        ("orders:citymoney", "city", [{"city": "A", "money": 4.0, "province": "P"}]),
    ]


def test_a_stateless_stream_keeps_the_shuffle_width(spark, sf_dir, settings):
    """The shuffled lookup of the ETL runs in as many tasks as the session says."""
    index = geo.build_index(split(spark, sf_dir), -1)
    publish(tables.order_messages(spark, sf_dir), settings, settings.source_topic, 500)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    try:
        query = jobs.start_etl(spark, replace(settings, state_partitions=2), index)
        query.awaitTermination()
        plan = query._jsq.explainInternal(True)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    widths = set(re.findall(r"Exchange hashpartitioning\(.*?, (\d+)\)", plan))
    assert widths == {"11"}


@pytest.mark.parametrize("broadcast_bytes", [1 << 30, -1])
def test_stream_lookup_equals_batch(spark, sf_dir, settings, broadcast_bytes):
    """ETL in several batches, with the dictionary broadcast and shuffled."""
    index = geo.build_index(split(spark, sf_dir), broadcast_bytes).persist()
    messages = tables.order_messages(spark, sf_dir)
    publish(messages, settings, settings.source_topic, 500)
    jobs.start_etl(spark, settings, index).awaitTermination()
    written = read_messages(spark, settings, settings.etl_topic, streaming=False)
    streamed = msg.json_fields(written, msg.ETL_FIELDS)
    batch = order_etl(messages, index)
    assert batch.count() == streamed.count()
    assert batch.exceptAll(streamed).count() == 0
    index.unpersist()


def split(spark, sf_dir):
    return tables.split_regions(tables.region_ranges(spark, sf_dir))


def test_newest_row_survives_hot_city_and_equal_times(spark):
    rows = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, "A").otherwise(F.concat(F.lit("C"), F.col("id") % 50)).alias("city"),
        (F.col("id") / 100).alias("money"),
        F.col("id").cast("string").alias("province"),
        F.timestamp_seconds(F.lit(1000)).alias("timestamp"),
        (F.col("id") % 2).cast("int").alias("partition"),
        F.col("id").alias("offset"),
    )
    newest = {r.city: r.province for r in reports.key_city_latest(rows, None).collect()}
    assert newest["A"] == "19995"
    assert len(newest) == 51
