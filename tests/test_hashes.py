"""The keyed hash store."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from orderstream.functions import read_name
from orderstream.operators import dashboard, reports
from orderstream.sinks import fields as as_fields
from orderstream.sinks import hashes


@pytest.fixture
def store(tmp_path):
    return str(tmp_path / "store")


def latest(spark, store, prefix=""):
    return {(r.key, r.field): r.value for r in hashes.read_hashes(spark, store, prefix).collect()}


def fields(spark, rows, table="t", key="k", schema="k STRING, a DOUBLE, b STRING"):
    return as_fields.hash_fields(spark.createDataFrame(rows, schema), table, key)


def put(fields, store, run, batch_id, report="report"):
    """A batch of a run, as a query writes it that has been started anew."""
    hashes.Results(store, report, run).write(fields, batch_id)


def test_nothing_written_yet(spark, store):
    assert latest(spark, store) == {}


def test_fields_merge_and_the_last_write_wins(spark, store):
    put(fields(spark, [("x", 1.5, "p"), ("y", 2.0, None)]), store, "run", 0)
    put(fields(spark, [("x", None, "q")]), store, "run", 1)
    assert latest(spark, store) == {
        ("t:x", "a"): "1.5", ("t:x", "b"): "q", ("t:y", "a"): "2.0",
    }
    assert latest(spark, store, "t:y") == {("t:y", "a"): "2.0"}


def test_writing_a_batch_again_changes_nothing(spark, store):
    batch = fields(spark, [("x", 1.5, "p")])
    put(batch, store, "run", 0)
    before = latest(spark, store)
    put(batch, store, "run", 0)
    assert latest(spark, store) == before
    assert hashes.written(spark, store).count() == 2


def test_any_parquet_reader_can_open_the_table(spark, store):
    """One table, partitioned by report and batch."""
    put(fields(spark, [("x", 1.0, "p")]), store, "run", 0, "a")
    put(fields(spark, [("x", 2.0, None)]), store, "run", 4, "b")
    rows = spark.read.parquet(store).select("report", "batch", "key", "field", "value").collect()
    assert sorted(map(tuple, rows)) == [
        ("a", 0, "t:x", "a", "1.0"), ("a", 0, "t:x", "b", "p"), ("b", 5, "t:x", "a", "2.0"),
    ]
    plan = hashes.read_hashes(spark, store, reports=["b"])._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(report" in plan


def test_names_that_look_missing(spark, store):
    texts = ["null", "\\null", None, "", "a"]
    rows = [(text, float(i)) for i, text in enumerate(texts)]
    cities = spark.createDataFrame(rows, "city STRING, total_amt DOUBLE")
    put(as_fields.city_fields(cities, "t", "global"), f"{store}/c", "run", 0)
    stored = hashes.read_hashes(spark, f"{store}/c").select(read_name(F.col("field")), "value")
    assert {(r[0], float(r[1])) for r in stored.collect()} == set(rows)
    put(as_fields.hash_fields(cities, "t", "city"), f"{store}/k", "run", 0)
    keys = hashes.read_hashes(spark, f"{store}/k").select(read_name(F.substring("key", 3, 99)), "value")
    assert {(r[0], float(r[1])) for r in keys.collect()} == set(rows)


def test_a_whole_row_replaces_with_nulls_too(spark, store):
    schema = "k STRING, a DOUBLE, b STRING"
    for batch, row in enumerate([("x", 1.0, "p"), ("x", 2.0, None)]):
        rows = spark.createDataFrame([row], schema)
        put(as_fields.hash_fields(rows, "t", "k", whole=True), store, "run", batch)
    assert [tuple(r) for r in hashes.hash_get(hashes.read_hashes(spark, store), ["a", "b"]).collect()] == [
        ("t:x", "2.0", None)
    ]


def test_one_key_is_not_a_prefix(spark, store):
    put(fields(spark, [("global", 1.0, "p"), ("globalville", 7.0, "q")]), store, "run", 0)
    found = hashes.read_hashes(spark, store, key="t:global").collect()
    assert {(r.key, r.value) for r in found} == {("t:global", "1.0"), ("t:global", "p")}


def test_a_new_run_replaces_and_keeps(spark, store):
    """A report started over on a fresh checkpoint counts its batches from zero again."""
    put(fields(spark, [("x", 1.0, "p")]), store, "first", 7)
    put(fields(spark, [("x", 2.0, None)]), store, "second", 0)
    assert latest(spark, store) == {("t:x", "a"): "2.0", ("t:x", "b"): "p"}
    # The runs of two reports count on from each other; a restart goes on as before.
    put(fields(spark, [("x", 3.0, None)]), store, "third", 2, "other")
    put(fields(spark, [("x", 4.0, None)]), store, "second", 1)
    assert latest(spark, store)[("t:x", "a")] == "3.0"
    assert {(r.run, r.base) for r in hashes.written(spark, store).collect()} == {
        ("first", 0), ("second", 8), ("third", 9),
    }


def test_null_key_and_city_fields(spark, store):
    cities = spark.createDataFrame([("A", 1.0), (None, 2.0), ("B", None)], "city STRING, total_amt DOUBLE")
    put(as_fields.city_fields(cities, "t", "global"), store, "run", 0)
    assert latest(spark, store) == {("t:global", "A"): "1.0", ("t:global", "null"): "2.0"}


def test_wide_rows_of_cities_with_odd_names(spark, store):
    cities = spark.createDataFrame([("St. A", 1.0), ("b`c", 2.0)], "city STRING, total_amt DOUBLE")
    wide = reports.pivot_city(cities)
    put(as_fields.hash_fields(wide, "t", "total"), store, "run", 0)
    assert latest(spark, store) == {("t:global", "St. A"): "1.0", ("t:global", "b`c"): "2.0"}


def test_a_rewritten_table_holds_the_same_and_goes_on(spark, store):
    for batch in range(5):
        put(fields(spark, [("x", float(batch), "p"), (f"y{batch}", 0.0, "q")]), store, "run", batch)
    put(fields(spark, [("z", 7.0, "q")]), store, "run", 0, "other")
    before, new = latest(spark, store), f"{store}-new"
    hashes.rewrite(spark, store, new)
    assert latest(spark, new) == before
    partitions = spark.read.parquet(new).select("report", "batch").distinct().collect()
    assert {tuple(row) for row in partitions} == {("report", 4), ("other", 5)}
    # The last batch run again, and the next one.
    put(fields(spark, [("x", 98.0, None)]), new, "run", 5)
    put(fields(spark, [("x", 99.0, None)]), new, "run", 6)
    assert latest(spark, new) == before | {("t:x", "a"): "99.0"}


def test_many_cities_in_one_map(spark, store):
    """One row of two columns, one write, however many cities there are."""
    rows = spark.range(50_000).select(
        F.concat(F.lit("C"), "id").alias("city"), F.col("id").cast("double").alias("total_amt")
    )
    odd = [(None, 5.0), ("null", 6.0), ("no", None)]
    rows = rows.unionByName(spark.createDataFrame(odd, "city STRING, total_amt DOUBLE"))
    wide = reports.city_map(rows)
    assert wide.columns == ["total", "amounts"]
    put(as_fields.map_fields(wide, "t", "total", "amounts"), store, "run", 0)
    stored = latest(spark, store)
    assert len(stored) == 50_002
    assert stored[("t:global", "C49999")] == "49999.0"
    assert (stored[("t:global", "null")], stored[("t:global", "\\null")]) == ("5.0", "6.0")
    assert reports.city_map(rows.limit(0)).collect() == []


def test_hash_get(spark, store):
    put(fields(spark, [("x", 1.5, "p"), ("y", 2.0, None)]), store, "run", 0)
    rows = hashes.hash_get(hashes.read_hashes(spark, store), ["b", "a", "c"]).orderBy("key").collect()
    assert [tuple(r) for r in rows] == [("t:x", "p", "1.5", None), ("t:y", None, "2.0", None)]


def test_external_sink_gets_its_options(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from orderstream.config import Settings

    seen = {}
    monkeypatch.setattr(DataFrameWriter, "options", lambda self, **o: seen.update(o) or self)
    monkeypatch.setattr(DataFrameWriter, "format", lambda self, name: seen.update(format=name) or self)
    monkeypatch.setattr(DataFrameWriter, "save", lambda self: seen.update(saved=True))
    settings = Settings(store_format="my.sink", store_host="h", store_options={"ttl": "5"})
    as_fields.write_external(spark.range(1), "orders:money", "type", settings)
    assert seen == {
        "format": "my.sink", "host": "h", "port": "6379", "dbNum": "0", "ttl": "5",
        "table": "orders:money", "key.column": "type", "saved": True,
    }


def test_chart_rows(spark):
    rows = spark.createDataFrame(
        [("A", "5.5", "P"), ("B", "7", "P"), ("C", None, "Q"), ("D", "1", None), ("E", "abc", "R"),
         ("F", "1.0E7", "S")],
        "city STRING, money STRING, province STRING",
    )
    feed = {(r.series, r.category): r.value for r in dashboard.dashboard_feed(rows).collect()}
    assert feed == {("销售额", "P"): 7.0, ("销售额", "S"): 1e7}
    rejects = dashboard.dashboard_rejects(rows).select(F.concat_ws("/", "city", "province", "money"))
    assert [r[0] for r in rejects.collect()] == ["E/R/abc"]
