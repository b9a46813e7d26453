"""Every registered query: name -> (spark, folder of the tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderstream import functions as fn
from orderstream.config import Settings
from orderstream.functions.orders import ORDER_ID_TIME, ORDER_TIME
from orderstream.operators import counts, dashboard, etl, geo, reports
from orderstream.operators import messages as msg
from orderstream.plans import tables
from orderstream.session import scratch, stored_once
from orderstream.sinks import fields, hashes
from orderstream.sinks.messages import publish
from orderstream.sources.messages import newest_segment, read_messages, segment_count
from orderstream.streaming import batches, control, jobs, state

Query = Callable[[SparkSession, str], DataFrame]

_COUNT_NAMES = [name.partition(".")[2] for name in counts.ALL]
_COUNT_SCHEMA = ", ".join(f"{name} BIGINT" for name in _COUNT_NAMES)

# Streams read their topic in about this many batches.
_BATCHES = 4
# Most messages of a segment, and the least worth a segment beyond the two of each batch.
_LARGEST_SEGMENT, _SMALLEST_SEGMENT = 1_000_000, 10_000


# -- lines and fields ---------------------------------------------------------------


def message_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usable lines among order messages, the texts of events, and noise."""
    orders = tables.order_messages(spark, sf_dir).select(
        F.lit("orders").alias("source"), F.col("offset").alias("line_id"), "value"
    )
    noise = tables.noise_lines(spark, sf_dir).select(
        "source", F.col("event_id").alias("line_id"), "value"
    )
    return msg.message_filter(orders.unionByName(noise))


def order_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.order_fields(tables.order_messages(spark, sf_dir))


def order_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.order_envelope(tables.order_records(tables.table(spark, sf_dir, "orders")))


def order_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = msg.order_fields(tables.order_messages(spark, sf_dir))
    time = fn.order_timestamp(F.col("orderTime"))
    return fields.select("orderId", F.date_format(time, "yyyy-MM-dd HH:mm:ss").alias("ordered_at"))


def order_status_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = msg.order_fields(tables.order_messages(spark, sf_dir))
    return fields.select("orderId", fn.status_label(F.col("orderStatus")).alias("status"))


def order_time_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tables.table(spark, sf_dir, "events")
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return events.select(
        "event_id",
        fn.order_time(millis, ORDER_TIME).alias("order_time"),
        fn.order_time(millis, ORDER_ID_TIME).alias("id_time"),
    )


def order_id_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tables.table(spark, sf_dir, "events")
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    cents = F.rint(F.col("value") * 100).cast("bigint")
    sign, size = F.when(cents < 0, "-").otherwise(""), F.abs(cents)
    return events.select(
        "event_id",
        fn.order_id(millis, F.col("event_id")).alias("order_id"),
        fn.user_id(F.col("user_id") % 5 + 1, F.col("user_id") % 1000).alias("user_id"),
        F.concat(sign, fn.money_text(F.floor(size / 100), F.pmod(size, F.lit(100)))).alias("money"),
    )


def int_to_ipv4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses given as signed 32-bit integers, half of them negative."""
    number = tables.address_number()
    signed = F.when(number > 2147483647, number - 4294967296).otherwise(number).cast("int")
    orders = tables.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", fn.ipv4_text(signed).alias("ip"))


def ipv4_to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Well-formed addresses and seven malformed shapes of them."""
    ip = fn.ipv4_text(tables.address_number())
    kind = F.col("o_orderkey") % 16
    text = (
        F.when(kind == 0, F.lit(None))
        .when(kind == 1, F.lit(""))
        .when(kind == 2, F.concat(ip, F.lit(".5")))
        .when(kind == 3, F.substring_index(ip, ".", 3))
        .when(kind == 4, F.concat(F.lit("999."), F.substring_index(ip, ".", -3)))
        .when(kind == 5, F.concat(F.lit("a."), F.substring_index(ip, ".", -3)))
        .when(kind == 6, F.concat(F.lit(" "), ip))
        .otherwise(ip)
    )
    orders = tables.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", fn.ipv4_number(text).alias("ip_number"))


def region_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region texts of five fields, of four, of six, and with an empty last field."""
    start = F.concat(F.lit("XX|0|"), "c_mktsegment", F.lit("|"), "c_name")
    kind = F.col("c_custkey") % 8
    region = (
        F.when(kind == 0, start)
        .when(kind == 1, F.concat(start, F.lit("|")))
        .when(kind == 2, F.concat(start, F.lit("|a|b")))
        .otherwise(F.concat(start, F.lit("|ISP")))
    )
    return tables.table(spark, sf_dir, "customer").select(
        "c_custkey",
        fn.region_province(region).alias("province"),
        fn.region_city(region).alias("city"),
    )


# -- addresses and the ETL ----------------------------------------------------------


def _located(spark: SparkSession, sf_dir: str, index: geo.GeoIndex) -> DataFrame:
    fields = msg.order_fields(tables.order_messages(spark, sf_dir), msg.POSITION)
    located = geo.locate(fields.select("orderId", "ip", *msg.POSITION), "ip", index)
    return located.drop(*msg.POSITION)


def geo_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _located(spark, sf_dir, tables.geo_index(spark, sf_dir))


def geo_lookup_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup as it runs when the dictionary is too large to broadcast."""
    index = replace(tables.geo_index(spark, sf_dir), broadcast_bytes=-1)
    return _located(spark, sf_dir, index)


def geo_lookup_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine tenths of the addresses in one /16, found by a sketch and spread over all tasks."""
    small = F.col("o_orderkey") % 65536
    number = F.when(F.col("o_orderkey") % 10 == 0, tables.address_number()).otherwise(small)
    orders = tables.spread(tables.table(spark, sf_dir, "orders"))
    rows = orders.select("o_orderkey", fn.ipv4_text(number).alias("ip"))
    index = replace(tables.geo_index(spark, sf_dir), broadcast_bytes=-1)
    return geo.locate(rows, "ip", geo.with_hot_keys(index, rows, "ip"))


def geo_lookup_crowded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items located in a dictionary of many tiny neighbouring ranges."""
    index = geo.build_index(tables.supplier_ranges(spark, sf_dir))
    number = F.col("l_suppkey") * 4 + F.col("l_orderkey") % 4
    lines = tables.spread(tables.table(spark, sf_dir, "lineitem")).select(
        "l_orderkey", "l_linenumber", fn.ipv4_text(number).alias("ip")
    )
    return geo.locate(lines, "ip", index)


def _etl_rows(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    messages = tables.order_messages(spark, sf_dir)
    return etl.order_etl(messages, tables.geo_index(spark, sf_dir), keep)


def order_etl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _etl_rows(spark, sf_dir)


def order_etl_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = tables.order_messages(spark, sf_dir)
    return etl.order_etl_open(messages, tables.geo_index(spark, sf_dir))


def etl_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.etl_envelope(_etl_rows(spark, sf_dir))


def report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report rows read back from ETL messages."""
    return msg.report_rows(tables.finished(msg.etl_envelope(_etl_rows(spark, sf_dir))))


# -- reports ------------------------------------------------------------------------


def _report_rows(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return msg.typed_rows(_etl_rows(spark, sf_dir, keep), keep)


def amt_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.amt_total(_report_rows(spark, sf_dir))


def amt_by_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.amt_by_province(_report_rows(spark, sf_dir))


def amt_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.amt_by_city(_report_rows(spark, sf_dir))


def amt_any_doubles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of amounts finer than cents, among huge and tiny ones that cancel each other."""
    cents = F.rint(F.col("money") * 100)
    fine = cents / 1024 * F.when(cents % 2 == 1, -1).otherwise(1)
    huge, tiny = cents * float(1 << 200), cents / float(1 << 600)
    amounts = F.explode(F.array(fine, huge, -tiny, -huge, tiny))
    rows = _report_rows(spark, sf_dir).select("province", amounts.alias("money"))
    return reports.amt_by_province(rows)


def key_city_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.key_city_rows(_report_rows(spark, sf_dir), tables.KEY_CITIES)


def key_city_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.key_city_amount(_report_rows(spark, sf_dir), tables.KEY_CITIES)


def key_city_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _report_rows(spark, sf_dir, msg.POSITION)
    return reports.key_city_latest(rows, tables.KEY_CITIES)


def pivot_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.pivot_total(amt_total(spark, sf_dir))


def pivot_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.pivot_city(amt_by_city(spark, sf_dir), tables.KEY_CITIES)


def pivot_city_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide row with all cities in one map, as fields of its hash."""
    wide = reports.city_map(amt_by_city(spark, sf_dir))
    entries = fields.map_fields(wide, "orders:citymoney", "total", "amounts")
    return entries.select("key", "field", F.col("value").cast("double").alias("amount"))


def etl_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the ETL drops and misses among orders and noise, counted in its own pass."""
    seen = counts.Counts()
    rows = etl.order_etl(
        tables.mixed_messages(spark, sf_dir), tables.geo_index(spark, sf_dir), counts=seen
    )
    seen.amounts(rows).write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([seen.found()], _COUNT_SCHEMA)


def pivot_city_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide row with the cities found in the data as columns."""
    return reports.pivot_city(stored_once(amt_by_city(spark, sf_dir)))


# -- chart --------------------------------------------------------------------------


def _city_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest row of every city with money as text, which is no number for closed orders."""
    rows = _etl_rows(spark, sf_dir, msg.POSITION)
    money = F.when(F.col("orderStatus") == "2", F.lit("n/a")).otherwise(F.col("orderMoney"))
    texts = rows.select(*msg.POSITION, money.alias("money"), "province", "city")
    return reports.key_city_latest(texts, None)


def keyed_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest row per key city as hash fields."""
    return fields.hash_fields(key_city_latest(spark, sf_dir), "orders:citymoney", "city")


def dashboard_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.dashboard_feed(_city_texts(spark, sf_dir))


def dashboard_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.dashboard_rejects(_city_texts(spark, sf_dir))


# -- streams ------------------------------------------------------------------------


def _settings(spark: SparkSession, name: str) -> Settings:
    """File topics, checkpoints and stores in a fresh folder; run until the input is used up."""
    work = scratch(spark, name)
    return Settings(
        source_format="files",
        topic_root=f"{work}/topics",
        checkpoint_root=f"{work}/checkpoints",
        store_path=f"{work}/store",
        key_cities=tables.KEY_CITIES,
        trigger={"availableNow": True},
    )


def _segment_size(spark: SparkSession, count: int) -> int:
    """Messages per segment: two segments per batch at least, or two per core if they are worth it.

    Large segments would leave a batch to as few tasks as it has segments.
    """
    per_core = count // (2 * _BATCHES * spark.sparkContext.defaultParallelism)
    worth = min(max(per_core, _SMALLEST_SEGMENT), _LARGEST_SEGMENT)
    return max(min(worth, count // (2 * _BATCHES)), 1)


def _in_batches(spark: SparkSession, settings: Settings, topic: str, read: int = 0) -> Settings:
    """Settings that read about a quarter of a topic's segments per batch, but for those read already."""
    segments = segment_count(spark, settings, topic) - read
    return replace(settings, max_files_per_trigger=max(segments // _BATCHES, 1))


def _publish_segments(
    spark: SparkSession, sf_dir: str, settings: Settings, messages: DataFrame
) -> Settings:
    """Write messages to the raw topic as segments; read about a quarter per batch."""
    count = tables.table(spark, sf_dir, "orders").count()
    publish(messages, settings, settings.source_topic, _segment_size(spark, count))
    return _in_batches(spark, settings, settings.source_topic)


def _stream(spark: SparkSession, sf_dir: str, name: str) -> Settings:
    """Settings of a run whose raw topic has the orders, in segments for several batches."""
    messages = tables.order_messages(spark, sf_dir)
    return _publish_segments(spark, sf_dir, _settings(spark, name), messages)


def _stream_rows(spark: SparkSession, sf_dir: str, settings: Settings) -> DataFrame:
    """Report rows streamed from the raw topic."""
    messages = read_messages(spark, settings, settings.source_topic)
    rows = etl.order_etl(messages, tables.geo_index(spark, sf_dir), msg.POSITION)
    return msg.typed_rows(rows, msg.POSITION)


def _finish(query: StreamingQuery) -> None:
    """Wait for the end of the input, which must have come in several batches."""
    query.awaitTermination()
    read = [step["numInputRows"] for step in query.recentProgress if step["numInputRows"]]
    if len(read) == 1 and read[0] > 1:
        raise RuntimeError(f"{query.name} read its input in {len(read)} batches")


def _etl_stream(
    spark: SparkSession, sf_dir: str, name: str, index: geo.GeoIndex, open_only: bool = False
) -> DataFrame:
    settings = _stream(spark, sf_dir, name)
    _finish(jobs.start_etl(spark, settings, index, open_only=open_only))
    written = read_messages(spark, settings, settings.etl_topic, streaming=False)
    return msg.json_fields(msg.message_filter(written), msg.ETL_FIELDS)


def s_order_etl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _etl_stream(spark, sf_dir, "s_order_etl", tables.geo_index(spark, sf_dir))


def s_order_etl_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ETL stream as it runs when the dictionary is too large to broadcast."""
    index = replace(tables.geo_index(spark, sf_dir), broadcast_bytes=-1)
    return _etl_stream(spark, sf_dir, "s_order_etl_shuffled", index)


def s_order_etl_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = tables.geo_index(spark, sf_dir)
    return _etl_stream(spark, sf_dir, "s_order_etl_open", index, open_only=True)


def _run_report(spark: SparkSession, sf_dir: str, name: str, report: jobs.Report) -> str:
    settings = _stream(spark, sf_dir, name)
    rows = _stream_rows(spark, sf_dir, settings)
    _finish(jobs.start_report(spark, settings, report, rows))
    return settings.store_path


def s_amt_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.stored_total(spark, _run_report(spark, sf_dir, "s_amt_total", jobs.TOTAL))


def s_amt_by_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _run_report(spark, sf_dir, "s_amt_by_province", jobs.PROVINCE)
    return jobs.stored_amounts(spark, store, jobs.PROVINCE)


def s_amt_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _run_report(spark, sf_dir, "s_amt_by_city", jobs.CITY)
    return jobs.stored_city_amounts(spark, store)


def s_key_city_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = _stream(spark, sf_dir, "s_key_city_rows")
    rows = _stream_rows(spark, sf_dir, settings)
    _finish(jobs.start_key_city_rows(spark, settings, rows, settings.store_path))
    schema = "money DOUBLE, province STRING, city STRING"
    return spark.read.schema(schema).parquet(settings.store_path)


def s_key_city_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _run_report(spark, sf_dir, "s_key_city_amount", jobs.KEY_CITY_AMOUNT)
    return jobs.stored_amounts(spark, store, jobs.KEY_CITY_AMOUNT)


def s_key_city_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _run_report(spark, sf_dir, "s_key_city_latest", jobs.KEY_CITY_LATEST)
    money = F.col("money").try_cast("double").alias("money")
    return jobs.stored_cities(spark, store).select("city", money, "province")


def s_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chart rows scanned from a store that also holds the city sums under the same prefix."""
    settings = _stream(spark, sf_dir, "s_dashboard")
    rows = _stream_rows(spark, sf_dir, settings)
    queries = [
        jobs.start_report(spark, settings, report, rows)
        for report in (jobs.CITY, jobs.KEY_CITY_LATEST)
    ]
    control.run_all(spark, queries)
    for query in queries:
        _finish(query)
    return dashboard.dashboard_feed(jobs.stored_cities(spark, settings.store_path))


def s_two_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw topic -> ETL job -> ETL topic -> all reports side by side; all that they store."""
    settings = _stream(spark, sf_dir, "s_two_jobs")
    _finish(jobs.start_etl(spark, settings, tables.geo_index(spark, sf_dir)))
    # The ETL writes a segment per task, which need not be as many as it has read.
    settings = _in_batches(spark, settings, settings.etl_topic)
    messages = read_messages(spark, settings, settings.etl_topic)
    rows = msg.report_rows(messages, msg.POSITION)
    queries = [jobs.start_report(spark, settings, report, rows) for report in jobs.REPORTS]
    control.run_all(spark, queries)
    for query in queries:
        _finish(query)
    return _stored_fields(spark, settings.store_path)


def s_sums_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sums from one query over the ETL topic; all that it stores."""
    settings = _settings(spark, "s_sums_together")
    rows = etl.order_etl(
        tables.order_messages(spark, sf_dir), tables.geo_index(spark, sf_dir), msg.POSITION
    )
    settings = _publish_segments(spark, sf_dir, settings, msg.etl_envelope(rows, msg.POSITION))
    messages = read_messages(spark, settings, settings.source_topic)
    _finish(jobs.start_sums(spark, settings, msg.report_rows(messages, msg.POSITION)))
    return _stored_fields(spark, settings.store_path)


def _stored_fields(spark: SparkSession, store: str) -> DataFrame:
    """Every stored field: amounts as numbers, other values as text."""
    amount = F.col("value").try_cast("double")
    text = F.when(amount.isNull(), F.col("value"))
    stored = hashes.read_hashes(spark, store)
    return stored.select("key", "field", amount.alias("amount"), text.alias("text"))


def _arriving(
    spark: SparkSession, sf_dir: str, name: str, first: Column
) -> Iterator[tuple[Settings, DataFrame]]:
    """Report rows streamed from an ETL topic: once with the first messages, once with all."""
    settings = _settings(spark, name)
    index = tables.geo_index(spark, sf_dir)
    rows = etl.order_etl(tables.order_messages(spark, sf_dir), index, msg.POSITION)
    messages = msg.etl_envelope(rows, msg.POSITION)
    # Each arrival has a part of the messages, and several batches of its own.
    size = _segment_size(spark, tables.table(spark, sf_dir, "orders").count() // 2)
    read = 0
    for arrived in (first, ~first):
        publish(messages.where(arrived), settings, settings.etl_topic, size)
        capped = _in_batches(spark, settings, settings.etl_topic, read)
        read = segment_count(spark, settings, settings.etl_topic)
        lines = read_messages(spark, capped, settings.etl_topic)
        yield capped, msg.report_rows(lines, msg.POSITION)


def s_key_city_latest_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest rows kept as state, when all older messages come after a restart."""
    newer = F.year("timestamp") >= 1995
    for settings, rows in _arriving(spark, sf_dir, "s_key_city_latest_late", newer):
        jobs.start_report(spark, settings, jobs.KEY_CITY_LATEST, rows).awaitTermination()
    money = F.col("money").try_cast("double").alias("money")
    return jobs.stored_cities(spark, settings.store_path).select("city", money, "province")


def s_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City totals of a report stopped between two batches, and once more during one."""
    # One topic partition has arrived before the stop, the others arrive after it.
    for settings, rows in _arriving(spark, sf_dir, "s_restart", F.col("partition") == 0):
        jobs.start_report(spark, settings, jobs.CITY, rows).stop()
        jobs.start_report(spark, settings, jobs.CITY, rows).awaitTermination()
    return jobs.stored_city_amounts(spark, settings.store_path)


def s_state_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums by place as both state stores keep them after a restart, and as stored.

    Both queries read the one topic, each with a checkpoint and a store of its own.
    """
    by_store = {}
    for settings, rows in _arriving(spark, sf_dir, "s_state_read_back", F.col("partition") == 0):
        for store in ("default", "rocksdb"):
            by_store[store] = kept = replace(
                settings, state_store=store, checkpoint_root=f"{settings.checkpoint_root}/{store}",
                store_path=f"{settings.store_path}/{store}",
            )
            jobs.start_sums(spark, kept, rows).awaitTermination()
    result = None
    for store, kept in by_store.items():
        in_state = reports.amt_by_city(state.place_sums(spark, kept))
        stored = jobs.stored_city_amounts(spark, kept.store_path)
        same_city = in_state["city"].eqNullSafe(stored["city"])
        both = in_state.join(stored, same_city, "full").select(
            F.lit(store).alias("store"), in_state["city"],
            in_state["total_amt"].alias("in_state"), stored["total_amt"].alias("stored"),
        )
        result = both if result is None else result.unionByName(both)
    return result


def s_state_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums that go on in 16 state stores from where a query with 4 has stopped."""
    arriving = _arriving(spark, sf_dir, "s_state_widened", F.col("partition") == 0)
    old, rows = next(arriving)
    jobs.start_sums(spark, old, rows).awaitTermination()
    read = newest_segment(spark, old, old.etl_topic)
    work = scratch(spark, "widened")
    new = replace(old, state_partitions=16, checkpoint_root=work, file_start=read)
    state.widen(spark, old, new, f"{work}/seed")
    next(arriving)
    lines = read_messages(spark, new, new.etl_topic)
    later = msg.report_rows(lines, msg.POSITION)
    state.start_seeded_sums(spark, new, later, f"{work}/seed").awaitTermination()
    width = state.state_width(spark, new.checkpoint(jobs.PLACES_QUERY))
    return jobs.stored_city_amounts(spark, new.store_path).withColumn("stores", F.lit(width))


def s_start_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of what came after a report's first start, also over a restart."""
    first = F.col("partition") == 0
    for settings, _ in _arriving(spark, sf_dir, "s_start_latest", first):
        latest = replace(settings, file_start="latest")
        lines = read_messages(spark, latest, latest.etl_topic)
        rows = msg.report_rows(lines, msg.POSITION)
        jobs.start_report(spark, latest, jobs.PROVINCE, rows).awaitTermination()
    return jobs.stored_amounts(spark, settings.store_path, jobs.PROVINCE)


def s_etl_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the ETL stream drops and misses, from the reports of all its batches."""
    messages = tables.mixed_messages(spark, sf_dir)
    settings = _publish_segments(spark, sf_dir, _settings(spark, "s_etl_counts"), messages)
    table = f"{settings.store_path}/batches"
    with batches.batch_table(spark, table) as log:
        seen = counts.Counts(streaming=True)
        query = jobs.start_etl(spark, settings, tables.geo_index(spark, sf_dir), counts=seen)
        _finish(query)
        log.wait(query)
    return batches.observed_sums(batches.read_batches(spark, table), *counts.ALL)


def s_rate_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was read under a cap of messages per batch, and whether every batch kept to it.

    Counted from the report of each batch, and of the order keys that it observed.
    """
    settings = _stream(spark, sf_dir, "s_rate_cap")
    orders = tables.table(spark, sf_dir, "orders").count()
    cap = max(orders // 3, 1)
    capped = replace(settings, max_files_per_trigger=None, max_offsets_per_trigger=cap)
    table = f"{settings.store_path}/batches"
    with batches.batch_table(spark, table) as log:
        lines = read_messages(spark, capped, capped.source_topic)
        seen = lines.observe("read", F.sum("offset").alias("order_keys"))
        query = jobs.start_etl(spark, capped, tables.geo_index(spark, sf_dir), seen)
        _finish(query)
        log.wait(query)
    found = batches.read_batches(spark, table)
    return found.agg(
        F.sum("input_rows").alias("input_rows"),
        F.sum(F.col("observed")["read.order_keys"]).alias("order_keys"),
        F.count_if(F.col("input_rows") > cap).alias("batches_beyond"),
        F.least(F.count("*"), F.lit(3)).alias("batches"),
    )


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        message_filter, order_fields, order_envelope, order_timestamps, order_status_label,
        order_time_format, order_id_format, int_to_ipv4, ipv4_to_long, region_fields,
        geo_lookup, geo_lookup_shuffled, geo_lookup_hot, geo_lookup_crowded,
        order_etl, order_etl_open, etl_envelope, report_rows,
        amt_total, amt_by_province, amt_by_city, amt_any_doubles,
        key_city_rows, key_city_amount, key_city_latest,
        pivot_total, pivot_city, pivot_city_map, pivot_city_found, etl_counts,
        keyed_hashes, dashboard_feed, dashboard_rejects,
        s_order_etl, s_order_etl_shuffled, s_order_etl_open, s_amt_total, s_amt_by_province, s_amt_by_city,
        s_key_city_rows, s_key_city_amount, s_key_city_latest,
        s_dashboard, s_two_jobs, s_sums_together, s_key_city_latest_late, s_restart, s_state_read_back,
        s_state_widened, s_start_latest, s_etl_counts, s_rate_cap,
    )
}
