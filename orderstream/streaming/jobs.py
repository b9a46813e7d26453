"""The ETL job and the report job, as streaming queries."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import AbstractContextManager, nullcontext
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderstream.config import Settings
from orderstream.functions.text import read_name, stored_name
from orderstream.operators import exact, reports
from orderstream.operators.counts import Counts
from orderstream.operators.etl import order_etl, order_etl_open
from orderstream.operators.geo import GeoIndex, with_hot_keys
from orderstream.operators.messages import POSITION, etl_envelope, order_fields, report_rows
from orderstream.sinks import fields, hashes
from orderstream.sinks.messages import stream_writer
from orderstream.sources.messages import read_messages
from orderstream.sources.ranges import load_index
from orderstream.streaming.batches import batch_table
from orderstream.streaming.control import run_all, start

ETL_QUERY = "order-etl"
PLACES_QUERY = "query-amt-by-place"


@dataclass(frozen=True)
class Report:
    """A keyed report: what the stream computes and how a batch of it is stored.

    ``wide`` gives the frames an external keyed sink gets, ``fields`` the same
    content as hash fields. ``spot`` is the key and field that the sum of a place
    counts towards.
    """

    name: str
    table: str
    key: str
    stream: Callable[[DataFrame, Settings], DataFrame]
    wide: Callable[[DataFrame, Settings], list[DataFrame]]
    fields: Callable[[DataFrame, Settings], DataFrame]
    spot: Callable[[], tuple[Column, Column]] | None = None


def _same(rows: DataFrame, settings: Settings) -> list[DataFrame]:
    return [rows]


def _total_wide(rows: DataFrame, settings: Settings) -> list[DataFrame]:
    return [reports.pivot_total(rows)]


# Fixed values below: table names and key columns of the stored reports.
TOTAL = Report(
    name="query-amt-total",
    table="orders:money",
    key="type",
    stream=lambda rows, settings: reports.amt_total(rows),
    wide=_total_wide,
    fields=lambda rows, settings: fields.hash_fields(
        reports.pivot_total(rows), "orders:money", "type"
    ),
    spot=lambda: (fields.hash_key("orders:money", F.lit(reports.TOTAL)), F.lit(reports.GLOBAL)),
)
PROVINCE = Report(
    name="query-amt-province",
    table="orders:provincemoney",
    key="province",
    stream=lambda rows, settings: reports.amt_by_province(rows),
    wide=_same,
    fields=lambda rows, settings: fields.hash_fields(rows, "orders:provincemoney", "province"),
    spot=lambda: (fields.hash_key("orders:provincemoney", F.col("province")), F.lit("total_amt")),
)
# The wide row of a batch has the cities that changed, in one map; fields of a hash merge.
CITY = Report(
    name="query-amt-by-city",
    table="orders:citymoney",
    key="total",
    stream=lambda rows, settings: reports.amt_by_city(rows),
    wide=lambda rows, settings: [reports.city_map(rows)],
    fields=lambda rows, settings: fields.city_fields(rows, "orders:citymoney", reports.GLOBAL),
    spot=lambda: (
        fields.hash_key("orders:citymoney", F.lit(reports.GLOBAL)), stored_name(F.col("city"))
    ),
)
KEY_CITY_AMOUNT = Report(
    name="query-key-city-amount",
    table="orders:keycityamount",
    key="city",
    stream=lambda rows, settings: reports.key_city_amount(rows, settings.key_cities),
    wide=_same,
    fields=lambda rows, settings: fields.hash_fields(rows, "orders:keycityamount", "city"),
    spot=lambda: (fields.hash_key("orders:keycityamount", F.col("city")), F.lit("total_amt")),
)
# The state is the newest row of each city with its position, so late rows lose there.
KEY_CITY_LATEST = Report(
    name="query-amt-city",
    table="orders:citymoney",
    key="city",
    stream=lambda rows, settings: reports.key_city_latest(rows, settings.key_cities),
    wide=_same,
    fields=lambda rows, settings: fields.hash_fields(rows, "orders:citymoney", "city", whole=True),
)

# The sums: all follow from sums by place.
SUMS: tuple[Report, ...] = (TOTAL, PROVINCE, CITY, KEY_CITY_AMOUNT)
REPORTS: tuple[Report, ...] = (TOTAL, PROVINCE, CITY, KEY_CITY_AMOUNT, KEY_CITY_LATEST)


def start_etl(
    spark: SparkSession,
    settings: Settings,
    index: GeoIndex,
    messages: DataFrame | None = None,
    open_only: bool = False,
    counts: Counts | None = None,
) -> StreamingQuery:
    """Start the ETL: raw topic to ETL topic, map-only apart from the dictionary join."""
    if messages is None:
        messages = read_messages(spark, settings, settings.source_topic)
    etl = order_etl_open if open_only else order_etl
    rows = etl(messages, index, POSITION, counts)
    lines = etl_envelope(counts.amounts(rows) if counts else rows, POSITION)
    return start(spark, stream_writer(lines, settings, settings.etl_topic), ETL_QUERY, settings)


def start_report(
    spark: SparkSession, settings: Settings, report: Report, rows: DataFrame
) -> StreamingQuery:
    """Start one report over ``money, province, city`` and topic position columns."""

    write = _sink(report.name, settings)

    def store(batch: DataFrame, batch_id: int) -> None:
        if settings.store_format == "hashes":
            write(report.fields(batch, settings), batch_id)
        else:
            _write_external(report, batch, settings)

    writer = report.stream(rows, settings).writeStream.outputMode("update").foreachBatch(store)
    return start(spark, writer, report.name, settings, stateful=True)


def _sink(name: str, settings: Settings) -> Callable[[DataFrame, int], None]:
    """Stores the fields of a query's batches under its id; a new checkpoint has a new one."""
    results: list[hashes.Results] = []

    def write(fields: DataFrame, batch_id: int) -> None:
        if not results:
            results.append(hashes.Results(settings.store_path, name, _run(fields.sparkSession)))
        results[0].write(fields, batch_id)

    return write


def _write_external(report: Report, rows: DataFrame, settings: Settings) -> None:
    for wide in report.wide(rows, settings):
        fields.write_external(wide, report.table, report.key, settings)


def _run(session: SparkSession) -> str:
    """Id of the streaming query whose batch is being stored."""
    run = session.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not run:
        raise RuntimeError("a batch is stored by a streaming query, which has an id")
    return run


def start_sums(spark: SparkSession, settings: Settings, rows: DataFrame) -> StreamingQuery:
    """Start all sum reports as one query, which reads and parses the topic once.

    State is the exact sums per province and city. Each batch gets
    all places from the state and stores every report of them, a few rows each, under
    the keys the single reports use. Nothing is read back.
    """

    write = _sink(PLACES_QUERY, settings)

    def store(batch: DataFrame, batch_id: int) -> None:
        if settings.store_format == "hashes":
            write(place_fields(batch, settings).coalesce(settings.state_partitions), batch_id)
            return
        places = batch.persist()
        try:
            for report in SUMS:
                _write_external(report, report.stream(places, settings), settings)
        finally:
            places.unpersist()

    places = reports.amt_by_place(rows)
    writer = places.writeStream.outputMode("complete").foreachBatch(store)
    return start(spark, writer, PLACES_QUERY, settings, stateful=True)


def place_fields(places: DataFrame, settings: Settings) -> DataFrame:
    """All sum reports of exact sums per place, as hash fields, by one aggregation.

    The sum of a place is added up at every spot it counts towards. The places are read
    once, so the state behind them is too.
    """
    marked = reports.with_key_city(places, settings.key_cities)
    spots = []
    for report in SUMS:
        key, field = report.spot()
        spot = F.struct(key.alias("key"), field.alias("field"))
        spots.append(F.when(F.col("key_city"), spot) if report is KEY_CITY_AMOUNT else spot)
    spread = marked.select(F.explode(F.array_compact(F.array(*spots))).alias("spot"), *exact.ADDENDS)
    sums = exact.totals(spread.select("spot.*", *exact.ADDENDS), "key", "field")
    value = F.col("total_amt").cast("string").alias("value")
    return sums.select("key", "field", value).where(F.col("value").isNotNull())


def start_key_city_rows(
    spark: SparkSession, settings: Settings, rows: DataFrame, path: str
) -> StreamingQuery:
    """Append the rows of the key cities, unaggregated, to a Parquet folder."""
    chosen = reports.key_city_rows(rows, settings.key_cities).select("money", "province", "city")
    writer = chosen.writeStream.outputMode("append").format("parquet").option("path", path)
    return start(spark, writer, "query-key-city-rows", settings)


def _noted(spark: SparkSession, settings: Settings) -> AbstractContextManager:
    """Keeps the table of batches, if the settings name one."""
    return batch_table(spark, settings.batch_table) if settings.batch_table else nullcontext()


def run_etl(spark: SparkSession, settings: Settings, open_only: bool = False) -> None:
    """The whole ETL job, until it is stopped. Its batches count what they drop or miss."""
    index = load_index(spark, settings).persist()
    if not index.broadcast:
        so_far = read_messages(spark, settings, settings.source_topic, streaming=False)
        index = with_hot_keys(index, order_fields(so_far), "ip")
    try:
        with _noted(spark, settings):
            counts = Counts(streaming=True)
            query = start_etl(spark, settings, index, open_only=open_only, counts=counts)
            run_all(spark, [query], settings.stop_etl_file)
    finally:
        index.unpersist()


def run_reports(
    spark: SparkSession,
    settings: Settings,
    chosen: Sequence[Report] = REPORTS,
    sums_together: bool = False,
) -> None:
    """Start the reports, each with its own name and checkpoint, then wait for all.

    ``sums_together`` starts all sums as one query instead of one query each.
    """
    messages = read_messages(spark, settings, settings.etl_topic)
    rows = report_rows(messages, POSITION)
    with _noted(spark, settings):
        queries = []
        if sums_together:
            queries.append(start_sums(spark, settings, rows))
            chosen = [report for report in chosen if report not in SUMS]
        queries += [start_report(spark, settings, report, rows) for report in chosen]
        run_all(spark, queries, settings.stop_state_file)


def _names(report: Report) -> list[str]:
    """Who stores a report: its own query, or that of all sums."""
    return [report.name, *([PLACES_QUERY] if report in SUMS else [])]


def _key_text(prefix: str) -> Column:
    return read_name(F.col("key").substr(F.lit(len(prefix) + 1), F.length("key")))


def stored_total(spark: SparkSession, store: str) -> DataFrame:
    """``total_amt`` as it stands now."""
    key = f"{TOTAL.table}:{reports.TOTAL}"
    total = hashes.read_hashes(spark, store, key=key, reports=_names(TOTAL))
    row = hashes.hash_get(total, [reports.GLOBAL])
    return row.select(F.col(reports.GLOBAL).try_cast("double").alias("total_amt"))


def stored_amounts(spark: SparkSession, store: str, report: Report) -> DataFrame:
    """``<key>, total_amt`` of a report with one hash per key."""
    prefix = f"{report.table}:"
    found = hashes.read_hashes(spark, store, prefix, reports=_names(report))
    amounts = hashes.hash_get(found, ["total_amt"])
    amount = F.col("total_amt").try_cast("double").alias("total_amt")
    return amounts.select(_key_text(prefix).alias(report.key), amount)


def stored_city_amounts(spark: SparkSession, store: str) -> DataFrame:
    """``city, total_amt`` from the fields of the one hash of all cities."""
    key = f"{CITY.table}:{reports.GLOBAL}"
    fields = hashes.read_hashes(spark, store, key=key, reports=_names(CITY))
    return fields.select(
        read_name(F.col("field")).alias("city"),
        F.col("value").try_cast("double").alias("total_amt"),
    )


def stored_cities(spark: SparkSession, store: str) -> DataFrame:
    """``city, money, province`` as texts: every hash the chart scans.

    The hash of all city sums has the same prefix, but is stored by another report.
    """
    prefix = f"{KEY_CITY_LATEST.table}:"
    stored = hashes.read_hashes(spark, store, prefix, reports=_names(KEY_CITY_LATEST))
    found = hashes.hash_get(stored, ["money", "province"])
    return found.select(_key_text(prefix).alias("city"), "money", "province")
