"""Starting, watching and stopping streaming queries."""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from orderstream.config import Settings
from orderstream.session import path_exists

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

POOL = "spark.scheduler.pool"

PROGRESS_SCHEMA = (
    "query STRING, batch_id BIGINT, input_rows BIGINT, rows_per_second DOUBLE, batch_ms BIGINT"
)


@contextmanager
def _state_settings(spark: SparkSession, settings: Settings, stateful: bool) -> Iterator[None]:
    """Number and kind of state stores, read by a query when it starts.

    A query without state keeps the session's shuffle width.
    """
    wanted = {"spark.sql.shuffle.partitions": str(settings.state_partitions)} if stateful else {}
    if stateful and settings.state_store == "rocksdb":
        wanted["spark.sql.streaming.stateStore.providerClass"] = _ROCKSDB
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@contextmanager
def _pool(spark: SparkSession, name: str) -> Iterator[None]:
    """The scheduler pool of a query, which inherits it when it starts."""
    before = spark.sparkContext.getLocalProperty(POOL)
    spark.sparkContext.setLocalProperty(POOL, name)
    try:
        yield
    finally:
        spark.sparkContext.setLocalProperty(POOL, before)


def start(
    spark: SparkSession,
    writer: DataStreamWriter,
    name: str,
    settings: Settings,
    stateful: bool = False,
) -> StreamingQuery:
    """Start a named query on its own checkpoint, without waiting for it.

    The jobs of its batches go to a scheduler pool of its own: in a session that schedules
    fairly, queries side by side share the cores however long one's batch is.
    """
    writer = writer.queryName(name).option("checkpointLocation", settings.checkpoint(name))
    if settings.trigger:
        writer = writer.trigger(**settings.trigger)
    with _state_settings(spark, settings, stateful), _pool(spark, name):
        return writer.start()


def run_all(
    spark: SparkSession,
    queries: Sequence[StreamingQuery],
    marker: str = "",
    poll_seconds: float = 5.0,
) -> None:
    """Wait until all queries end, one fails (its error is raised), or the marker appears."""
    if marker:
        stop_on_marker(spark, queries, marker, poll_seconds)
        return
    for query in _in_turn(queries, poll_seconds):
        query.awaitTermination()


def _in_turn(queries: Sequence[StreamingQuery], poll_seconds: float) -> Iterator[StreamingQuery]:
    """Queries as they end; the others go on running meanwhile."""
    waiting = list(queries)
    while waiting:
        ended = [query for query in waiting if not query.isActive]
        yield from ended
        waiting = [query for query in waiting if query not in ended]
        if waiting and not ended:
            waiting[0].awaitTermination(poll_seconds)


def stop_on_marker(
    spark: SparkSession,
    queries: Sequence[StreamingQuery],
    marker: str,
    poll_seconds: float = 5.0,
    grace_seconds: float = 60.0,
) -> None:
    """Let queries run until the marker path appears, then stop each after its batch."""
    while any(query.isActive for query in queries):
        if path_exists(spark, marker):
            for query in queries:
                stop_gracefully(query, grace_seconds)
            return
        for query in queries:
            if query.isActive:
                query.awaitTermination(poll_seconds)
                break
    for query in queries:
        query.awaitTermination()


def stop_gracefully(query: StreamingQuery, grace_seconds: float = 60.0) -> None:
    """Stop between two batches if one ends in time; an interrupted batch is run again later.

    A batch has ended when the query is idle, or has reported one since we asked.
    """
    until = time.monotonic() + grace_seconds
    reported = _last_report(query)
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < until:
        if _last_report(query) != reported:
            break
        time.sleep(0.05)
    query.stop()


def _last_report(query: StreamingQuery) -> tuple[int, str] | None:
    step = query.lastProgress
    return (step["batchId"], step["timestamp"]) if step else None


def progress_rows(spark: SparkSession, queries: Sequence[StreamingQuery]) -> DataFrame:
    """Recent batches of the queries; Spark keeps a bounded number per query."""
    rows = [
        (
            query.name,
            step["batchId"],
            step["numInputRows"],
            step["processedRowsPerSecond"],
            step["durationMs"].get("triggerExecution"),
        )
        for query in queries
        for step in query.recentProgress
    ]
    return spark.createDataFrame(rows, PROGRESS_SCHEMA)
