"""A table of every batch that streaming queries have run, written as they report it."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.listener import (
    QueryIdleEvent,
    QueryProgressEvent,
    QueryStartedEvent,
    QueryTerminatedEvent,
)

from orderstream.session import path_exists

BATCH_SCHEMA = (
    "query STRING, query_id STRING, run_id STRING, batch_id BIGINT, at STRING, input_rows BIGINT,"
    " rows_per_second DOUBLE, batch_ms BIGINT, state_rows BIGINT, observed MAP<STRING, BIGINT>"
)


class BatchTable(StreamingQueryListener):
    """Appends a row per batch and query run, with what the batch observed.

    Every report is kept, however long a query runs. Observed values are stored as
    ``name.value``; those that are no whole numbers are left out.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self._path = spark, path
        self._ended: dict[str, threading.Event] = {}

    def _end_of(self, run_id: str) -> threading.Event:
        return self._ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        self._end_of(str(event.runId))

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        step = event.progress
        if "addBatch" not in step.durationMs:
            return
        observed = {
            f"{name}.{key}": value
            for name, row in step.observedMetrics.items()
            for key, value in row.asDict().items()
            if isinstance(value, int)
        }
        row = (
            step.name, str(step.id), str(step.runId), step.batchId, step.timestamp, step.numInputRows,
            float(step.processedRowsPerSecond), step.durationMs.get("triggerExecution"),
            sum(state.numRowsTotal for state in step.stateOperators), observed,
        )
        self._spark.createDataFrame([row], BATCH_SCHEMA).write.mode("append").parquet(self._path)

    def onQueryIdle(self, event: QueryIdleEvent) -> None:
        pass

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        self._end_of(str(event.runId)).set()

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Wait until the reports of a query that has ended are written."""
        if not self._end_of(str(query.runId)).wait(seconds):
            raise TimeoutError(f"the end of {query.name} was not reported")


@contextmanager
def batch_table(spark: SparkSession, path: str) -> Iterator[BatchTable]:
    """Write the batches of all queries of the session meanwhile."""
    table = BatchTable(spark, path)
    spark.streams.addListener(table)
    try:
        yield table
    finally:
        spark.streams.removeListener(table)


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """One row per query and batch; of a batch that was run again, the last report."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], BATCH_SCHEMA)
    rows = spark.read.schema(BATCH_SCHEMA).parquet(path)
    last = rows.groupBy("query_id", "batch_id").agg(F.max_by(F.struct("*"), "at").alias("last"))
    return last.select("last.*")


def observed_sums(batches: DataFrame, *names: str) -> DataFrame:
    """One row with the sums of observed counts over all batches, columns called as the counts."""
    return batches.agg(
        *(F.coalesce(F.sum(F.col("observed")[name]), F.lit(0)).alias(name.partition(".")[2]) for name in names)
    )
