"""Keyed results as hashes: ``<table>:<key>`` holds named fields, the last write wins.

One Parquet table has the fields of all reports, partitioned by report and batch. A batch
overwrites its own partition, so running it again changes nothing, and readers take each
field from the newest batch that has it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderstream.session import path_exists

# ``batch`` counts on over all runs: batch 0 of a run has the number ``base``.
HASH_SCHEMA = (
    "key STRING, field STRING, value STRING, run STRING, base BIGINT, report STRING, batch BIGINT"
)

class Results:
    """Where one run of a report stores its batches. A restart goes on with the same run."""

    def __init__(self, store: str, report: str, run: str) -> None:
        self.store, self.report, self.run = store, report, run
        self.base: int | None = None

    def write(self, fields: DataFrame, batch_id: int) -> None:
        """Write or rewrite the fields that one batch changed."""
        if self.base is None:
            self.base = self._base(fields.sparkSession)
        values = (self.run, self.base, self.report, self.base + batch_id)
        names = [part.split() for part in HASH_SCHEMA.split(", ")][3:]
        added = [F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(values, names, strict=True)]
        writer = fields.select("key", "field", "value", *added).write.partitionBy("report", "batch")
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.store)

    def _base(self, spark: SparkSession) -> int:
        """What the run has begun with, else the number after the last batch of any run."""
        own = F.when((F.col("run") == self.run) & (F.col("report") == self.report), F.col("base"))
        found = written(spark, self.store).agg(F.max(own).alias("own"), F.max("batch").alias("last")).first()
        if found.own is not None:
            return found.own
        return 0 if found.last is None else found.last + 1


def written(spark: SparkSession, store: str) -> DataFrame:
    """All that was ever written; nothing if the table is not there yet."""
    if not path_exists(spark, store):
        return spark.createDataFrame([], HASH_SCHEMA)
    return spark.read.schema(HASH_SCHEMA).parquet(store)


def _newest(rows: DataFrame, *by: str) -> DataFrame:
    newest = F.max_by(F.struct("value", "run", "base"), "batch").alias("newest")
    return rows.groupBy("key", "field", *by).agg(newest).select("key", "field", *by, "newest.*")


def read_hashes(
    spark: SparkSession, store: str, prefix: str = "", key: str | None = None, reports: Sequence[str] = ()
) -> DataFrame:
    """``key, field, value`` as they stand now, of one key or of keys starting with ``prefix``.

    ``reports`` names those that are looked at, none for all.
    """
    rows = written(spark, store)
    if reports:
        rows = rows.where(F.col("report").isin(*reports))
    if key is not None:
        rows = rows.where(F.col("key") == key)
    elif prefix:
        rows = rows.where(F.col("key").startswith(prefix))
    return _newest(rows).select("key", "field", "value")


def rewrite(spark: SparkSession, store: str, target: str) -> None:
    """The fields as they stand now as a new table of one partition per report.

    An ordinary job for a store of very many batches, run while no report writes. Runs
    go on in the new table where they were.
    """
    rows = written(spark, store)
    # One row per report.
    last = F.broadcast(rows.groupBy("report").agg(F.max("batch").alias("batch")))
    names = [part.split()[0] for part in HASH_SCHEMA.split(", ")]
    current = _newest(rows, "report").join(last, "report").select(*names)
    current.write.partitionBy("report", "batch").parquet(target)


def hash_get(hashes: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per key with the named fields as columns, null where a field is missing."""
    wanted = (F.max(F.when(F.col("field") == name, F.col("value"))).alias(name) for name in names)
    return hashes.groupBy("key").agg(*wanted)
