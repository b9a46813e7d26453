"""Spark session and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from orderstream.config import Settings


def build(settings: Settings, app_name: str = "orderstream") -> SparkSession:
    """Session for a job: a fixed small setup locally, the cluster's own otherwise."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.debug.maxToStringFields", "2000")
        # Queries side by side share the cores batch by batch, see streaming.control.start.
        .config("spark.scheduler.mode", "FAIR")
    )
    if settings.local_mode:
        builder = (
            builder.master(settings.master)
            .config("spark.ui.enabled", "false")
            .config("spark.sql.shuffle.partitions", str(settings.shuffle_partitions))
        )
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    named = named or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    made = tempfile.mkdtemp(prefix="orderstream-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stored_once(rows: DataFrame) -> DataFrame:
    """A small result written to the shared folder, for plans that read it more than once."""
    shared_dir(rows.sparkSession)
    return rows.checkpoint()


def path_exists(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def changed_at(spark: SparkSession, path: str) -> int:
    """When a file or folder was changed last, in milliseconds."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = found.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.getFileStatus(found).getModificationTime()
