"""Message topics: Kafka, or a folder of Parquet segments with the same columns."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderstream.config import Settings
from orderstream.operators.messages import POSITION

# Columns of a message frame: the text and its position in the topic.
MESSAGE_SCHEMA = "value STRING, timestamp TIMESTAMP, partition INT, offset BIGINT"


def kafka_source_options(settings: Settings, topic: str, streaming: bool) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": settings.bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": settings.starting_offsets if streaming else "earliest",
    }
    if settings.starting_time and streaming:
        moment = datetime.fromisoformat(settings.starting_time)
        options["startingTimestamp"] = str(round(moment.timestamp() * 1000))
        options["startingOffsetsByTimestampStrategy"] = "latest"
    if streaming:
        options["maxOffsetsPerTrigger"] = str(settings.max_offsets_per_trigger)
    if settings.min_partitions:
        options["minPartitions"] = str(settings.min_partitions)
    return options


def topic_path(settings: Settings, topic: str) -> str:
    return f"{settings.topic_root.rstrip('/')}/{topic}"


def _segments(spark: SparkSession, settings: Settings, topic: str) -> DataFrame:
    return spark.read.schema(MESSAGE_SCHEMA).parquet(topic_path(settings, topic))


def segment_count(spark: SparkSession, settings: Settings, topic: str) -> int:
    """How many segments a file topic has; only their names are listed."""
    return len(_segments(spark, settings, topic).inputFiles())


def files_per_batch(spark: SparkSession, settings: Settings, topic: str) -> int:
    """How many segments keep a batch within the cap of messages; one at least.

    Goes by the largest segment there is when the query starts. Counts come from the
    segments' footers, no message is read.
    """
    file = F.col("_metadata.file_path").alias("file")
    counts = _segments(spark, settings, topic).groupBy(file).count()
    largest = counts.agg(F.max("count")).first()[0] or settings.max_offsets_per_trigger
    return max(1, settings.max_offsets_per_trigger // largest)


def newest_segment(spark: SparkSession, settings: Settings, topic: str) -> str:
    """When the newest segment of a file topic was written, as ``file_start`` takes it."""
    at = F.col("_metadata.file_modification_time")
    found = _segments(spark, settings, topic).agg(F.unix_micros(F.max(at))).first()[0] or 0
    return datetime.fromtimestamp(found / 1_000_000, UTC).isoformat()


def _start(spark: SparkSession, settings: Settings, topic: str) -> str:
    """The time after which segments are read; noted at the first start for all later ones."""
    if settings.file_start != "latest":
        return settings.file_start
    path = f"{settings.checkpoint_root.rstrip('/')}/starts/{topic}"
    now = spark.range(1).select(F.unix_micros(F.current_timestamp()).alias("at"))
    now.write.mode("ignore").parquet(path)
    return datetime.fromtimestamp(spark.read.parquet(path).first().at / 1_000_000, UTC).isoformat()


def position_headers() -> Column:
    """The position of a message as Kafka headers, for a topic that is written in parallel."""
    values = (F.unix_micros("timestamp"), F.col("partition"), F.col("offset"))
    return F.array(
        *(
            F.struct(F.lit(name).alias("key"), value.cast("string").cast("binary").alias("value"))
            for name, value in zip(POSITION, values, strict=True)
        )
    )


def _carried(raw: DataFrame) -> DataFrame:
    """Messages with the position in their headers, or else their own in the topic."""
    if "headers" not in raw.columns:
        return raw

    def header(name: str) -> Column:
        found = F.filter("headers", lambda h: h["key"] == name)
        return F.get(found, F.lit(0))["value"].cast("string").try_cast("bigint")

    moment, partition, offset = map(header, POSITION)
    all_there = moment.isNotNull() & partition.isNotNull() & offset.isNotNull()
    return raw.select(
        "value",
        F.when(all_there, F.timestamp_micros(moment)).otherwise(F.col("timestamp")).alias("timestamp"),
        F.when(all_there, partition.cast("int")).otherwise(F.col("partition")).alias("partition"),
        F.when(all_there, offset).otherwise(F.col("offset")).alias("offset"),
    )


def read_messages(
    spark: SparkSession, settings: Settings, topic: str, streaming: bool = True
) -> DataFrame:
    """Messages of a topic as text, with their position kept.

    A file topic is read from where ``file_start`` says, at most so many files, bytes or
    messages per batch. A batch takes one segment at least.
    """
    reader = spark.readStream if streaming else spark.read
    if settings.source_format == "kafka":
        options = kafka_source_options(settings, topic, streaming)
        raw = reader.format("kafka").options(**options).option("includeHeaders", "true").load()
        raw = _carried(raw)
    elif settings.source_format == "files":
        if streaming and settings.max_bytes_per_trigger and not settings.max_files_per_trigger:
            reader = reader.option("maxBytesPerTrigger", settings.max_bytes_per_trigger)
        elif streaming:
            files = settings.max_files_per_trigger or files_per_batch(spark, settings, topic)
            reader = reader.option("maxFilesPerTrigger", files)
        raw = reader.schema(MESSAGE_SCHEMA).parquet(topic_path(settings, topic))
        if streaming and settings.file_start != "earliest":
            begin = F.lit(_start(spark, settings, topic)).cast("timestamp")
            raw = raw.where(F.col("_metadata.file_modification_time") > begin)
        if settings.starting_time and streaming:
            raw = raw.where(F.col("timestamp") >= F.lit(settings.starting_time).cast("timestamp"))
    else:
        raise ValueError(f"unknown source format {settings.source_format!r}")
    return raw.selectExpr("CAST(value AS STRING) AS value", "timestamp", "partition", "offset")
