"""Writing message frames to a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from orderstream.config import Settings
from orderstream.operators.messages import POSITION
from orderstream.session import path_exists
from orderstream.sources.messages import MESSAGE_SCHEMA, position_headers, topic_path


def kafka_sink_options(settings: Settings, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": settings.bootstrap_servers, "topic": topic}


def _segment(messages: DataFrame) -> DataFrame:
    names = [part.split()[0] for part in MESSAGE_SCHEMA.split(", ")]
    return messages.select(*names)


def _record(messages: DataFrame) -> DataFrame:
    """What goes to Kafka: the text, and the position of its message where it has one."""
    if set(POSITION) <= set(messages.columns):
        return messages.select("value", position_headers().alias("headers"))
    return messages.select("value")


def publish(
    messages: DataFrame, settings: Settings, topic: str, records_per_file: int = 1_000_000
) -> None:
    """Append a batch of messages; each task rolls its own segments, nothing is shuffled.

    A folder that a stream writes is refused: its readers see only the files in the
    stream's own log.
    """
    if settings.source_format == "kafka":
        options = kafka_sink_options(settings, topic)
        options |= {"kafka.acks": "1", "kafka.retries": "3"}
        _record(messages).write.format("kafka").options(**options).save()
        return
    path = topic_path(settings, topic)
    if path_exists(messages.sparkSession, f"{path}/_spark_metadata"):
        raise ValueError(f"{path} belongs to a stream; a batch written there would not be read")
    writer = _segment(messages).write.mode("append").option("maxRecordsPerFile", records_per_file)
    writer.parquet(path)


def stream_writer(messages: DataFrame, settings: Settings, topic: str) -> DataStreamWriter:
    """Append stream to a topic: at least once to Kafka, exactly once to files."""
    if settings.source_format == "kafka":
        options = kafka_sink_options(settings, topic)
        writer = _record(messages).writeStream.outputMode("append").format("kafka")
        return writer.options(**options)
    writer = _segment(messages).writeStream.outputMode("append").format("parquet")
    return writer.option("path", topic_path(settings, topic))
