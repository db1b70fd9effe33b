"""Event feeds: JSON lines in files or queue messages, as batches or streams of decoded events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..model import decode


def read(spark: SparkSession, folder: str) -> DataFrame:
    """All events of a folder at once. Good events have a null ``error``; the others can be set aside."""
    return decode(spark.read.text(folder))


def stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Events of files as they arrive; ``max_files`` a micro-batch is the flush limit."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return decode(reader.text(folder))


def kafka_stream(spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None, starting: str = "latest") -> DataFrame:
    """Events of a topic; needs Spark's Kafka package. ``starting``: earliest, latest, or a timestamp in milliseconds."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    reader = reader.option("startingTimestamp", starting) if starting.isdigit() else reader.option("startingOffsets", starting)
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return decode(reader.load().selectExpr("cast(value as string) as value"))


def good(events: DataFrame) -> DataFrame:
    return events.filter("error is null")


def bad(events: DataFrame) -> DataFrame:
    return events.filter("error is not null")
