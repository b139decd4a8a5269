"""Event streams and bounded topic reads.

Every source yields at least ``key`` and ``value``. A message bus is read with
Spark's Kafka connector; files of messages give the same columns without it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(
    servers: str,
    topic: str,
    starting: str = "earliest",
    ending: str | None = None,
    min_partitions: int | None = None,
    max_per_batch: int | None = None,
) -> dict[str, str]:
    """Options for the Kafka source.

    ``min_partitions`` lets one topic partition feed several tasks, so that a hot
    partition does not bound a batch. ``ending`` is for bounded reads only.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "endingOffsets": ending,
        "minPartitions": min_partitions,
        "maxOffsetsPerTrigger": max_per_batch,
    }
    return {key: str(value) for key, value in options.items() if value is not None}


def topic_stream(spark: SparkSession, servers: str, topic: str, **how) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, **how)).load()


def topic_batch(spark: SparkSession, servers: str, topic: str, **how) -> DataFrame:
    """Everything in a topic from the earliest to the latest offset."""
    options = kafka_options(servers, topic, ending=how.pop("ending", "latest"), **how)
    return spark.read.format("kafka").options(**options).load()


def _lines_as_messages(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value")
    )


def message_files_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A folder of files with one JSON message per line, as a stream."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _lines_as_messages(reader.load(path))


def message_files_batch(spark: SparkSession, path: str) -> DataFrame:
    return _lines_as_messages(spark.read.text(path))


def as_text(messages: DataFrame) -> DataFrame:
    """Pass messages through as readable text."""
    return messages.select(F.col("value").cast("string").alias("message"))
