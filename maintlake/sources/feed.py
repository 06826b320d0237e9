"""CDC feed connectors: Kafka where the connector jar is deployed, JSON lines anywhere."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from maintlake.operators.envelope import feed_messages
from maintlake.schemas import ENTITY_TOPICS


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topics: Sequence[str] = tuple(ENTITY_TOPICS.values()),
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """All CDC topics as one stream of (value, key, topic, partition, offset, timestamp), from the earliest offsets."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    texts = [F.col(c).cast("string").alias(c) for c in ("value", "key")]
    return reader.load().select(*texts, "topic", "partition", "offset", "timestamp")


def json_lines_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A folder of JSON-lines files as a stream of (value)."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def json_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def write_kafka(bronze: DataFrame, servers: str) -> None:
    """Bronze rows -> messages keyed by primary key, each to the topic of its entity."""
    feed_messages(bronze).write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def write_json_lines(bronze: DataFrame, path: str) -> None:
    """Bronze rows -> JSON lines in one folder per topic."""
    feed_messages(bronze).select("topic", "value").write.mode("append").partitionBy("topic").text(path)
