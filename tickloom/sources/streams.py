"""Streaming sources and topic sinks: a log broker in deployment, files elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.schemas import TICK
from tickloom.sources.decode import decode_ticks

# Producer settings of the published topics.
PRODUCER = {"kafka.acks": "all", "kafka.enable.idempotence": "true", "kafka.compression.type": "lz4", "kafka.linger.ms": "5"}

#: Room for the partition's number below the offset in a message's position.
PARTITION_BITS = 16


def read_messages(spark: SparkSession, servers: str, topic: str, start: str = "latest", **options: str) -> DataFrame:
    """Messages of a topic; offsets live in the query's checkpoint. Needs the Kafka package."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    log = reader.option("startingOffsets", start).options(**options).load()
    # offsets rise per partition and a benchmark stays in one, so this keeps each benchmark's order
    position = F.shiftleft("offset", PARTITION_BITS) + F.col("partition")
    return log.select(position.alias("event_id"), "partition", "offset", "value")


def read_ticks_stream(spark: SparkSession, fmt: str = "json", **source) -> DataFrame:
    """Decoded messages of the tick topic with their `fault`; split by `good_ticks` and `dead_letters`."""
    return decode_ticks(read_messages(spark, **source), fmt)


def read_message_files(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Message files (event_id, value) as a stream, in file order."""
    reader = spark.readStream.schema("event_id long, key string, value string")
    return reader.option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def read_tick_files(spark: SparkSession, path: str, files_per_trigger: int | None = 1) -> DataFrame:
    """Tick files as a stream; `time` must be a zoned timestamp for watermarks. None: all new files at once."""
    reader = spark.readStream.schema(TICK)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def write_topic(messages: DataFrame, topic: str, servers: str) -> None:
    """Publish (key, value) rows of a batch, at least once."""
    rows = messages.select(*[F.col(c).cast("string").alias(c) for c in ("key", "value") if c in messages.columns])
    rows.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).options(**PRODUCER).save()
