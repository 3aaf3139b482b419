"""One way in and one way out for every stream: topics on a broker, or folders of JSON lines."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chatterlens import schemas as S
from chatterlens.operators.records import json_values


@dataclass
class Topic:
    """Where a stream lives: ``servers`` set means a broker topic, else ``name`` is a folder."""

    name: str
    servers: str | None = None
    starting: str = "earliest"
    options: dict = field(default_factory=dict)


def source(spark: SparkSession, topic: Topic, per_trigger: int | None = None) -> DataFrame:
    """Record values as text in ``value``; a broker's arrival time, partition and offset come along.

    ``per_trigger`` bounds a micro-batch: offsets on a broker, files in a folder.
    """
    if topic.servers:
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", topic.servers)
            .option("subscribe", topic.name)
            .option("startingOffsets", topic.starting)
        )
        if per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", per_trigger)
        loaded = reader.options(**topic.options).load()
        return loaded.select(F.col("value").cast("string").alias("value"), "timestamp", "partition", "offset")
    reader = spark.readStream.option("recursiveFileLookup", True)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.options(**topic.options).text(topic.name)


def sink(
    records: DataFrame,
    topic: Topic,
    checkpoint: str,
    event_time: str | None = None,
    available_now: bool = False,
    interval: int = S.CHECKPOINT_SECONDS,
) -> StreamingQuery:
    """Write rows as JSON values. Folders receive each row once, a broker at least once."""
    values = records if records.columns == ["value"] else json_values(records, event_time if topic.servers else None)
    writer = values.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{interval} seconds")
    if topic.servers:
        writer = writer.format("kafka").option("kafka.bootstrap.servers", topic.servers).option("topic", topic.name)
        return writer.options(**topic.options).start()
    return writer.format("text").option("path", topic.name).start()


def write_values(values: DataFrame, topic: Topic, batch_id: int) -> None:
    """One micro-batch of JSON values; in a folder a replay overwrites its own values."""
    if topic.servers:
        writer = values.write.format("kafka").option("kafka.bootstrap.servers", topic.servers).option("topic", topic.name)
        writer.options(**topic.options).save()
    else:
        values.write.mode("overwrite").text(f"{topic.name}/batch_id={batch_id}")


def console_sink(records: DataFrame, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    writer = records.writeStream.format("console").option("truncate", False).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def distinct_within(records: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """Drop repeats that an at-least-once hop delivered within ``delay``."""
    return records.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
