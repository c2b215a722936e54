"""Message topics. Connection options are arguments; none live in code.

The format is injectable: ``kafka`` on a cluster with the connector on its class
path, a file format where a folder stands for the topic.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tickloom.schemas import TOPIC_ROW


def sasl_options(servers: str, username: str, password: str, protocol: str = "SASL_SSL", mechanism: str = "PLAIN") -> dict[str, str]:
    """Connection options shared by source and sink."""
    module = "org.apache.kafka.common.security.plain.PlainLoginModule"
    return {
        "kafka.bootstrap.servers": servers,
        "kafka.security.protocol": protocol,
        "kafka.sasl.mechanism": mechanism,
        "kafka.sasl.jaas.config": f'{module} required username="{username}" password="{password}";',
    }


def stream_topic(
    spark: SparkSession,
    topic: str,
    options: Mapping[str, str] | None = None,
    *,
    starting: str = "latest",
    max_per_trigger: int | None = None,
    group_id: str | None = None,
    fmt: str = "kafka",
    schema: T.StructType = TOPIC_ROW,
) -> DataFrame:
    """Endless topic rows; ``topic`` is a folder for file formats."""
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        reader = reader.option("subscribe", topic).option("startingOffsets", starting)
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        if group_id:
            reader = reader.option("kafka.group.id", group_id)
        return reader.load()
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    return reader.schema(schema).load(topic)


def read_topic(
    spark: SparkSession,
    topic: str,
    options: Mapping[str, str] | None = None,
    *,
    partitions: Sequence[int] | None = None,
    starting: str = "earliest",
    ending: str = "latest",
    fmt: str = "kafka",
    schema: T.StructType = TOPIC_ROW,
) -> DataFrame:
    """A bounded read between two offsets, of all or of named partitions."""
    reader = spark.read.format(fmt).options(**(options or {}))
    if fmt != "kafka":
        return reader.schema(schema).load(topic)
    if partitions is None:
        reader = reader.option("subscribe", topic)
    else:
        reader = reader.option("assign", json.dumps({topic: list(partitions)}))
    return reader.option("startingOffsets", starting).option("endingOffsets", ending).load()


def write_topic(
    messages: DataFrame, topic: str, options: Mapping[str, str] | None = None, *, fmt: str = "kafka", mode: str = "append"
) -> None:
    """Batch-write ``key, value`` messages, also from inside a micro-batch."""
    writer = messages.select("key", "value").write.format(fmt).options(**(options or {})).mode(mode)
    if fmt == "kafka":
        writer.option("topic", topic).save()
    else:
        writer.save(topic)


def as_text(topic: DataFrame) -> DataFrame:
    """Key and value as text, the other columns as they are."""
    return topic.withColumns({"key": F.col("key").cast("string"), "value": F.col("value").cast("string")})
