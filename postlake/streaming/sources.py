"""Opening message streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from postlake.functions.columns import label_of_topic
from postlake.schema import ARRIVAL_COLUMN, TOPIC_PREFIX

# Consumer settings of the message stream.
CONSUMER_SETTINGS = {
    "failOnDataLoss": "false",
    "kafka.session.timeout.ms": "45000",
    "kafka.heartbeat.interval.ms": "10000",
    "kafka.max.poll.interval.ms": "120000",
    "kafka.connections.max.idle.ms": "540000",
    "kafka.request.timeout.ms": "60000",
    "kafka.isolation.level": "read_committed",
}


FILE_SOURCES = ("text", "json", "csv", "parquet", "orc", "delta")


def kafka_options(
    servers: str, subreddits: Sequence[str], starting: str = "latest", max_messages: int | None = None,
    max_delay: str | None = None,
) -> dict[str, str]:
    """Options for the `kafka` source over the topics of several communities.

    `starting` counts only without a checkpoint. `max_messages` paces the micro-batches: one starts when as many have
    arrived or `max_delay` has passed, and takes as many at most. Leave it unset to take whatever has arrived, which is
    what a large stream needs.
    """
    topics = ",".join(TOPIC_PREFIX + name for name in subreddits)
    options = {"kafka.bootstrap.servers": servers, "subscribe": topics, "startingOffsets": starting}
    if max_messages:
        options["maxOffsetsPerTrigger"] = str(max_messages)
        if max_delay:
            options |= {"minOffsetsPerTrigger": str(max_messages), "maxTriggerDelay": max_delay}
    return options | CONSUMER_SETTINGS


def batch_bounds(fmt: str, rows: int | None = None, files: int | None = None, size: str | None = None) -> dict[str, str]:
    """Options that bound a micro-batch of a source: rows of a message broker, files or bytes of file sources and tables.

    A bound that the source cannot keep is refused, not ignored.
    """
    known = {
        "kafka": {"rows": "maxOffsetsPerTrigger"},
        **dict.fromkeys(FILE_SOURCES, {"files": "maxFilesPerTrigger", "size": "maxBytesPerTrigger"}),
    }
    asked = {name: value for name, value in (("rows", rows), ("files", files), ("size", size)) if value is not None}
    refused = sorted(set(asked) - set(known.get(fmt, {})))
    if refused:
        raise ValueError(f"the source {fmt!r} has no bound by {' or '.join(refused)}")
    return {known[fmt][name]: str(value) for name, value in asked.items()}


def open_messages(
    spark: SparkSession, fmt: str = "kafka", path: str | None = None, schema: StructType | None = None, **options: str
) -> DataFrame:
    """A streaming frame with a `value` column: `kafka`, `text` files, or any other streaming source."""
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def with_arrival(messages: DataFrame) -> DataFrame:
    """The message with its order of arrival: time, partition and offset, which no two messages of a topic share."""
    return messages.select("value", F.struct("timestamp", "partition", "offset").alias(ARRIVAL_COLUMN))


def with_community(messages: DataFrame, topic: str = "topic") -> DataFrame:
    """The community a message belongs to, read from its topic."""
    return messages.withColumn("community", label_of_topic(F.col(topic)))
