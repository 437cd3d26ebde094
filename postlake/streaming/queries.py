"""Streaming queries: raw append, monitor, per-batch ingest, stateful dedup, daily counts."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postlake.functions.columns import epoch_to_timestamp
from postlake.operators.dedup import dedup_latest
from postlake.operators.maintenance import commits_by_itself
from postlake.schema import ARRIVAL_COLUMN, BATCH_COLUMN, RUN_COLUMN, payload_fields
from postlake.sources.messages import good_posts, malformed, parse_messages

logger = logging.getLogger(__name__)

# Fixed value: the pause between micro-batches.
TRIGGER = {"processingTime": "180 seconds"}


def append_stream(
    posts: DataFrame, path: str, checkpoint: str, name: str | None = None, fmt: str = "parquet", trigger=None
) -> StreamingQuery:
    """Append a stream to a table. Restarting from the checkpoint writes every row once."""
    writer = posts.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**(trigger or TRIGGER)).start(path)


def monitor_columns(posts: DataFrame) -> DataFrame:
    """The four columns shown while a stream runs."""
    return posts.select("subreddit", "title", "score", epoch_to_timestamp(F.col("created_utc")).alias("created_utc"))


def console_monitor(posts: DataFrame, checkpoint: str, name: str | None = None, trigger=None) -> StreamingQuery:
    writer = monitor_columns(posts).writeStream.format("console").outputMode("update")
    writer = writer.option("truncate", "true").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**(trigger or TRIGGER)).start()


def unique_in_batch(posts: DataFrame, arrival: str | None = None) -> DataFrame:
    """One row per id inside a micro-batch. Repeats in other batches pass; see `dedup_within_watermark`."""
    return dedup_latest(posts, arrival)


def running_query(batch: DataFrame) -> str:
    """The id of the stream that a micro-batch belongs to; it lives in the checkpoint, so a restart keeps it."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "unnamed"


def append_batch(rows: DataFrame, path: str, fmt: str, run: str, batch_id: int) -> None:
    """Add a micro-batch to a table so that its replay adds nothing.

    Plain files: a folder per stream and batch, which a replay overwrites and no other stream touches. A table format:
    one table, appended in one commit that names stream and batch, by which the format skips a commit that it already has.
    """
    if commits_by_itself(fmt):
        named = rows.withColumns({RUN_COLUMN: F.lit(run), BATCH_COLUMN: F.lit(batch_id)})
        writer = named.write.format(fmt).mode("append").option("mergeSchema", "true")
        writer.option("txnAppId", run).option("txnVersion", batch_id).save(path)
    else:
        rows.write.format(fmt).mode("overwrite").save(f"{path}/{RUN_COLUMN}={run}/{BATCH_COLUMN}={batch_id}")


def batch_writer(
    raw_path: str,
    quarantine_path: str,
    dead_letter_path: str,
    fmt: str = "parquet",
    unique_ids: bool = True,
    monitor: Callable[[DataFrame], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` function that writes posts and malformed messages.

    The batch is kept as it came, which is far smaller than its parsed form, so the source is read once. Its raw rows
    are written once and the monitor reads the columns it shows from there. Rows carry the id of the stream and the batch
    number; `append_batch` says why neither a replay nor a new checkpoint loses or repeats rows. When the raw table
    cannot be written, the messages go to the dead-letter folder and the stream continues; that folder can be given
    to this function again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        run = running_query(batch)
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            arrival = ARRIVAL_COLUMN if ARRIVAL_COLUMN in batch.columns else None
            posts = good_posts(parse_messages(batch)).withColumn("retrieved_at", F.current_timestamp())
            posts = unique_in_batch(posts, arrival) if unique_ids else posts
            try:
                append_batch(posts, raw_path, fmt, run, batch_id)
            except Exception:
                logger.exception("batch %s not written to %s, kept in %s", batch_id, raw_path, dead_letter_path)
                append_batch(batch, dead_letter_path, "parquet", run, batch_id)
            append_batch(malformed(batch), quarantine_path, "parquet", run, batch_id)
            if monitor:
                shown = parse_messages(batch, payload_fields("id", "subreddit", "title", "score", "created_utc"))
                monitor(monitor_columns(good_posts(shown)))
        finally:
            batch.unpersist()

    return write


def start_ingest(
    messages: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, name=None, trigger=None
) -> StreamingQuery:
    """One query that reads the source once and feeds raw table, quarantine and monitor."""
    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**(trigger or TRIGGER)).start()


def append_per_community(
    posts: DataFrame, path: str, checkpoint: str, column: str = "community", fmt: str = "parquet", name=None, trigger=None
) -> StreamingQuery:
    """One query that reads the source once and keeps a folder of the table per community.

    Where communities must be able to fail apart, subscribe each of them with a query of its own, as the ingest job does.
    """
    writer = posts.writeStream.format(fmt).outputMode("append").partitionBy(column)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.queryName(name) if name else writer
    return writer.trigger(**(trigger or TRIGGER)).start(path)


def dedup_within_watermark(
    posts: DataFrame, keys: Sequence[str], event_time: str, delay: str, parts: int = 1
) -> DataFrame:
    """The first arrival per key and span of event time; spans are `delay` long and aligned to the epoch.

    State is kept until the watermark is `delay` past the first row, when every other row of its span is late and dropped
    anyway. A repeat in another span passes and is removed by the batch deduplication. Where a key may hold a large share of
    a micro-batch, set `parts`: rows are then first deduplicated in so many parts by a hash of the whole row, in a state of
    their own, so the task that owns the key sees at most one row per part and span. Since a span ends at the same time in
    every part, the number of parts changes which of several equal first arrivals stays, but never how many.
    """
    timed = posts.withWatermark(event_time, delay).withColumn("_window", F.window(event_time, delay))
    timed = timed.withColumn("_span", F.unix_micros("_window.start")).drop("_window")
    if parts > 1:
        parted = timed.withColumn("_part", F.pmod(F.xxhash64(*posts.columns), F.lit(parts)))
        timed = parted.dropDuplicatesWithinWatermark([*keys, "_span", "_part"]).drop("_part")
    return timed.dropDuplicatesWithinWatermark([*keys, "_span"]).drop("_span")


def daily_counts(posts: DataFrame, event_time: str, delay: str) -> DataFrame:
    """Posts per day and community as they stream in."""
    timed = posts.withWatermark(event_time, delay)
    counted = timed.groupBy(F.window(event_time, "1 day"), "subreddit").agg(F.count(F.lit(1)).alias("post_count"))
    return counted.select(F.to_date("window.start").alias("post_date"), "subreddit", "post_count")
