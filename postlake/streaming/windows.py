"""Event-time operators: bursts of posts, posts with later updates, and rows behind the watermark."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.schema import BATCH_COLUMN, RUN_COLUMN
from postlake.sources.tables import read_if_present
from postlake.streaming.queries import append_batch, running_query



def bursts(posts: DataFrame, event_time: str, gap: str, delay: str, keys: Sequence[str] = ("author",)) -> DataFrame:
    """Runs of posts per key in which no two neighbours are more than `gap` apart; of a stream or of a table.

    On a stream the state holds one row per open burst. A late row that stands between two bursts joins them, as long as
    it is not behind the watermark. A burst is returned once the watermark has passed its last post by `gap`.
    """
    timed = posts.withWatermark(event_time, delay)
    grouped = timed.groupBy(F.session_window(event_time, gap).alias("_burst"), *keys)
    return grouped.agg(
        F.min(event_time).alias("first_post"),
        F.max(event_time).alias("last_post"),
        F.count(F.lit(1)).alias("post_count"),
    ).drop("_burst")


def with_updates(
    posts: DataFrame,
    updates: DataFrame,
    within: str,
    delay: str,
    update_delay: str | None = None,
    key: str = "id",
    created: str = "created_at",
    updated: str = "updated_at",
    how: str = "left_outer",
) -> DataFrame:
    """Each post with its updates that came no later than `within` after it; two streams, or two tables.

    Both sides are kept as state. The interval lets Spark evict a post when the watermark has passed the last update that
    could belong to it; a post without updates is returned then, with nulls. The later of the two streams sets the pace.
    """
    left = posts.withWatermark(created, delay)
    right = updates.withColumnRenamed(key, "_key").withWatermark(updated, update_delay or delay)
    own = (
        (F.col(key) == F.col("_key"))
        & (F.col(updated) >= F.col(created))
        & (F.col(updated) <= F.col(created) + F.expr(f"INTERVAL {within}"))
    )
    return left.join(right, own, how).drop("_key")


def read_marks(spark: SparkSession, path: str) -> DataFrame | None:
    return read_if_present(spark, path, "parquet")


def late_splitter(
    kept_path: str, late_path: str, marks_path: str, event_time: str, delay: str, fmt: str = "parquet"
) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` function that keeps rows behind the watermark in a table of their own.

    The watermark of a batch is the latest event time of the stream's earlier batches, less `delay`. It never trails the
    one of a stateful operator with the same delay, which uses the watermark of the batch before; so such an operator
    over the kept rows drops none. Rows without a time are kept. What each batch held is written last to `marks_path`: the
    latest time, rows, late rows and the watermark, from which `late_counts` tells that kept and late rows are all rows.
    A replay reads only the marks of earlier batches, so it decides as the first run did and overwrites what that wrote.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, run = batch.sparkSession, running_query(batch)
        marks, bound = read_marks(spark, marks_path), None
        if marks is not None:
            earlier = marks.filter((F.col(RUN_COLUMN) == run) & (F.col(BATCH_COLUMN) < batch_id))
            bound = earlier.agg(F.unix_micros(F.max("latest") - F.expr(f"INTERVAL {delay}")).alias("bound")).collect()[0]["bound"]
        time = F.col(event_time).cast("timestamp")
        marked = batch.withColumn("_watermark", F.timestamp_micros(F.lit(bound).cast("long")))
        marked = marked.withColumn("_late", F.coalesce(time < F.col("_watermark"), F.lit(False))).persist()
        try:
            on_time = marked.filter(~F.col("_late")).drop("_late", "_watermark")
            late = marked.filter("_late").drop("_late").withColumnRenamed("_watermark", "watermark")
            append_batch(on_time, kept_path, fmt, run, batch_id)
            append_batch(late, late_path, fmt, run, batch_id)
            mark = marked.agg(
                F.max(time).alias("latest"),
                F.count(F.lit(1)).alias("post_count"),
                F.count_if("_late").alias("late_count"),
                F.max("_watermark").alias("watermark"),
            )
            append_batch(mark, marks_path, "parquet", run, batch_id)
        finally:
            marked.unpersist()

    return write


def late_counts(spark: SparkSession, marks_path: str) -> DataFrame:
    """Rows, late rows and watermark per stream and batch."""
    return read_marks(spark, marks_path).select(RUN_COLUMN, BATCH_COLUMN, "post_count", "late_count", "watermark")
