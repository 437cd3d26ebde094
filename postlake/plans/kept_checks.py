"""Checks of what is kept beside the tables: counts, sketches, drift of fields and progress of streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlake.operators import kept_counts
from postlake.operators.dedup import dedup_latest
from postlake.plans import fixtures
from postlake.plans.registry import check
from postlake.plans.stream_checks import AVAILABLE, stream_session
from postlake.plans.window_checks import timed_posts, write_part
from postlake.session import shared_folder
from postlake.sources import drift
from postlake.streaming import progress, queries


@check(
    "kept_counts",
    """
    SELECT CAST(created_utc AS DATE) AS post_date, subreddit, count(*) AS post_count FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY created_utc DESC, event_id) AS n FROM posts
    ) AS ranked WHERE n = 1 GROUP BY 1, 2
    """,
)
def kept_counts_after_rewrite(spark, folder):
    """Three batches, one of them replayed, then a rewrite that leaves one row per id: the kept counts follow."""
    posts, path = fixtures.posts(spark, folder), shared_folder(spark, "counts")
    for number in (0, 1, 2, 1):
        kept_counts.add_counts(posts.filter(F.col("event_id") % 3 == number), path, f"batch-{number}")
    kept_counts.retract_counts(posts, dedup_latest(posts, "event_id"), path, "rewrite-1")
    return kept_counts.kept_counts(spark, path)


RANGES = [("2024-01-01", "2024-01-30"), ("2024-01-05", "2024-01-06"), ("2024-01-10", "2024-01-24"), ("2024-01-17", "2024-01-17")]


@check(
    "distinct_sketches",
    " UNION ALL ".join(
        f"""
        SELECT '{first}' AS first_day, subreddit, count(DISTINCT author) AS authors, count(DISTINCT title) AS titles,
               true AS in_bound
        FROM posts WHERE CAST(created_utc AS DATE) BETWEEN '{first}' AND '{last}' GROUP BY subreddit
        """
        for first, last in RANGES
    ),
)
def distinct_sketches(spark, folder):
    """Daily sketches, stored once and united over several ranges, next to the exact counts."""
    posts, path = fixtures.posts(spark, folder), shared_folder(spark, "sketches")
    kept_counts.sketches(posts, "author", "title").write.parquet(path)
    stored = spark.read.parquet(path)

    def near(name, exact):
        return F.abs(F.col(f"{name}_estimate") - F.col(exact)) <= F.ceil(F.col(exact) * kept_counts.ERROR_BOUND)

    found = []
    for first, last in RANGES:
        estimated = kept_counts.distinct_in_range(stored, first, last, "author", "title", per=["subreddit"])
        inside = kept_counts.by_day(posts).filter(F.col("post_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
        exact = inside.groupBy("subreddit").agg(F.count_distinct("author").alias("authors"), F.count_distinct("title").alias("titles"))
        in_bound = near("author", "authors") & near("title", "titles")
        found.append(
            exact.join(estimated, "subreddit").select(
                F.lit(first).alias("first_day"), "subreddit", "authors", "titles", in_bound.alias("in_bound")
            )
        )
    whole = found[0]
    for part in found[1:]:
        whole = whole.unionAll(part)
    return whole


@check(
    "schema_drift",
    """
    SELECT 'award_count' AS field, 'BIGINT' AS type, 'new field' AS status, count(*) AS messages,
           CAST(min(event_id // 500) AS BIGINT) AS first_batch FROM posts WHERE event_id % 3 = 0
    UNION ALL
    SELECT 'geo', 'OBJECT', 'new field', count(*), CAST(min(event_id // 500) AS BIGINT) FROM posts WHERE event_id % 5 = 4
    UNION ALL
    SELECT 'score', 'STRING', 'new type', count(*), CAST(min(event_id // 500) AS BIGINT) FROM posts WHERE event_id % 50 = 7
    """,
)
def schema_drift(spark, folder):
    """Messages with two fields that no schema knows and a number that sometimes comes as text."""
    posts = fixtures.raw_posts(spark, folder)
    extra = [
        F.when(F.col("event_id") % 3 == 0, 1).alias("award_count"),
        F.when(F.col("event_id") % 5 == 4, F.struct(F.lit(1.5).alias("lat"))).alias("geo"),
    ]
    plain = F.to_json(F.struct("id", "title", "created_utc", "score", *extra))
    as_text = F.to_json(F.struct("id", "title", "created_utc", F.lit("n/a").alias("score"), *extra))
    value = F.when(F.col("event_id") % 50 == 7, as_text).otherwise(plain).alias("value")
    messages = posts.select(F.expr("event_id DIV 500").alias("batch"), value)
    return drift.drift(messages, batch="batch")


@check(
    "stream_progress",
    "SELECT CAST(event_id % 4 AS INTEGER) AS batch_id, count(*) AS input_rows FROM posts GROUP BY 1",
)
def stream_progress(spark, folder):
    """A stream over four parts, started anew after each: what the progress table says about every batch."""
    posts, base, session = timed_posts(spark, folder), shared_folder(spark, "progress"), stream_session(spark)
    listener = progress.ProgressTable(spark, f"{base}/progress")
    session.streams.addListener(listener)
    try:
        for part in range(4):
            write_part(posts.filter(F.col("event_id") % 4 == part), f"{base}/parts")
            stream = session.readStream.schema(posts.schema).option("maxFilesPerTrigger", "1").parquet(f"{base}/parts")
            queries.append_stream(stream, f"{base}/out", f"{base}/checkpoint", trigger=AVAILABLE).awaitTermination()
        return progress.awaited(spark, f"{base}/progress", 4).select("batch_id", "input_rows")
    finally:
        session.streams.removeListener(listener)
