"""Checks of streaming queries, run over the whole table and stopped when the source is read."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlake.functions.columns import topic_name
from postlake.plans import fixtures
from postlake.plans.batch_checks import PARSED_SQL
from postlake.plans.registry import check, plain_time
from postlake.session import SESSION_SETTINGS, shared_folder
from postlake.sources.messages import parse_fields, parse_posts
from postlake.streaming import queries
from postlake.streaming.sources import open_messages, with_community

AVAILABLE = {"availableNow": True}
STAGED_FILES = 4
CLOSING_TIME = "2030-01-01"


def stream_session(spark):
    """A session for streams: their state has one partition per core, which later batch queries must not inherit."""
    session = spark.newSession()
    for name, value in SESSION_SETTINGS.items():
        if name.startswith("spark.sql."):
            session.conf.set(name, value)
    session.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return session


def streamed_messages(spark, folder, *kept):
    events = fixtures.streamed_events(stream_session(spark), folder)
    return fixtures.payload(fixtures.epoch_posts(events), "event_id", *kept)


def staged_messages(spark, folder):
    """The messages as several files, read one per micro-batch."""
    path = shared_folder(spark, "messages")
    fixtures.post_messages(spark, folder).select("value").repartition(STAGED_FILES).write.text(path)
    return open_messages(stream_session(spark), "text", path, maxFilesPerTrigger="1")


def run_ingest(spark, messages, fmt="parquet", unique_ids=False, base=None, checkpoint="checkpoint", monitor=None):
    base = base or shared_folder(spark, "ingest")
    write = queries.batch_writer(f"{base}/raw", f"{base}/quarantine", f"{base}/dead", fmt, unique_ids, monitor)
    queries.start_ingest(messages, write, f"{base}/{checkpoint}", trigger=AVAILABLE).awaitTermination()
    return base


FULL = ["id", "subreddit", "title", "author", "score", "num_comments", "created_utc", "url", "selftext"]
FULL_SQL = """
SELECT id, subreddit, title, author, score, num_comments,
       CAST(floor(epoch(created_utc)) AS DOUBLE) AS created_utc, url, selftext
"""


@check("stream_parse_posts", PARSED_SQL)
def stream_parse_posts(spark, folder):
    posts = parse_posts(streamed_messages(spark, folder))
    base = shared_folder(spark, "stream")
    queries.append_stream(posts, f"{base}/raw", f"{base}/checkpoint", trigger=AVAILABLE).awaitTermination()
    return spark.read.parquet(f"{base}/raw").select(
        "event_id", "id", "subreddit", "title", "author", "score", "num_comments", "created_utc", "url", "selftext"
    )


@check("stream_append_sink", "SELECT event_id, subreddit, title, score FROM posts")
def stream_append_sink(spark, folder):
    """Started twice from one checkpoint; the second run finds nothing new."""
    base = shared_folder(spark, "stream")
    for _ in range(2):
        posts = parse_fields(streamed_messages(spark, folder), "subreddit", "title", "score")
        queries.append_stream(posts, f"{base}/raw", f"{base}/checkpoint", trigger=AVAILABLE).awaitTermination()
    return spark.read.parquet(f"{base}/raw").select("event_id", "subreddit", "title", "score")


@check("stream_new_checkpoint", f"{FULL_SQL} FROM posts")
def stream_new_checkpoint(spark, folder):
    """Two halves of the table, each under a checkpoint of its own, into the same raw table."""
    base = shared_folder(spark, "ingest")
    for half in (0, 1):
        half_of = streamed_messages(spark, folder).filter(F.col("event_id") % 2 == half).select("value")
        run_ingest(spark, half_of, base=base, checkpoint=f"checkpoint-{half}")
    return spark.read.parquet(f"{base}/raw").select(*FULL)


@check(
    "stream_monitor",
    """
    SELECT subreddit, title, score, date_trunc('second', created_utc) AS created_utc FROM posts
    """,
)
def stream_monitor(spark, folder):
    """What the monitor of an ingest is given, batch by batch."""
    base = shared_folder(spark, "ingest")

    def monitor(shown):
        shown.write.mode("append").parquet(f"{base}/shown")

    run_ingest(spark, staged_messages(spark, folder), base=base, monitor=monitor)
    return spark.read.parquet(f"{base}/shown").withColumns(plain_time("created_utc"))


@check(
    "stream_bounded_batches",
    f"SELECT {STAGED_FILES} AS batches, count(*) AS post_count FROM posts",
)
def stream_bounded_batches(spark, folder):
    base = run_ingest(spark, staged_messages(spark, folder))
    raw = spark.read.parquet(f"{base}/raw")
    return raw.agg(F.count_distinct("batch_id").cast("int").alias("batches"), F.count(F.lit(1)).alias("post_count"))


@check("stream_timed_trigger", f"{FULL_SQL} FROM posts")
def stream_timed_trigger(spark, folder):
    """A query that triggers by time, over files of which one is empty; stopped when everything is written."""
    path, base = shared_folder(spark, "messages"), shared_folder(spark, "ingest")
    lines = fixtures.post_messages(spark, folder).select("value")
    lines.limit(0).coalesce(1).write.text(path)
    lines.repartition(STAGED_FILES).write.mode("append").text(path)
    stream = open_messages(stream_session(spark), "text", path, maxFilesPerTrigger="1")
    write = queries.batch_writer(f"{base}/raw", f"{base}/quarantine", f"{base}/dead", unique_ids=False)
    query = queries.start_ingest(stream, write, f"{base}/checkpoint", trigger={"processingTime": "0 seconds"})
    query.processAllAvailable()
    query.stop()
    return spark.read.parquet(f"{base}/raw").select(*FULL)


@check("stream_multi_source", "SELECT event_id, subreddit, title, subreddit AS community FROM posts")
def stream_multi_source(spark, folder):
    """One query over a source that carries all topics; the table has a folder per community."""
    topic = topic_name(F.col("subreddit")).alias("topic")
    messages = with_community(streamed_messages(spark, folder, topic))
    base = shared_folder(spark, "stream")
    posts = parse_fields(messages, "subreddit", "title").select("event_id", "subreddit", "title", "community")
    queries.append_per_community(posts, f"{base}/raw", f"{base}/checkpoint", trigger=AVAILABLE).awaitTermination()
    return spark.read.parquet(f"{base}/raw")


@check("stream_dead_letter", f"{FULL_SQL} FROM posts")
def stream_dead_letter(spark, folder):
    """The raw table cannot be written, so every message ends in the dead-letter folder."""
    base = run_ingest(spark, staged_messages(spark, folder), fmt="format_without_connector")
    return parse_fields(spark.read.parquet(f"{base}/dead").select("value"), *FULL)


@check(
    "stream_batch_dedup",
    f"""
    {FULL_SQL} FROM (
      SELECT *, row_number() OVER (
        PARTITION BY id ORDER BY date_trunc('second', created_utc) DESC NULLS LAST, event_id) AS n
      FROM posts
    ) AS ranked WHERE n = 1
    """,
)
def stream_batch_dedup(spark, folder):
    """One batch; of rows with the same id and time the one that arrived first stays."""
    messages = streamed_messages(spark, folder).select(F.col("event_id").alias("arrival"), "value")
    base = run_ingest(spark, messages, unique_ids=True)
    return spark.read.parquet(f"{base}/raw").select(*FULL)


@check("stream_quarantine", "SELECT text AS message FROM documents")
def stream_quarantine(spark, folder):
    documents = fixtures.streamed_table(stream_session(spark), folder, "documents")
    base = run_ingest(spark, documents.select(F.col("text").alias("value")))
    return spark.read.parquet(f"{base}/quarantine").select("message")


def unique_titles(spark, folder, parts=1):
    """One span covers the whole table, so every later repeat of a title is dropped."""
    posts = parse_fields(streamed_messages(spark, folder), "title", "created_utc").select(
        "event_id", "title", F.timestamp_seconds("created_utc").alias("created_at")
    )
    unique = queries.dedup_within_watermark(posts, ["title"], "created_at", "40 days", parts)
    base = shared_folder(spark, "stream")
    queries.append_stream(unique, f"{base}/raw", f"{base}/checkpoint", trigger=AVAILABLE).awaitTermination()
    return spark.read.parquet(f"{base}/raw").select("title")


@check("stream_dedup_watermark", "SELECT DISTINCT title FROM posts")
def stream_dedup_watermark(spark, folder):
    return unique_titles(spark, folder)


@check("stream_dedup_spread", "SELECT DISTINCT title FROM posts")
def stream_dedup_spread(spark, folder):
    """Spread over parts: the same rows as without them."""
    return unique_titles(spark, folder, 32)


@check(
    "stream_daily_counts",
    "SELECT CAST(created_utc AS DATE) AS post_date, subreddit, count(*) AS post_count FROM posts GROUP BY 1, 2",
)
def stream_daily_counts(spark, folder):
    """Counts are appended once the watermark has closed their day; messages past all days close the last one."""
    posts = parse_fields(streamed_messages(spark, folder), "subreddit", "created_utc")
    closing = posts.filter("event_id % 100 = 0").select(
        F.lit(None).cast("string").alias("subreddit"), F.lit(CLOSING_TIME).cast("timestamp").alias("created_at")
    )
    timed = posts.select("subreddit", F.timestamp_seconds("created_utc").alias("created_at")).unionByName(closing)
    base = shared_folder(spark, "stream")
    counted = queries.daily_counts(timed, "created_at", "2 days")
    queries.append_stream(counted, f"{base}/counts", f"{base}/checkpoint", trigger=AVAILABLE).awaitTermination()
    return spark.read.parquet(f"{base}/counts")
