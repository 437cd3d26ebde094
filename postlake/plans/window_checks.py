"""Checks of event-time operators: bursts, updates, late rows and publishing from a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlake.operators import search_index
from postlake.operators.publish import ServingTable
from postlake.plans import fixtures
from postlake.plans.registry import check, plain_time
from postlake.plans.stream_checks import AVAILABLE, CLOSING_TIME, stream_session
from postlake.session import shared_folder
from postlake.streaming import queries, windows
from postlake.streaming.publishing import indexed_writer, new_posts_writer

OPEN_LONG = "60 days"  # longer than the table, so no row of it is late


def timed_posts(spark, folder, *names):
    """Posts with their time as a timestamp."""
    posts = fixtures.posts(spark, folder)
    return posts.select("event_id", *names, F.col("created_utc").cast("timestamp").alias("created_at"))


def write_part(rows, path):
    """One file, hence one micro-batch of a stream that takes a file at a time."""
    rows.coalesce(1).write.mode("append").parquet(path)


def stream_of(spark, path, schema):
    return stream_session(spark).readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(path)


def started_per_part(spark, parts, start):
    """Write the parts to a folder one after the other and start the stream anew after each; it goes on from its checkpoint."""
    path = shared_folder(spark, "parts")
    for part in parts:
        write_part(part, path)
        start(stream_of(spark, path, part.schema)).awaitTermination()


def at_closing_time(rows, **values):
    """A row past all others, which moves the watermark over them."""
    columns = [F.lit(values.get(field.name)).cast(field.dataType).alias(field.name) for field in rows.schema]
    return rows.sparkSession.range(1).select(*columns)


BURSTS_SQL = """
SELECT author, min(created_utc) AS first_post, max(created_utc) AS last_post, count(*) AS post_count
FROM (
  SELECT author, created_utc, sum(breaks) OVER (PARTITION BY author ORDER BY created_utc, event_id) AS burst
  FROM (
    SELECT author, created_utc, event_id,
           CASE WHEN created_utc - lag(created_utc) OVER (PARTITION BY author ORDER BY created_utc, event_id)
                     <= INTERVAL 3 HOUR THEN 0 ELSE 1 END AS breaks
    FROM posts
  ) AS marked
) AS numbered
GROUP BY author, burst
"""
BURST_COLUMNS = ["author", "first_post", "last_post", "post_count"]


@check("author_bursts", BURSTS_SQL)
def author_bursts(spark, folder):
    found = windows.bursts(timed_posts(spark, folder, "author"), "created_at", "3 hours", OPEN_LONG)
    return found.select(*BURST_COLUMNS).withColumns(plain_time("first_post", "last_post"))


@check("stream_bursts", BURSTS_SQL)
def stream_bursts(spark, folder):
    """Rows dealt over three parts, so later ones join bursts of earlier ones; the stream is restarted between parts."""
    posts = timed_posts(spark, folder, "author")
    parts = [posts.filter(F.col("event_id") % 3 == at) for at in range(3)] + [at_closing_time(posts, created_at=CLOSING_TIME)]
    base = shared_folder(spark, "stream")

    def start(stream):
        found = windows.bursts(stream, "created_at", "3 hours", OPEN_LONG)
        return queries.append_stream(found, f"{base}/bursts", f"{base}/checkpoint", trigger=AVAILABLE)

    started_per_part(spark, parts, start)
    return spark.read.parquet(f"{base}/bursts").select(*BURST_COLUMNS).withColumns(plain_time("first_post", "last_post"))


UPDATES_SQL = """
SELECT post.id, post.created_utc AS created_at, up.created_utc AS updated_at, up.score AS new_score
FROM (SELECT * FROM posts WHERE event_id % 4 = 0) AS post
LEFT JOIN (SELECT * FROM posts WHERE event_id % 4 <> 0) AS up
  ON up.id = post.id AND up.created_utc BETWEEN post.created_utc AND post.created_utc + INTERVAL 10 MINUTE
"""
UPDATE_COLUMNS = ["id", "created_at", "updated_at", "new_score"]


def posts_and_updates(spark, folder):
    """The first of the rows of an id as the post, the others as later scores of it."""
    rows = timed_posts(spark, folder, "id", "score")
    posts = rows.filter("event_id % 4 = 0").select("event_id", "id", "created_at")
    updates = rows.filter("event_id % 4 <> 0").select(
        "event_id", "id", F.col("created_at").alias("updated_at"), F.col("score").alias("new_score")
    )
    return posts, updates


@check("score_updates", UPDATES_SQL)
def score_updates(spark, folder):
    posts, updates = posts_and_updates(spark, folder)
    found = windows.with_updates(posts.drop("event_id"), updates.drop("event_id"), "10 minutes", OPEN_LONG)
    return found.select(*UPDATE_COLUMNS).withColumns(plain_time("created_at", "updated_at"))


@check("stream_score_updates", UPDATES_SQL)
def stream_score_updates(spark, folder):
    """Two streams, of which one brings its updates before the other has brought the posts, restarted in between."""
    posts, updates = posts_and_updates(spark, folder)
    early, late = F.col("event_id") % 8 < 4, F.col("event_id") % 8 >= 4
    post_parts = [posts.filter(early), posts.filter(late), at_closing_time(posts, id="closing post", created_at=CLOSING_TIME)]
    update_parts = [
        updates.filter(late),
        updates.filter(early),
        at_closing_time(updates, id="closing update", updated_at=CLOSING_TIME),
    ]
    base = shared_folder(spark, "stream")
    paths = [f"{base}/posts", f"{base}/updates"]
    session = stream_session(spark)
    for own, other in zip(post_parts, update_parts):
        write_part(own, paths[0])
        write_part(other, paths[1])
        left, right = (
            session.readStream.schema(part.schema).parquet(path).drop("event_id") for part, path in zip((own, other), paths)
        )
        found = windows.with_updates(left, right, "10 minutes", OPEN_LONG)
        queries.append_stream(found, f"{base}/joined", f"{base}/checkpoint", trigger=AVAILABLE).awaitTermination()
    return spark.read.parquet(f"{base}/joined").select(*UPDATE_COLUMNS).withColumns(plain_time("created_at", "updated_at"))


LATE_SQL = """
WITH earlier AS (
  SELECT part, max(latest) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 2 DAY AS bound
  FROM (SELECT event_id % 4 AS part, max(created_utc) AS latest FROM posts GROUP BY 1) AS parts
)
SELECT event_id, coalesce(created_utc < bound, false) AS late
FROM posts JOIN earlier ON part = event_id % 4
"""


@check("stream_late_rows", LATE_SQL)
def stream_late_rows(spark, folder):
    """Four parts of the same days: from the second one on, what is two days behind goes to the late table."""
    posts = timed_posts(spark, folder, "author")
    base = shared_folder(spark, "stream")
    write = windows.late_splitter(f"{base}/kept", f"{base}/late", f"{base}/marks", "created_at", "2 days")

    def start(stream):
        return queries.start_ingest(stream, write, f"{base}/checkpoint", trigger=AVAILABLE)

    started_per_part(spark, [posts.filter(F.col("event_id") % 4 == at) for at in range(4)], start)
    kept, late = (spark.read.parquet(f"{base}/{name}").select("event_id") for name in ("kept", "late"))
    return kept.withColumn("late", F.lit(False)).unionAll(late.withColumn("late", F.lit(True)))


@check(
    "stream_late_counts",
    f"""
    SELECT CAST(event_id % 4 AS INTEGER) AS batch_id, count(*) AS post_count, CAST(count_if(late) AS BIGINT) AS late_count
    FROM ({LATE_SQL}) AS marked GROUP BY 1
    """,
)
def stream_late_counts(spark, folder):
    """What the marks of the same stream say about each batch."""
    posts = timed_posts(spark, folder)
    base = shared_folder(spark, "stream")
    write = windows.late_splitter(f"{base}/kept", f"{base}/late", f"{base}/marks", "created_at", "2 days")

    def start(stream):
        return queries.start_ingest(stream, write, f"{base}/checkpoint", trigger=AVAILABLE)

    started_per_part(spark, [posts.filter(F.col("event_id") % 4 == at) for at in range(4)], start)
    return windows.late_counts(spark, f"{base}/marks").select(F.col("batch_id").cast("int"), "post_count", "late_count")


@check(
    "stream_skip_published",
    """
    SELECT post_id, event_id, score FROM (
      SELECT id AS post_id, event_id, score,
             row_number() OVER (PARTITION BY id ORDER BY event_id // 3 % 4, created_utc DESC, event_id) AS n
      FROM posts WHERE CAST(id AS BIGINT) % 3 <> 0
    ) AS ranked WHERE n = 1
    """,
)
def stream_skip_published(spark, folder):
    """A third of the ids is published already; the rows of an id come in several parts, of which the first one counts."""
    posts = fixtures.posts(spark, folder).withColumnRenamed("id", "post_id")
    base = shared_folder(spark, "stream")
    posts.filter(F.col("post_id").cast("long") % 3 == 0).select("post_id").write.parquet(f"{base}/serving")
    write = new_posts_writer(f"{base}/published", ServingTable(path=f"{base}/serving"), "event_id")

    def start(stream):
        return queries.start_ingest(stream, write, f"{base}/checkpoint", trigger=AVAILABLE)

    part = F.floor(F.col("event_id") / 3) % 4
    started_per_part(spark, [posts.filter(part == at) for at in range(4)], start)
    return spark.read.parquet(f"{base}/published").select("post_id", "event_id", "score")


@check(
    "stream_search_index",
    """
    WITH found AS (
      SELECT event_id, title, author FROM posts
      WHERE contains(lower(title), 'post 12') OR contains(lower(author), 'post 12')
    )
    SELECT *, FALSE AS compacted FROM found UNION ALL SELECT *, TRUE AS compacted FROM found
    """,
)
def stream_search_index(spark, folder):
    """The posts of one community after the other; each micro-batch is written and indexed, and the index compacted at the end."""
    posts = fixtures.posts(spark, folder)
    base = shared_folder(spark, "stream")

    def write(batch, batch_id):
        queries.append_batch(batch, f"{base}/posts", "parquet", queries.running_query(batch), batch_id)

    def start(stream):
        indexed = indexed_writer(write, f"{base}/index", "event_id")
        return queries.start_ingest(stream, indexed, f"{base}/checkpoint", trigger=AVAILABLE)

    started_per_part(spark, [posts.filter(F.col("subreddit") == name) for name in fixtures.COMMUNITIES], start)
    search_index.compact_index(spark, f"{base}/index", f"{base}/compacted")
    stored = spark.read.parquet(f"{base}/posts")

    def found(path, compacted):
        rows = search_index.search_indexed(stored, path, "POST 12", "event_id")
        return rows.select("event_id", "title", "author", F.lit(compacted).alias("compacted"))

    return found(f"{base}/index", False).unionAll(found(f"{base}/compacted", True))
