import json
import os
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from postlake.plans import jobs, stream_checks
from postlake.sources.messages import parse_posts
from postlake.streaming import queries, sources

AVAILABLE = {"availableNow": True}


def write_lines(folder, name, posts):
    folder.mkdir(exist_ok=True)
    text = "\n".join(post if isinstance(post, str) else json.dumps(post) for post in posts)
    (folder / name).write_text(text)
    # A stream reads files by their time, which may be the same for files written at once.
    written = 1_700_000_000 + len(list(folder.iterdir()))
    os.utime(folder / name, (written, written))


def post(number, **fields):
    return {"id": str(number), "title": f"t{number}", "subreddit": "news", "created_utc": 1700000000.0 + number} | fields


def messages(spark, folder, **options):
    return sources.open_messages(spark, "text", str(folder), **options)


def ingest(spark, tmp_path, fmt="parquet", unique_ids=True, monitor=None):
    write = queries.batch_writer(
        str(tmp_path / "raw"), str(tmp_path / "quarantine"), str(tmp_path / "dead"), fmt, unique_ids, monitor
    )
    stream = messages(spark, tmp_path / "in", maxFilesPerTrigger="1")
    queries.start_ingest(stream, write, str(tmp_path / "checkpoint"), "ingest", AVAILABLE).awaitTermination()


def test_kafka_options():
    options = sources.kafka_options("h:1", ["news", "aws"])
    assert options["subscribe"] == "reddit_news,reddit_aws"
    assert options["startingOffsets"] == "latest" and options["failOnDataLoss"] == "false"
    assert options["kafka.isolation.level"] == "read_committed" and "maxOffsetsPerTrigger" not in options
    bounded = sources.kafka_options("h:1", ["news"], "earliest", 100, "30s")
    assert bounded["maxOffsetsPerTrigger"] == "100" and bounded["maxTriggerDelay"] == "30s"
    assert bounded["startingOffsets"] == "earliest"
    assert queries.TRIGGER == {"processingTime": "180 seconds"}


def test_append_restart_adds_nothing(spark, tmp_path):
    write_lines(tmp_path / "in", "a.json", [post(n) for n in range(20)])
    raw = str(tmp_path / "raw")
    for _ in range(2):
        posts = parse_posts(messages(spark, tmp_path / "in"))
        queries.append_stream(posts, raw, str(tmp_path / "cp"), "raw", trigger=AVAILABLE).awaitTermination()
        assert spark.read.parquet(raw).count() == 20
    write_lines(tmp_path / "in", "b.json", [post(n) for n in range(20, 25)])
    posts = parse_posts(messages(spark, tmp_path / "in"))
    queries.append_stream(posts, raw, str(tmp_path / "cp"), "raw", trigger=AVAILABLE).awaitTermination()
    assert spark.read.parquet(raw).count() == 25


def test_ingest_splits_and_deduplicates_batches(spark, tmp_path):
    write_lines(tmp_path / "in", "a.json", [post(1, score=1), post(1, score=2, created_utc=1800000000.0), "junk", post(2)])
    write_lines(tmp_path / "in", "b.json", [post(1), post(3)])
    shown = []
    ingest(spark, tmp_path, monitor=lambda rows: shown.append(rows.columns))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    assert raw.count() == 4 and raw.select("batch_id").distinct().count() == 2  # repeats across batches stay
    assert raw.filter("id = '1'").agg(F.max("score")).first()[0] == 2
    assert raw.filter("retrieved_at IS NULL").isEmpty()
    assert [row.message for row in spark.read.parquet(str(tmp_path / "quarantine")).collect()] == ["junk"]
    assert shown == [["subreddit", "title", "score", "created_utc"]] * 2


def test_replayed_batch_leaves_no_second_copy(spark, tmp_path):
    batch = spark.createDataFrame([(json.dumps(post(n)),) for n in range(5)], "value string")
    write = queries.batch_writer(str(tmp_path / "raw"), str(tmp_path / "quarantine"), str(tmp_path / "dead"))
    for _ in range(2):
        write(batch, 7)
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 5
    write(batch.limit(0), 8)
    assert not (tmp_path / "raw" / "run=unnamed" / "batch_id=8").exists()


def test_new_checkpoint_keeps_earlier_rows(spark, tmp_path):
    for number, checkpoint in enumerate(("first", "second")):
        folder = tmp_path / f"in{number}"
        write_lines(folder, "a.json", [*[post(n) for n in range(10 * number, 10 * number + 10)], f"junk{number}"])
        for fmt, raw in (("parquet", "raw"), ("format_without_connector", "unwritable")):
            write = queries.batch_writer(str(tmp_path / raw), str(tmp_path / "aside"), str(tmp_path / "dead"), fmt)
            for _ in range(2):
                stream = messages(spark, folder)
                place = str(tmp_path / f"{checkpoint}_{raw}")
                queries.start_ingest(stream, write, place, trigger=AVAILABLE).awaitTermination()
    raw = spark.read.parquet(str(tmp_path / "raw"))
    assert raw.count() == 20 and raw.select("run").distinct().count() == 2
    assert spark.read.parquet(str(tmp_path / "dead")).count() == 22
    assert spark.read.parquet(str(tmp_path / "aside")).count() == 4


def test_arrival_from_the_source(spark):
    frame = spark.createDataFrame([(1, 2, "v", 3)], "timestamp long, partition int, value string, offset long")
    assert sources.with_arrival(frame).first().arrival == (1, 2, 3)


def test_batches_are_bounded_for_any_source(spark, tmp_path):
    assert sources.batch_bounds("kafka", rows=500) == {"maxOffsetsPerTrigger": "500"}
    assert sources.batch_bounds("parquet", size="64m") == {"maxBytesPerTrigger": "64m"}
    assert sources.batch_bounds("socket") == {}
    for fmt, bound in (("kafka", {"files": 1}), ("text", {"rows": 1}), ("socket", {"size": "1m"})):
        with pytest.raises(ValueError):
            sources.batch_bounds(fmt, **bound)
    for number in range(5):
        write_lines(tmp_path / "in", f"{number}.json", [post(number)])
    sizes = []

    def write(batch, batch_id):
        sizes.append(batch.count())

    stream = messages(spark, tmp_path / "in", **sources.batch_bounds("text", files=2))
    queries.start_ingest(stream, write, str(tmp_path / "cp"), trigger=AVAILABLE).awaitTermination()
    assert sizes == [2, 2, 1]


def test_unwritable_table_goes_to_dead_letters(spark, tmp_path):
    write_lines(tmp_path / "in", "a.json", [post(1), "junk"])
    ingest(spark, tmp_path, fmt="format_without_connector")
    dead = spark.read.parquet(str(tmp_path / "dead"))
    assert dead.count() == 2 and parse_posts(dead).select("id").collect() == [("1",)]
    assert not (tmp_path / "raw").exists()


def test_stateful_dedup_spans_batches(spark, tmp_path):
    write_lines(tmp_path / "in", "a.json", [post(n) for n in range(100)])
    write_lines(tmp_path / "in", "b.json", [post(n, score=9) for n in range(50)])
    for parts in (1, 32):
        posts = parse_posts(messages(spark, tmp_path / "in", maxFilesPerTrigger="1")).select(
            "title", "score", F.timestamp_seconds("created_utc").alias("at")
        )
        unique = queries.dedup_within_watermark(posts, ["title"], "at", "1 day", parts)
        raw = str(tmp_path / f"raw_{parts}")
        queries.append_stream(unique, raw, str(tmp_path / f"cp_{parts}"), trigger=AVAILABLE).awaitTermination()
        assert spark.read.parquet(raw).count() == 100


def test_late_rows_are_treated_alike_with_and_without_parts(spark, tmp_path):
    minutes = [[0, 5], [64], [70, 119, 10], [300], [301, 100]]
    for number, batch in enumerate(minutes):
        write_lines(tmp_path / "in", f"{number}.json", [post(1, score=m, created_utc=1700006400.0 + 60 * m) for m in batch])
    kept = []
    for parts in (1, 2, 32):
        posts = parse_posts(messages(spark, tmp_path / "in", maxFilesPerTrigger="1")).select(
            "title", "score", F.timestamp_seconds("created_utc").alias("at")
        )
        unique = queries.dedup_within_watermark(posts, ["title"], "at", "1 hour", parts)
        raw = str(tmp_path / f"raw_{parts}")
        queries.append_stream(unique, raw, str(tmp_path / f"cp_{parts}"), trigger=AVAILABLE).awaitTermination()
        kept.append(sorted(row.score // 60 for row in spark.read.parquet(raw).collect()))
    assert kept == [[0, 1, 5]] * 3


def test_daily_counts_close_behind_the_watermark(spark, tmp_path):
    day = 86400.0
    write_lines(tmp_path / "in", "a.json", [post(n, created_utc=1700006400.0 + n) for n in range(3)])  # 2023-11-15
    write_lines(tmp_path / "in", "b.json", [post(9, created_utc=1700006400.0 + 5 * day)])
    posts = parse_posts(messages(spark, tmp_path / "in", maxFilesPerTrigger="1")).select(
        "subreddit", F.timestamp_seconds("created_utc").alias("at")
    )
    counts = queries.daily_counts(posts, "at", "1 day")
    path = str(tmp_path / "counts")
    queries.append_stream(counts, path, str(tmp_path / "cp"), trigger=AVAILABLE).awaitTermination()
    rows = [(str(r.post_date), r.subreddit, r.post_count) for r in spark.read.parquet(path).collect()]
    assert rows == [("2023-11-15", "news", 3)]


def test_communities_by_topic(spark, tmp_path):
    frame = spark.createDataFrame([("reddit_news", "{}")], "topic string, value string")
    assert sources.with_community(frame).first().community == "news"


def test_console_monitor(spark, tmp_path):
    write_lines(tmp_path / "in", "a.json", [post(1)])
    posts = parse_posts(messages(spark, tmp_path / "in"))
    query = queries.console_monitor(posts, str(tmp_path / "cp"), "monitor", AVAILABLE)
    query.awaitTermination()
    assert query.exception() is None
    spark.streams.awaitAnyTermination(1)


def test_the_ingest_job_ends_when_one_community_fails(spark, tmp_path, monkeypatch):
    """Each community is a query with a table and a position of its own; the job waits for any of them to end."""
    for name in ("news", "aws"):
        write_lines(tmp_path / f"in_{name}", "a.json", [post(n, subreddit=name) for n in range(3)])
    asked, real_writer = [], jobs.writer_of

    def open_files(spark, fmt, **options):
        asked.append((fmt, options["subscribe"], options["startingOffsets"], options["kafka.isolation.level"]))
        lines = messages(spark, tmp_path / f"in_{options['subscribe'].removeprefix(sources.TOPIC_PREFIX)}")
        return lines.selectExpr("value", "TIMESTAMP '2024-01-01' AS timestamp", "0 AS partition", "0L AS offset")

    def writer_of(chosen, name):
        def fail(batch, batch_id):
            raise RuntimeError("the table is gone")

        return fail if name == "aws" else real_writer(chosen, name)

    monkeypatch.setattr(jobs, "open_messages", open_files)
    monkeypatch.setattr(jobs, "writer_of", writer_of)
    lake = str(tmp_path / "lake")
    chosen = jobs.arguments(["--lake", lake, "ingest", "--servers", "h:1", "--starting", "earliest", "news", "aws"])
    spark.streams.resetTerminated()
    try:
        with pytest.raises(StreamingQueryException, match="the table is gone"):
            jobs.JOBS[chosen.job](spark, chosen)
        (left,) = spark.streams.active
        assert left.name == "news"
        until = time.monotonic() + 60
        while not any(progress["numInputRows"] for progress in left.recentProgress) and time.monotonic() < until:
            time.sleep(0.2)
        assert sorted(row.id for row in spark.read.parquet(f"{lake}/news").collect()) == ["0", "1", "2"]
        assert not os.path.exists(f"{lake}/aws") and os.path.isdir(f"{lake}/_aside/aws/checkpoint/offsets")
    finally:
        for query in spark.streams.active:
            query.stop()
        spark.streams.resetTerminated()
    assert asked == [("kafka", f"{sources.TOPIC_PREFIX}{name}", "earliest", "read_committed") for name in ("news", "aws")]


@pytest.mark.parametrize("files", [1, 3])
def test_a_table_is_streamed_whole_as_one_file_or_as_a_folder(spark, tmp_path, files):
    rows = [(at, None if at == 4 else f"text {at}", "en", "web", 6) for at in range(9)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    documents.repartition(files).write.parquet(str(tmp_path / "documents.parquet"))
    posts = spark.range(9).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' AS ts", "id AS user_id", "'view' AS event_type", "1.5D AS value",
        "'{\"k\": 1}' AS props",
    )
    posts.repartition(files).write.parquet(str(tmp_path / "events.parquet"))
    if files == 1:
        for name in ("documents", "events"):
            part = next((tmp_path / f"{name}.parquet").glob("part-*"))
            os.rename(part, tmp_path / "part")
            os.rename(tmp_path / f"{name}.parquet", tmp_path / f"{name}-written")
            os.rename(tmp_path / "part", tmp_path / f"{name}.parquet")
    streamed = stream_checks.stream_quarantine(spark, str(tmp_path)).collect()
    assert sorted(str(row.message) for row in streamed) == sorted(str(row[1]) for row in rows)
    events = stream_checks.stream_append_sink(spark, str(tmp_path)).collect()
    assert sorted(row.event_id for row in events) == list(range(9))
