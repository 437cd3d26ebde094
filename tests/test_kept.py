"""Kept counts, sketches, drift and progress."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from postlake.operators import kept_counts
from postlake.plans import fixtures
from postlake.plans.window_checks import write_part
from postlake.sources import drift
from postlake.streaming import progress, queries

FOLDER = "/root/testdata/sf0.001"


def test_sketches_of_all_ranges(spark, tmp_path):
    """Every range of days: the united sketches are within the stated bound of the exact count."""
    posts = fixtures.posts(spark, FOLDER)
    kept_counts.sketches(posts, "author", "title", "id").write.parquet(str(tmp_path / "sketches"))
    stored = spark.read.parquet(str(tmp_path / "sketches"))
    days = [dt.date(2024, 1, day) for day in range(1, 31)]
    ranges = spark.createDataFrame([(a, b) for a in days for b in days if a <= b], "first date, last date")
    inside = F.col("post_date").between(F.col("first"), F.col("last"))
    estimates = stored.join(F.broadcast(ranges), inside).groupBy("first", "last").agg(
        *[kept_counts.distinct_estimate(f"{name}_sketch").alias(name) for name in ("author", "title", "id")]
    )
    exact = kept_counts.by_day(posts).join(F.broadcast(ranges), inside).groupBy("first", "last").agg(
        *[F.count_distinct(name).alias(f"{name}_exact") for name in ("author", "title", "id")]
    )
    rows = estimates.join(exact, ["first", "last"]).collect()
    assert len(rows) > 400
    for row in rows:
        for name in ("author", "title", "id"):
            assert abs(row[name] - row[f"{name}_exact"]) <= kept_counts.ERROR_BOUND * row[f"{name}_exact"] + 1


def test_counts_follow_batches_rewrites_and_compaction(spark, tmp_path):
    schema = "id string, subreddit string, created_utc double"
    first = spark.createDataFrame([("1", "a", 1e9), ("1", "a", 1e9 + 90_000), ("2", None, None)], schema)
    second = spark.createDataFrame([("3", "b", 1e9), ("4", "a", 1e9)], schema)
    path = str(tmp_path / "counts")
    kept_counts.add_counts(first, path, "b0")
    kept_counts.add_counts(second, path, "b1")
    kept_counts.add_counts(second, path, "b1")
    whole = first.unionAll(second)

    def rows(frame):
        return sorted((str(r.post_date), str(r.subreddit), r.post_count) for r in frame.collect())

    assert rows(kept_counts.kept_counts(spark, path)) == rows(kept_counts.counted(whole))
    after = whole.filter("NOT (id = '1' AND created_utc = 1e9) AND id <> '3'")
    kept_counts.retract_counts(whole, after, path, "r0")
    assert rows(kept_counts.kept_counts(spark, path)) == rows(kept_counts.counted(after))
    kept_counts.compact_counts(spark, path, str(tmp_path / "compact"))
    assert rows(kept_counts.kept_counts(spark, str(tmp_path / "compact"))) == rows(kept_counts.counted(after))


def test_drift_of_odd_messages(spark):
    values = ['{"id":"1","score":1,"new":null}', '{"id":2,"score":"x"}', "not json", None, "[1]", '{"over_18":1,"new":[1]}', "{}", '"text"']
    messages = spark.createDataFrame(list(enumerate(values)), "batch long, value string")
    found = {(r.field, r.type, r.status, r.messages, r.first_batch) for r in drift.drift(messages, batch="batch").collect()}
    assert found == {("score", "STRING", "new type", 1, 1), ("over_18", "BIGINT", "new type", 1, 5), ("new", "ARRAY", "new field", 1, 5)}
    assert {r.first_batch for r in drift.drift(messages).collect()} == {None}


def test_progress_names_each_batch_once_after_a_forced_restart(spark, tmp_path):
    base, failed = str(tmp_path), []
    listener = progress.ProgressTable(spark, f"{base}/progress")
    spark.streams.addListener(listener)

    def write(batch, number):
        if number == 1 and not failed:
            failed.append(number)
            raise RuntimeError("lost")
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={number}")

    def start():
        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", "1").parquet(f"{base}/in")
        return queries.start_ingest(stream, write, f"{base}/checkpoint", "watched", {"availableNow": True})

    try:
        for at in range(3):
            write_part(spark.range(at * 10, at * 10 + 5 + at), f"{base}/in")
        with pytest.raises(Exception, match="lost"):
            start().awaitTermination()
        start().awaitTermination()
        rows = sorted((r.batch_id, r.input_rows, r.name) for r in progress.awaited(spark, f"{base}/progress", 3).collect())
        assert rows == [(0, 5, "watched"), (1, 6, "watched"), (2, 7, "watched")]
        assert "lost" in progress.failures(spark, f"{base}/progress").first().error
        (total,) = progress.totals(spark, f"{base}/progress").collect()
        assert (total.batch_count, total.input_rows, total.late_rows) == (3, 18, 0)
    finally:
        spark.streams.resetTerminated()  # the failure was meant
        spark.streams.removeListener(listener)
