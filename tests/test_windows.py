"""Bursts, updates, late rows and publishing on streams."""

import datetime as dt

from pyspark.sql import functions as F

from postlake.operators import search_index
from postlake.operators.publish import ServingTable
from postlake.plans.window_checks import write_part
from postlake.streaming import queries, windows
from postlake.streaming.publishing import indexed_writer, new_posts_writer

AVAILABLE = {"availableNow": True}
START = dt.datetime(2024, 1, 1)
POST = "event_id long, author string, created_at timestamp"


def rows(spark, *minutes, author="a", first=0):
    values = [(first + at, author, START + dt.timedelta(minutes=m) if m is not None else None) for at, m in enumerate(minutes)]
    return spark.createDataFrame(values, POST)


def run(spark, folder, schema, start):
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(str(folder))
    query = start(stream)
    query.awaitTermination()
    return query


def test_a_late_row_joins_two_bursts(spark, tmp_path):
    """The row between two bursts comes in a later run, the neighbours exactly `gap` apart belong together."""
    source, out = tmp_path / "in", str(tmp_path / "out")

    def start(stream):
        found = windows.bursts(stream, "created_at", "30 minutes", "10 hours")
        return queries.append_stream(found, out, str(tmp_path / "checkpoint"), trigger=AVAILABLE)

    parts = [rows(spark, 0, 20, 80, 100, 300), rows(spark, 50, first=10), rows(spark, 330, 361, author="a", first=20)]
    for part in [*parts, rows(spark, 10_000, author="z", first=30)]:
        write_part(part, str(source))
        run(spark, source, part.schema, start)
    found = {
        ((row.first_post - START).seconds // 60, (row.last_post - START).seconds // 60, row.post_count)
        for row in spark.read.parquet(out).collect()
    }
    assert found == {(0, 100, 5), (300, 330, 2), (361, 361, 1)}
    whole = parts[0].unionAll(parts[1]).unionAll(parts[2])
    batch = windows.bursts(whole, "created_at", "30 minutes", "10 hours")
    assert {((r.first_post - START).seconds // 60, (r.last_post - START).seconds // 60, r.post_count) for r in batch.collect()} == found


def test_posts_without_updates_come_at_eviction(spark, tmp_path):
    posts = spark.createDataFrame([("1", START), ("2", START), (None, START)], "id string, created_at timestamp")
    later = [("1", START + dt.timedelta(minutes=m), m) for m in (0, 10, 11)] + [("2", START - dt.timedelta(minutes=1), 9), (None, START, 5)]
    updates = spark.createDataFrame(later, "id string, updated_at timestamp, score int")
    closing = START + dt.timedelta(days=2)
    base, out = str(tmp_path / "in"), str(tmp_path / "out")

    def joined(post_rows, update_rows):
        write_part(post_rows, f"{base}/posts")
        write_part(update_rows, f"{base}/updates")
        left = spark.readStream.schema(posts.schema).parquet(f"{base}/posts")
        right = spark.readStream.schema(updates.schema).parquet(f"{base}/updates")
        found = windows.with_updates(left, right, "10 minutes", "1 hour")
        queries.append_stream(found, out, str(tmp_path / "checkpoint"), trigger=AVAILABLE).awaitTermination()
        return sorted(((row.id, row.score) for row in spark.read.parquet(out).collect()), key=str)

    early = joined(posts, updates)
    assert ("1", 0) in early and ("1", 10) in early and ("2", None) not in early
    last = spark.createDataFrame([("x", closing)], posts.schema), spark.createDataFrame([("y", closing, 0)], updates.schema)
    assert [row for row in joined(*last) if row[0]] == [("1", 0), ("1", 10), ("2", None)]


def test_late_rows_are_kept_apart_and_replays_decide_alike(spark, tmp_path):
    base = str(tmp_path)
    write = windows.late_splitter(f"{base}/kept", f"{base}/late", f"{base}/marks", "created_at", "1 hour")
    batches = [rows(spark, 0, 100), rows(spark, 39, 40, None, 200, first=10), rows(spark, 139, 141, first=20)]
    for number, batch in enumerate(batches):
        write(batch, number)

    def state():
        kept, late = (
            sorted(row.event_id for row in spark.read.parquet(f"{base}/{name}").collect()) for name in ("kept", "late")
        )
        counts = sorted((r.batch_id, r.post_count, r.late_count) for r in windows.late_counts(spark, f"{base}/marks").collect())
        return kept, late, counts

    expected = ([0, 1, 11, 12, 13, 21], [10, 20], [(0, 2, 0), (1, 4, 1), (2, 2, 1)])
    assert state() == expected
    for number in (1, 2, 1):
        write(batches[number], number)
    assert state() == expected
    assert spark.read.parquet(f"{base}/late").schema["watermark"].dataType.simpleString() == "timestamp"


def dropped(query):
    return sum(op["numRowsDroppedByWatermark"] for progress in query.recentProgress for op in progress["stateOperators"])


def test_an_operator_over_kept_rows_drops_none(spark, tmp_path):
    """The dropped-row metric of a stateful operator: some rows of the source, none of the kept ones."""
    source, base = tmp_path / "in", str(tmp_path / "out")
    parts = [rows(spark, 0, 500, 1000), rows(spark, 10, 20, 1500, first=10), rows(spark, 30, 1400, 1600, first=20), rows(spark, 40, first=30)]
    write = windows.late_splitter(f"{base}/kept", f"{base}/late", f"{base}/marks", "created_at", "1 hour")

    def unique(stream, name):
        found = queries.dedup_within_watermark(stream, ["event_id"], "created_at", "1 hour", 1)
        return queries.append_stream(found, f"{base}/{name}", f"{base}/{name}-checkpoint", trigger=AVAILABLE)

    for part in parts:
        write_part(part, str(source))
    run(spark, source, parts[0].schema, lambda s: queries.start_ingest(s, write, f"{base}/checkpoint", trigger=AVAILABLE))
    late = sorted(row.event_id for row in spark.read.parquet(f"{base}/late").collect())
    assert late == [10, 11, 20, 21, 30]
    lost = dropped(run(spark, source, parts[0].schema, lambda s: unique(s, "raw")))
    assert 0 < lost <= len(late)
    kept = tmp_path / "kept-parts"
    for number in range(4):
        own = spark.read.parquet(f"{base}/kept").filter(F.col("batch_id") == number).select(*parts[0].columns)
        write_part(own, str(kept))
    assert dropped(run(spark, kept, parts[0].schema, lambda s: unique(s, "clean"))) == 0
    assert spark.read.parquet(f"{base}/clean").count() + len(late) == sum(part.count() for part in parts)


def test_publishing_from_a_stream_is_idempotent(spark, tmp_path):
    base = str(tmp_path)
    known = spark.createDataFrame([("1",), (None,)], "post_id string")
    known.write.parquet(f"{base}/serving")
    write = new_posts_writer(f"{base}/out", ServingTable(path=f"{base}/serving"), "seq")
    schema = "post_id string, seq long, title string"
    first = spark.createDataFrame([("1", 0, "known"), ("2", 1, "new"), ("2", 2, "again"), (None, 3, "x"), ("", 4, "x")], schema)
    second = spark.createDataFrame([("2", 5, "third"), ("3", 6, "new")], schema)

    def state():
        return sorted((row.post_id, row.seq, row.batch_id) for row in spark.read.parquet(f"{base}/out").collect())

    write(first, 0)
    write(second, 1)
    assert state() == [("2", 1, 0), ("3", 6, 1)]
    write(second, 1)
    write(first, 0)
    assert state() == [("2", 1, 0), ("3", 6, 1)]
    spark.createDataFrame([("4",)], "post_id string").write.mode("append").parquet(f"{base}/serving")
    write(spark.createDataFrame([("4", 7, "published by another job"), ("5", 8, "new")], schema), 2)
    assert state() == [("2", 1, 0), ("3", 6, 1), ("5", 8, 2)]


def test_a_replayed_batch_is_indexed_once(spark, tmp_path):
    """The writer fails after writing; the restarted stream replays the batch, and the index names each post once."""
    base, failures = str(tmp_path), [True]

    def write(batch, batch_id):
        queries.append_batch(batch, f"{base}/posts", "parquet", queries.running_query(batch), batch_id)

    indexed = indexed_writer(write, f"{base}/index", "event_id", ["author"])

    def fail_once(batch, batch_id):
        indexed(batch, batch_id)
        if batch_id == 1 and failures:
            failures.pop()
            raise RuntimeError("lost")

    def start(stream):
        return queries.start_ingest(stream, fail_once, f"{base}/checkpoint", trigger=AVAILABLE)

    source = tmp_path / "in"
    first = rows(spark, 0, 1, 2, author="anne")
    write_part(first, str(source))
    run(spark, source, first.schema, start)
    write_part(rows(spark, 3, 4, author="joanne", first=10), str(source))
    try:
        run(spark, source, first.schema, start)
    except Exception as error:  # the stream's own class of errors
        assert "lost" in str(error)
    assert not failures
    run(spark, source, first.schema, start)
    lists = spark.read.parquet(f"{base}/index/lists").select("key", "gram")
    assert lists.count() == lists.distinct().count() == 3 * 2 + 2 * 4
    stored = spark.read.parquet(f"{base}/posts")
    for term, expected in (("OANN", [10, 11]), ("anne", [0, 1, 2, 10, 11]), ("bob", [])):
        found = search_index.search_indexed(stored, f"{base}/index", term, "event_id", ["author"])
        assert sorted(row.event_id for row in found.collect()) == expected
