import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from postlake.functions.columns import is_outbound_link, iso_timestamp, relative_age, table_name_of
from postlake.operators import feed, paging, reports

SCHEMA = (
    "seq int, id string, title string, author string, score int, num_comments int, created_utc timestamp, "
    "url string, selftext string, subreddit string"
)
NAMES = ["news", "aws"]


def posts(spark, *rows):
    full = []
    for seq, row in enumerate(rows):
        day = row.get("day")
        created = dt.datetime(2024, 1, day) if day else None
        full.append(
            (seq, row["id"], row.get("title"), row.get("author"), row.get("score"), 0, created, "u", "s",
             row.get("sub", "news"))
        )
    return spark.createDataFrame(full, SCHEMA)


def ids(frame):
    return [row.post_id for row in frame.collect()]


def test_search_is_literal(spark):
    frame = posts(
        spark,
        {"id": "1", "title": "50% off"},
        {"id": "2", "title": "500 off"},
        {"id": "3", "title": "A_B"},
        {"id": "4", "title": "axb", "author": "IT'S me"},
    )
    assert ids(feed.feed_page(frame, NAMES, search="50%")) == ["1"]
    assert ids(feed.feed_page(frame, NAMES, search="a_b")) == ["3"]
    assert ids(feed.feed_page(frame, NAMES, search="it's")) == ["4"]
    assert ids(feed.feed_page(frame, NAMES, search="a_b", wildcards=True)) == ["3", "4"]


def test_unknown_names_are_ignored(spark):
    frame = posts(spark, {"id": "1", "day": 1}, {"id": "2", "day": 2, "sub": "aws"})
    assert ids(feed.feed_page(frame, NAMES, subreddit="zzz", sort="zzz")) == ["2", "1"]
    assert ids(feed.feed_page(frame, NAMES, subreddit="aws")) == ["2"]


def test_order_and_nulls(spark):
    frame = posts(spark, {"id": "a", "score": None, "day": 1}, {"id": "b", "score": -5}, {"id": "c", "score": 5, "day": 2})
    for source, expected in (("trino", ["b", "a", "c"]), ("postgres", ["b", "c", "a"])):
        assert ids(feed.feed_page(frame, NAMES, source=source, sort="score", order="asc", arrival="seq")) == expected
    assert ids(feed.feed_page(frame, NAMES, source="trino", order="ASC", arrival="seq")) == ["b", "a", "c"]
    assert ids(feed.feed_page(frame, NAMES, source="trino", order="DESC")) == ["c", "a", "b"]


def test_raw_feed_with_and_without_arrival(spark):
    rows = [{"id": str(at % 10), "score": at, "title": f"t{at}", "day": 1 + at % 20} for at in range(100)]
    frame = posts(spark, *rows, {"id": "", "score": 1000}, {"id": None, "score": 1000})
    expected = [str(at) for at in range(9, -1, -1)]
    for arrival in ("seq", None):
        page = feed.feed_page(frame, NAMES, source="trino", sort="score", arrival=arrival)
        assert ids(page) == expected
        assert page.columns == feed.FEED_COLUMNS
        assert {row.title for row in page.collect()} == {f"t{at}" for at in range(90, 100)}
    summary = feed.feed_summary(frame, NAMES, source="trino", limit=4, offset=8).first()
    assert (summary.total, summary.duplicate_count, summary.total_pages) == (10, 92, 3)
    assert (summary.first_shown, summary.last_shown) == (9, 10)


def test_page_past_the_end(spark):
    frame = posts(spark, {"id": "1"}, {"id": "2"})
    assert ids(feed.feed_page(frame, NAMES, offset=10)) == []
    assert feed.feed_summary(frame, NAMES, offset=10).first().total == 2


def test_pages_equal_sorted_rows(spark):
    frame = spark.range(0, 5000, 1, 8).selectExpr("id", "IF(id % 3 = 0, NULL, id % 11) AS score")
    order = [F.desc_nulls_last("score"), F.asc("id")]
    levels = [(F.col("score"), "desc_nulls_last"), (F.floor(F.col("id") / 100), "asc")]
    for offset in (0, 1666, 1667, 3333, 4990, 6000):
        expected = frame.orderBy(*order).offset(offset).limit(25).collect()
        assert paging.page(frame, levels, order, offset, 25).collect() == expected


def test_feed_pages_follow_each_other(spark):
    frame = posts(spark, *[{"id": f"{at % 60:02}", "score": at % 4, "title": f"t{at}", "day": 1 + at % 9} for at in range(200)])
    for source in feed.SOURCES:
        for sort in ("score", "created_utc"):
            for direction in ("asc", "desc"):
                options = {"source": source, "sort": sort, "order": direction, "arrival": "seq"}
                whole = feed.feed_page(frame, NAMES, limit=100, **options).collect()
                parts = [feed.feed_page(frame, NAMES, offset=at, limit=20, **options).collect() for at in (0, 20, 40)]
                assert sum(parts, []) == whole[:60] and len(whole) >= 60


def test_page_plan_is_the_same_for_every_offset(spark):
    frame = posts(spark, *[{"id": str(at), "score": at} for at in range(50)])
    shapes = set()
    for offset in (0, 20_000):
        plan = feed.feed_page(frame, NAMES, offset=offset)._jdf.queryExecution().executedPlan().toString()
        shapes.add(re.sub(r"\d+", "", plan))
        assert "rangepartitioning" not in plan.split("Window")[-1]
    assert len(shapes) == 1


def test_epoch_table_is_pruned(spark, tmp_path):
    frame = posts(spark, *[{"id": str(at), "score": at, "day": 1 + at // 20} for at in range(300)])
    epochs = frame.withColumn("created_utc", F.unix_micros(F.col("created_utc").cast("timestamp")) / 1e6)
    epochs.repartitionByRange(6, "created_utc").sortWithinPartitions("created_utc").write.parquet(str(tmp_path / "posts"))
    stored = spark.read.parquet(str(tmp_path / "posts"))
    assert stored.schema["created_utc"].dataType.simpleString() == "double"
    found = feed.feed_page(stored, NAMES, source="trino", limit=1, arrival="seq")
    assert found.collect()[0].post_id in {str(at) for at in range(280, 300)}
    assert rows_scanned(found) < 150
    recent = reports.last_hours(stored, F.lit(dt.datetime(2024, 1, 15, 23)), 24)
    assert "GreaterThan(created_utc," in recent._jdf.queryExecution().executedPlan().toString()


def test_requests_are_checked(spark):
    frame = posts(spark)
    for wrong in ({"source": "mysql"}, {"limit": 0}, {"limit": 101}, {"offset": -1}):
        with pytest.raises(ValueError):
            feed.feed_page(frame, NAMES, **wrong)
    assert feed.SOURCES == ("postgres", "trino")
    assert feed.feed_page(frame, NAMES).count() == 0


def test_missing_columns_and_tags(spark):
    left = spark.createDataFrame([("1", "t")], "id string, title string")
    right = spark.createDataFrame([(3, "2")], "score int, id string")
    rows = sorted(feed.tagged_union({"news": left, "aws": right}).select("subreddit", "id", "title", "score").collect())
    assert rows == [("aws", "2", None, 3), ("news", "1", "t", None)]


def test_pruned_union_branch(spark):
    tables = {name: posts(spark, {"id": "1"}).drop("subreddit") for name in NAMES}
    plan = feed.filter_subreddit(feed.tagged_union(tables), "news", NAMES)._jdf.queryExecution().optimizedPlan()
    assert "Union" not in plan.toString()


def test_page_is_fixed_before_text_is_read(spark, tmp_path):
    frame = posts(spark, *[{"id": str(at), "score": at, "day": 1 + at // 50} for at in range(300)])
    frame.repartitionByRange(6, "score").sortWithinPartitions("score").write.parquet(str(tmp_path / "posts"))
    stored = spark.read.parquet(str(tmp_path / "posts"))
    for source in feed.SOURCES:
        found = feed.feed_page(stored, NAMES, source=source, sort="score", offset=100, limit=5, arrival="post_id")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "hashpartitioning" not in plan
        assert ids(found) == ["199", "198", "197", "196", "195"]
        for column in ("score", "created_utc"):
            found = feed.feed_page(stored, NAMES, source=source, sort=column, limit=1, arrival="post_id")
            found.collect()
            assert rows_scanned(found) == 50


def rows_scanned(frame):
    """Rows that the file scan of a finished query has read."""
    found, nodes = 0, [frame._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
        elif node.nodeName().endswith("QueryStage"):
            nodes.append(node.plan())
        elif node.nodeName().startswith("Scan parquet"):
            found += node.metrics().apply("numOutputRows").value()
        children = node.children().iterator()
        while children.hasNext():
            nodes.append(children.next())
    return found


def label(spark, expression):
    return spark.range(1).select(expression).first()[0]


def test_relative_age(spark):
    now = dt.datetime(2024, 1, 10)
    ages = {59: "59s ago", 60: "1m ago", 3599: "59m ago", 3600: "1h ago", 86399: "23h ago", 86400 * 3: "3d ago"}
    for seconds, expected in ages.items():
        assert label(spark, relative_age(F.lit(now - dt.timedelta(seconds=seconds)), F.lit(now))) == expected


def test_iso_timestamp(spark):
    assert label(spark, iso_timestamp(F.lit(dt.datetime(2024, 1, 2, 3, 4, 5)))) == "2024-01-02T03:04:05"
    assert label(spark, iso_timestamp(F.lit(dt.datetime(2024, 1, 2, 3, 4, 5, 60)))) == "2024-01-02T03:04:05.000060"
    assert label(spark, iso_timestamp(F.lit(None).cast("timestamp"))) is None


def test_outbound_links(spark):
    links = {None: False, "": False, "https://www.reddit.com/r/x": False, "https://example.org": True}
    for url, expected in links.items():
        assert label(spark, is_outbound_link(F.lit(url).cast("string"))) is expected


def test_table_names():
    assert table_name_of("Programmer Humor") == "programmer_humor"
