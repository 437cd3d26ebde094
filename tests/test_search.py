"""The search index against a scan, cursors against sorted rows, and the number of scans of a page."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_feed import NAMES, posts, rows_scanned

from postlake.operators import cursor, feed, paging, search_index


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("search")
    special = ["ÄÖÜ straße", "100%_sure", "a", "ab", "", None, "tab\tand space", "日本語のテキスト", "aaaaaa", "İstanbul ΑΣ", "O'Brien \\ x"]
    rows = [(at, f"post number {at}", f"user{at % 50}") for at in range(3000)]
    rows += [(5000 + at, title, special[-at]) for at, title in enumerate(special)]
    frame = spark.createDataFrame(rows, "seq long, title string, author string")
    frame.repartitionByRange(4, "seq").write.parquet(f"{base}/posts")
    stored = spark.read.parquet(f"{base}/posts")
    search_index.build_index(stored, f"{base}/index", "seq")
    return stored, f"{base}/index"


TERMS = [
    "number 299", "USER49", "öü", "STRASSE", "Straße", "%_s", "100%", "a", "ab", "aaaa", "日本語", "語のテ", "nowhere", "r 1\t", "tab\t",
    "o'b", "\\ x", "İst", "ΑΣ", "post", "user1 post", "zzz", " ",
]


@pytest.mark.parametrize("term", TERMS)
def test_index_equals_scan(indexed, term):
    stored, path = indexed
    found = search_index.search_indexed(stored, path, term, "seq")
    assert found.columns == stored.columns
    assert sorted(row.seq for row in found.collect()) == sorted(row.seq for row in feed.search_posts(stored, term).collect())


def test_index_reads_few_rows(spark, indexed):
    stored, path = indexed
    lists = spark.read.parquet(f"{path}/lists")
    total = lists.count()
    chosen = search_index.rarest_lists(spark, path, "number 299")
    assert len(chosen) == search_index.MOST_LISTS and search_index.rarest_lists(spark, path, "nowhere at all") == []
    assert search_index.rarest_lists(spark, path, "po") is None and search_index.rarest_lists(spark, path, "post") is None
    buckets = [search_index.bucket_of(F.lit(gram)) for gram in chosen]
    read = lists.filter(F.col("bucket").isin(buckets) & F.col("gram").isin(chosen))
    held = read.count()
    read.collect()
    assert held < 0.05 * total
    assert held <= rows_scanned(read) < 0.2 * total
    plan = search_index.listed_keys(spark, path, chosen)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan


def test_few_keys_prune_the_scan_of_the_posts(indexed, monkeypatch):
    stored, path = indexed
    expected = sorted(row.seq for row in feed.search_posts(stored, "number 299").collect())
    found = search_index.search_indexed(stored, path, "number 299", "seq")
    assert sorted(row.seq for row in found.collect()) == expected == [299, *range(2990, 3000)]
    assert rows_scanned(found) < 0.6 * stored.count()
    monkeypatch.setattr(search_index, "MOST_KEYS", 5)
    joined = search_index.search_indexed(stored, path, "number 299", "seq")
    assert sorted(row.seq for row in joined.collect()) == expected
    assert "LeftSemi" in joined._jdf.queryExecution().executedPlan().toString()


def test_index_of_keys_of_other_types(spark, tmp_path):
    frame = spark.createDataFrame([(f"t{at:03}", f"post number {at}", None) for at in range(400)], "id string, title string, author string")
    search_index.build_index(frame, str(tmp_path / "index"), "id")
    for term in ("number 1", "number 39", "nowhere"):
        found = search_index.search_indexed(frame, str(tmp_path / "index"), term, "id")
        assert sorted(found.collect()) == sorted(feed.search_posts(frame, term).collect())


@pytest.mark.parametrize("most", [1000, 0])
def test_posts_without_a_key_are_found(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(search_index, "MOST_KEYS", most)
    rows = [("post without key 7", None, None), ("post without key 8", None, None)]
    rows += [(f"post number {at}", None, at) for at in range(40)]
    frame = spark.createDataFrame(rows, "title string, author string, seq int")
    search_index.build_index(frame, str(tmp_path / "index"), "seq")
    for term in ("key 7", "er 7", "r 38"):
        found = search_index.search_indexed(frame, str(tmp_path / "index"), term, "seq")
        assert found.columns == frame.columns
        assert sorted(row.title for row in found.collect()) == sorted(row.title for row in feed.search_posts(frame, term).collect())


@pytest.mark.parametrize("size", [1, 2, 31, 32, 33, 64, 65, 999, 1000])
def test_ranges_hold_all_keys(size):
    numbers = [at * at for at in range(size)]
    for kind, keys in ((T.LongType(), numbers), (T.StringType(), [f"{at:07}" for at in numbers])):
        ranges = search_index.key_ranges(keys[::-1], kind)
        assert len(ranges) <= search_index.RANGES and all(first <= last for first, last in ranges)
        assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
        assert all(any(first <= key <= last for first, last in ranges) for key in keys)
    assert search_index.key_ranges([1, 2, 90, 91, 500], T.LongType(), 3) == [(1, 2), (90, 91), (500, 500)]


def test_index_grows_by_entries(spark, tmp_path):
    """New, changed, removed and replayed posts, an empty batch, and all entries made one."""
    path, schema = str(tmp_path / "index"), "seq long, title string, author string"
    first = spark.createDataFrame([(at, f"old title {at}", f"user{at}") for at in range(300)], schema)
    changed = spark.createDataFrame([(7, "fresh words 7", "user7"), (400, "old title again", None), (401, None, None)], schema)
    search_index.build_index(first, path, "seq", entry="0")
    search_index.build_index(changed, path, "seq", entry="1")
    search_index.build_index(changed, path, "seq", entry="1")
    search_index.build_index(changed.limit(0), path, "seq", entry="2")
    stored = first.filter("seq <> 7 AND seq <> 250").unionByName(changed)
    search_index.compact_index(spark, path, str(tmp_path / "one"))
    for term in ("fresh words", "TITLE 7", "title 250", "again", "e 29", "user7", "nowhere", "ol", "title"):
        expected = sorted(row.seq for row in feed.search_posts(stored, term).collect())
        for index in (path, str(tmp_path / "one")):
            assert sorted(row.seq for row in search_index.search_indexed(stored, index, term, "seq").collect()) == expected
    lists, one = (spark.read.parquet(f"{folder}/lists").select("gram", "key") for folder in (path, str(tmp_path / "one")))
    assert one.count() == lists.distinct().count() < lists.count()
    # Trigrams that a changed post has in both entries, or each in another one, must neither hide nor invent it.
    assert [row.seq for row in search_index.search_indexed(stored, path, "user7", "seq").filter("seq = 7").collect()] == [7]
    search_index.build_index(first.limit(0), str(tmp_path / "none"), "seq")
    search_index.build_index(first.limit(0), str(tmp_path / "none"), "seq", entry="more")
    assert search_index.search_indexed(stored.limit(0), str(tmp_path / "none"), "fresh", "seq").collect() == []


def test_a_task_sorts_a_bounded_part_of_the_lists(spark, tmp_path, monkeypatch):
    """The ranges grow with the rows of the lists, however small they are as bytes."""
    monkeypatch.setattr(search_index, "TASK_ROWS", 500, raising=False)
    posts = spark.range(600).selectExpr("id AS seq", "concat('post number ', id) AS title", "CAST(NULL AS STRING) AS author")
    path, one = str(tmp_path / "index"), str(tmp_path / "one")
    search_index.build_index(posts, path, "seq")
    search_index.compact_index(spark, path, one)
    for index in (path, one):
        lists = spark.read.parquet(f"{index}/lists").withColumn("task", F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1))
        held = [row["count"] for row in lists.groupBy("task").count().collect()]
        assert sum(held) == lists.count() > 5000 and max(held) <= 1000


def test_compaction_shuffles_the_lists_once(indexed, spark):
    _, path = indexed
    lists = spark.read.parquet(f"{path}/lists").select("bucket", "gram", "key")
    plan = lists.repartitionByRange("bucket", "gram", "key").distinct()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning" not in plan


def feed_rows(spark):
    rows = []
    for at in range(230):
        score = None if at % 7 == 0 else at % 5
        rows.append({"id": f"{at % 60:02}" if at % 11 else None, "score": score, "title": f"t{at}", "day": 1 + at % 9})
    return posts(spark, *rows)


@pytest.mark.parametrize("sort", ["score", "created_utc", "num_comments"])
@pytest.mark.parametrize("order", ["asc", "desc"])
def test_walking_returns_each_post_once(spark, sort, order):
    frame = feed_rows(spark)
    titles = [row.title for page in cursor.walk(frame, NAMES, arrival="seq", limit=37, sort=sort, order=order) for row in page]
    expected = frame.withColumnRenamed("id", "post_id").orderBy(*feed.feed_order(sort, order, False), "seq")
    assert titles == [row.title for row in expected.collect()] and len(titles) == 230


def test_walking_keeps_its_place_while_posts_come_in(spark):
    frame = feed_rows(spark).filter("id IS NOT NULL")
    first = cursor.page_after(frame, NAMES, arrival="seq", limit=50, sort="score").collect()
    more = posts(spark, {"id": "new", "score": 99, "title": "new"}).withColumn("seq", F.lit(10_000).cast("long"))
    second = cursor.page_after(frame.unionByName(more), NAMES, first[-1][cursor.PLACE], arrival="seq", limit=50, sort="score")
    assert second.collect() == cursor.page_after(frame, NAMES, first[-1][cursor.PLACE], arrival="seq", limit=50, sort="score").collect()


def test_cursor_prunes_the_scan(spark, tmp_path):
    frame = posts(spark, *[{"id": f"{at:04}", "score": at, "day": 1 + at // 50} for at in range(300)])
    frame.repartitionByRange(6, "score").sortWithinPartitions("score").write.parquet(str(tmp_path / "posts"))
    stored = spark.read.parquet(str(tmp_path / "posts"))
    for sort in ("score", "created_utc"):
        place = {"sort": sort, "order": "desc", "post_id": "0050", "arrival": "50"}
        place["value"] = "50" if sort == "score" else str(int(stored.filter("score = 50").select(F.unix_micros(F.col("created_utc").cast("timestamp"))).first()[0]))
        page = cursor.page_after(stored, NAMES, json.dumps(place), arrival="seq", limit=20, sort=sort)
        assert len(page.collect()) == 20 and rows_scanned(page) <= 100
        plan = page._jdf.queryExecution().executedPlan().toString()
        assert "LessThanOrEqual(" + sort in plan and "TakeOrderedAndProject" in plan


def test_cursors_of_other_feeds_are_refused(spark):
    frame = feed_rows(spark)
    place = cursor.page_after(frame, NAMES, arrival="seq", sort="score").collect()[-1][cursor.PLACE]
    for wrong, options in ((place, {"sort": "num_comments"}), (place, {"sort": "score", "order": "asc"}), ("x", {}), ("[]", {}), ("{}", {})):
        with pytest.raises(ValueError):
            cursor.page_after(frame, NAMES, wrong, arrival="seq", **options)


def test_each_level_reads_the_rows_once(spark, tmp_path, monkeypatch):
    """However many levels there are, the final plan has one scan of the rows and one small table per level."""
    spark.range(0, 5000, 1, 4).selectExpr("id", "CAST(id DIV 1000 AS INT) AS a").write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    monkeypatch.setattr(paging, "SORTED_ROWS", 0)
    levels = [(F.col("a"), "asc"), (F.floor(F.col("id") / 100), "asc"), (F.floor(F.col("id") / 10), "asc"), (F.col("id"), "asc")]
    found = paging.page(stored, levels, [F.col("id").asc()], 2345, 25)
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert [row.id for row in found.collect()] == list(range(2345, 2370))
    monkeypatch.setattr(paging, "SORTED_ROWS", 2000)
    found = paging.page(stored, levels, [F.col("id").asc()], 2345, 25)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("BroadcastHashJoin") == 1
    assert [row.id for row in found.collect()] == list(range(2345, 2370))


def test_ids_that_count_up_are_told_apart(spark, monkeypatch):
    """All posts of one score and one start of id: longer starts are counted until few enough rows are left to order."""
    monkeypatch.setattr(paging, "SORTED_ROWS", 100)
    frame = posts(spark, *[{"id": f"1{at:07}", "score": 1, "title": f"t{at}"} for at in range(1500)])
    found = feed.feed_page(frame, NAMES, sort="score", offset=700, limit=10, arrival="seq").collect()
    assert [row.post_id for row in found] == [f"1{at:07}" for at in range(700, 710)]
