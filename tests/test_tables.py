import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from postlake.operators import catalog, curate, maintenance, publish, reports
from postlake.plans import curation, jobs, raw_tables
from postlake.schema import CLEAN_SCHEMA, EPOCH_COLUMNS, POST_SCHEMA, SERVING_COLUMNS, SERVING_TYPES
from postlake.session import shared_root
from postlake.sources import tables


def raw_posts(spark, count=60):
    return spark.range(count).selectExpr(
        "CAST(id AS STRING) AS id",
        "CONCAT('t', CAST(id DIV 2 AS STRING)) AS title",
        "CAST(1700000000 + id * 40000 AS DOUBLE) AS created_utc",
        "CAST(id AS INT) AS score",
    )


def test_curated_columns(spark):
    ingested = spark.createDataFrame([], POST_SCHEMA).withColumns({"is_partial": F.lit(True), "batch_id": F.lit(1)})
    frame = curate.clean_columns(curate.curate(ingested))
    assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in CLEAN_SCHEMA]
    assert len(frame.columns) == 103 and frame.columns[-4:] == ["date", "year", "month", "day"]
    assert all(frame.schema[name].dataType.simpleString() == "timestamp" for name in EPOCH_COLUMNS)
    assert frame.count() == 0


def test_partitioned_write_and_pruning(spark, tmp_path):
    path = str(tmp_path / "clean")
    curate.write_partitioned(curate.curate(raw_posts(spark)), path)
    clean = spark.read.parquet(path)
    assert clean.count() == 30 and clean.filter("created_utc <> created_utc").isEmpty()
    days = reports.in_date_range(clean, dt.date(2023, 11, 20), dt.date(2023, 12, 2))
    assert {str(row.date) for row in days.select("date").distinct().collect()} <= {
        *(f"2023-11-{day}" for day in range(20, 31)), "2023-12-01", "2023-12-02",
    }
    expected = clean.filter(F.col("date").between("2023-11-20", "2023-12-02")).count()
    assert days.count() == expected > 0
    assert "PartitionFilters: [isnotnull(year" in days._jdf.queryExecution().executedPlan().toString()


def test_large_day_is_split(spark, tmp_path):
    rows = spark.range(0, 200_000, 1, 8).selectExpr("uuid() AS body", "IF(id % 3 = 0, 1, CAST(id % 28 AS INT)) AS day")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "500k")
    try:
        path = str(tmp_path / "days")
        curate.write_partitioned(rows.selectExpr("body", "2024 AS year", "1 AS month", "day"), path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    files = {day: len(os.listdir(f"{path}/year=2024/month=1/{day}")) for day in os.listdir(f"{path}/year=2024/month=1")}
    assert files["day=1"] > 4 and spark.read.parquet(path).count() == 200_000


def test_publish_twice_is_publish_once(spark, tmp_path):
    target = publish.ServingTable(path=str(tmp_path / "serving"))
    posts = curate.curate(raw_posts(spark))
    assert publish.publish(posts, target) == 30
    assert publish.publish(posts, target) == 0
    assert publish.publish(curate.curate(raw_posts(spark, 80)), target) == 10
    assert target.read(spark).count() == 40
    with pytest.raises(ValueError):
        publish.publish(posts, target, "fail")
    with pytest.raises(ValueError):
        publish.publish(posts, target, "merge")
    assert publish.publish(posts, target, "overwrite") == 30
    assert target.read(spark).columns == ["post_id", "title", "score", "created_utc"]


def test_curation_run(spark, tmp_path):
    raw, clean = str(tmp_path / "raw"), str(tmp_path / "clean")
    maintenance.append_rows(raw_posts(spark), raw)
    target = publish.ServingTable(path=str(tmp_path / "serving"))
    first = curation.curate_community(spark, "news", raw, clean, target)
    again = curation.curate_community(spark, "news", raw, clean, target)
    assert first == {"subreddit": "news", "read": 60, "curated": 30, "published": 30, "skipped": 0}
    assert (again["published"], again["skipped"]) == (0, 30)


def test_curation_of_an_empty_table(spark, tmp_path):
    raw = str(tmp_path / "raw")
    maintenance.append_rows(spark.createDataFrame([], POST_SCHEMA), raw)
    target = publish.ServingTable(path=str(tmp_path / "serving"))
    run = curation.curate_community(spark, "news", raw, str(tmp_path / "clean"), target)
    assert (run["read"], run["curated"], run["published"]) == (0, 0, 0)


def test_rewrite_keeps_the_newest_rows(spark, tmp_path):
    path = str(tmp_path / "raw")
    posts = raw_posts(spark)
    maintenance.append_rows(posts, path)
    maintenance.append_rows(posts.withColumn("created_utc", F.col("created_utc") + 5), path)
    trial = maintenance.rewrite_deduplicated(spark, path, dry_run=True)
    assert trial == {"before": 120, "after": 60, "removed": 60, "replaced": None}
    assert spark.read.parquet(path).count() == 120
    done = maintenance.rewrite_deduplicated(spark, path)
    rows = spark.read.parquet(path)
    assert (done["before"], done["after"], done["removed"]) == (120, 60, 60)
    assert rows.count() == 60 and rows.agg(F.sum(F.col("created_utc") % 10)).first()[0] == 300
    assert spark.read.parquet(done["replaced"]).count() == 120
    assert maintenance.rewrite_deduplicated(spark, path)["replaced"] is None


def test_rewrite_keeps_batch_folders(spark, tmp_path):
    path = str(tmp_path / "raw")
    for batch in range(3):
        raw_posts(spark).withColumn("created_utc", F.col("created_utc") + batch).write.parquet(f"{path}/batch_id={batch}")
    assert maintenance.rewrite_deduplicated(spark, path)["after"] == 60
    assert os.listdir(path).count("batch_id=2") == 1
    raw_posts(spark, 3).write.parquet(f"{path}/batch_id=3")
    assert {r.batch_id: r["count"] for r in spark.read.parquet(path).groupBy("batch_id").count().collect()} == {2: 60, 3: 3}


def test_rewrite_refuses_a_table_with_a_sink_log(spark, tmp_path):
    path = tmp_path / "raw"
    raw_posts(spark).write.parquet(str(path))
    (path / "_spark_metadata").mkdir()
    with pytest.raises(ValueError):
        maintenance.rewrite_deduplicated(spark, str(path))


def test_last_hours_reads_recent_days_only(spark, tmp_path):
    path = str(tmp_path / "clean")
    curate.write_partitioned(curate.curate(raw_posts(spark)), path)
    clean = spark.read.parquet(path)
    now = F.lit(dt.datetime(2023, 11, 30))
    recent = reports.last_hours(clean, now)
    since = dt.datetime(2023, 11, 29)
    assert recent.count() == clean.filter(F.col("created_utc") > F.lit(since)).count() > 0
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "(make_date(year" in plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]


def test_rewrite_needs_an_id(spark, tmp_path):
    path = str(tmp_path / "raw")
    maintenance.append_rows(spark.range(3).withColumnRenamed("id", "key"), path)
    with pytest.raises(ValueError):
        maintenance.rewrite_deduplicated(spark, path)


def test_only_a_missing_path_is_tolerated(spark, tmp_path):
    present, broken = str(tmp_path / "news"), tmp_path / "broken"
    raw_posts(spark).write.parquet(present)
    union = tables.load_union(spark, {"news": present, "aws": str(tmp_path / "absent")})
    assert [row.subreddit for row in union.select("subreddit").distinct().collect()] == ["news"]
    nothing = tables.load_union(spark, {"aws": str(tmp_path / "absent")})
    assert nothing.count() == 0 and nothing.columns == POST_SCHEMA.names
    broken.mkdir()
    assert tables.load_union(spark, {"news": present, "empty": str(broken)}).count() == 60
    (broken / "part-0.parquet").write_text("not a table")
    with pytest.raises(Exception):
        tables.load_union(spark, {"news": present, "broken": str(broken)})


def test_jdbc_options():
    options = tables.jdbc_options("jdbc:x", "d", user="u", password="p", numPartitions="4")
    assert options["numPartitions"] == "4" and options["user"] == "u" and options["truncate"] == "true"
    assert "user" not in tables.jdbc_options("jdbc:x", "d")


class RecordedReader:
    """Stands in for a session where a database would be needed."""

    def __init__(self):
        self.read, self.seen = self, {}

    def format(self, name):
        self.seen["format"] = name
        return self

    def options(self, **options):
        self.seen |= options
        return self

    def load(self):
        return self.seen

    def jdbc(self, url, table, predicates, properties):
        return {"url": url, "table": table, "predicates": predicates} | properties


def test_jdbc_reads():
    connection = tables.jdbc_options("jdbc:x", "d")
    whole = tables.read_jdbc(RecordedReader(), "s.news", connection)
    assert (whole["format"], whole["dbtable"], whole["url"]) == ("jdbc", "s.news", "jdbc:x")
    parts = tables.read_jdbc(RecordedReader(), "s.news", connection, ["post_id < 'm'", "post_id >= 'm'"])
    assert len(parts["predicates"]) == 2 and parts["driver"] == "d"
    target = publish.ServingTable("jdbc", options=connection | {"dbtable": "s.news"})
    assert target.read(RecordedReader())["dbtable"] == "s.news"
    split = publish.ServingTable("jdbc", options=connection | {"dbtable": "s.news"}, predicates=("a", "b"))
    assert split.read(RecordedReader())["predicates"] == ["a", "b"]
    assert publish.ServingTable("jdbc", options=connection, exists=False).read(RecordedReader()) is None
    assert publish.ServingTable("jdbc", options=connection, exists=False).keys(RecordedReader()) is None


class BoundedReader(RecordedReader):
    """Answers the question for the bounds, and records what else is read."""

    def __init__(self, low, high):
        super().__init__()
        self.bounds, self.asked = {"low": low, "high": high}, []

    def load(self):
        self.asked.append(dict(self.seen))
        return self

    def first(self):
        return self.bounds


def test_jdbc_keys_are_made_distinct_in_the_database():
    options = tables.jdbc_options("jdbc:x", "d") | {"dbtable": "s.news"}
    found = publish.ServingTable("jdbc", options=options).keys(RecordedReader())
    assert found["dbtable"] == "(SELECT DISTINCT post_id FROM s.news WHERE post_id IS NOT NULL) known_keys"
    split = publish.ServingTable("jdbc", options=options, predicates=("post_id < 'm'", "post_id >= 'm'")).keys(RecordedReader())
    assert split["table"] == found["dbtable"] and len(split["predicates"]) == 2


def test_jdbc_reads_are_split_by_the_tables_own_bounds():
    options = tables.jdbc_options("jdbc:x", "d") | {"dbtable": "s.news"}
    reader = BoundedReader(3, 90)
    publish.ServingTable("jdbc", options=options, split_column="score").read(reader)
    asked, read = reader.asked
    assert asked["dbtable"] == "(SELECT MIN(score) AS low, MAX(score) AS high FROM s.news) bounds"
    assert (read["dbtable"], read["partitionColumn"], read["lowerBound"], read["upperBound"]) == ("s.news", "score", "3", "90")
    assert read["numPartitions"] == "16"
    empty = BoundedReader(None, None)
    publish.ServingTable("jdbc", options=options, split_column="score").read(empty)
    assert "partitionColumn" not in empty.asked[-1]


def test_null_title_is_known_across_batches(spark):
    schema = "id string, title string, created_utc double"
    clean = curate.curate(spark.createDataFrame([("1", None, 1.0), ("2", "a", 2.0)], schema))
    batch = spark.createDataFrame([("3", None, 3.0), ("4", "a", 4.0), ("5", "b", 5.0)], schema)
    assert [row.id for row in curate.curate_batch(batch, clean).collect()] == ["5"]


def test_failed_table_does_not_stop_the_others(spark, tmp_path):
    for name in ("news", "aws"):
        maintenance.append_rows(raw_posts(spark).unionAll(raw_posts(spark, 30)), str(tmp_path / name))
    paths = {name: str(tmp_path / name) for name in ("news", "absent", "aws")}
    trial = raw_tables.deduplicate_tables(spark, paths, dry_run=True)
    assert {row.subreddit: row.removed for row in trial.collect()} == {"news": 30, "absent": None, "aws": 30}
    rows = {row.subreddit: row for row in raw_tables.with_total(raw_tables.deduplicate_tables(spark, paths)).collect()}
    assert "PATH_NOT_FOUND" in rows["absent"].error and rows["news"].error is None
    assert (rows["TOTAL"].before, rows["TOTAL"].after, rows["TOTAL"].percent_removed) == (180, 120, 33.33)
    assert spark.read.parquet(paths["aws"]).count() == 60


def test_jobs(spark, tmp_path, capsys):
    lake = ["--lake", str(tmp_path)]
    full = spark.createDataFrame([], POST_SCHEMA).unionByName(raw_posts(spark), allowMissingColumns=True)
    maintenance.append_rows(full, str(tmp_path / "news"))
    serving = str(tmp_path / "serving")
    for published in (30, 0):
        chosen = jobs.arguments([*lake, "curate", "--serving", serving, "news"])
        row = jobs.JOBS[chosen.job](spark, chosen).first()
        assert (row.read, row.curated, row.published) == (60, 30, published)
    assert spark.read.parquet(f"{serving}/news").count() == 30
    for source, ids in (("postgres", ["58", "56"]), ("trino", ["59", "58"])):
        chosen = jobs.arguments([*lake, "feed", "--source", source, "--limit", "2", "--sort", "score", "news", "absent"])
        assert [row.post_id for row in jobs.JOBS[chosen.job](spark, chosen).collect()] == ids
    chosen = jobs.arguments([*lake, "deduplicate", "--dry-run", "news"])
    assert jobs.JOBS[chosen.job](spark, chosen).filter("subreddit = 'TOTAL'").first().removed == 0
    chosen = jobs.arguments([*lake, "curate", "--serving", "s", "--jdbc-url", "u", "--jdbc-driver", "d", "Big News"])
    assert jobs.serving_table(chosen, "Big News").options["dbtable"] == "s.big_news"


def test_vacuum_statement():
    assert maintenance.vacuum_statement("t", "delta") == "VACUUM t RETAIN 168 HOURS"
    assert maintenance.vacuum_statement("t", "parquet") is None


def test_manifest_lists_live_files(spark, tmp_path):
    path, manifest = str(tmp_path / "clean"), str(tmp_path / "manifest")
    curate.write_partitioned(curate.curate(raw_posts(spark)), path)
    maintenance.write_manifest(spark, path, manifest)
    listed = {row.value.removeprefix("file:").lstrip("/") for row in spark.read.text(manifest).collect()}
    live = {os.path.join(at, name).lstrip("/") for at, _, names in os.walk(path) for name in names if name.endswith(".parquet")}
    assert listed == live


def test_sizes_are_those_of_the_files(spark, tmp_path):
    """Files and bytes per table as the folders have them, hidden files left out."""
    paths = {name: str(tmp_path / name) for name in ("one", "many", "parted")}
    spark.range(1000).coalesce(1).write.parquet(paths["one"])
    spark.range(1000).repartition(7).write.parquet(paths["many"])
    spark.range(1000).selectExpr("id", "id % 3 AS part").write.partitionBy("part").parquet(paths["parted"])
    found = {row.table: (row.files, row.bytes) for row in maintenance.file_sizes(spark, paths).collect()}
    for name, path in paths.items():
        files = [os.path.join(at, f) for at, _, fs in os.walk(path) for f in fs if not f.startswith((".", "_"))]
        assert found[name] == (len(files), sum(map(os.path.getsize, files)))


def test_catalog(spark, tmp_path):
    path = str(tmp_path / "clean")
    curate.write_partitioned(curate.curate(raw_posts(spark)), path)
    catalog.create_schema(spark, "lake", str(tmp_path / "lake"))
    schema = spark.read.parquet(path).schema
    catalog.register_table(spark, "lake.news_clean", path, schema=schema, partitions=["year", "month", "day"])
    assert spark.table("lake.news_clean").count() == 0
    assert maintenance.repair_partitions(spark, "lake.news_clean").count() == 30
    raw_posts(spark).createOrReplaceTempView("not_in_the_database")
    assert [(r.table_name, r.row_count) for r in catalog.inventory(spark, "lake").collect()] == [("news_clean", 30)]
    columns = catalog.table_columns(spark, "lake.news_clean").orderBy("position").collect()
    assert [row.name for row in columns][-3:] == ["year", "month", "day"]
    with pytest.raises(ValueError):
        catalog.table_columns(spark, "lake.absent")


def test_serving_columns():
    assert SERVING_COLUMNS[0] == "id" and len(SERVING_COLUMNS) == 8
    assert list(SERVING_TYPES)[1:] == SERVING_COLUMNS[1:]
    assert publish.column_types().startswith("post_id VARCHAR(50), title STRING, author VARCHAR(255), score INT")


def test_empty_tables_are_counted(spark):
    counted = reports.count_per_table({"news": raw_posts(spark), "aws": raw_posts(spark, 0)})
    assert {row.subreddit: row.posts for row in counted.collect()} == {"news": 60, "aws": 0}


def test_top_k_does_not_sort_the_table(spark):
    plan = reports.most_recent(raw_posts(spark), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange rangepartitioning" not in plan


def test_publication_cleans_up(spark, tmp_path):
    target = publish.ServingTable(path=str(tmp_path / "serving"))
    posts = curate.curate(raw_posts(spark))
    assert publish.publish(posts, target) == 30
    assert publish.publish(posts.limit(0), target) == 0
    assert publish.publish_full(posts, target) == 30
    assert target.read(spark).count() == 30
    assert not [name for name in os.listdir(f"{shared_root(spark)}/postlake") if name.startswith("publish-")]


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_failed_overwrite_keeps_the_old_rows(spark, tmp_path, fmt):
    target = publish.ServingTable(fmt, str(tmp_path / "serving"))
    publish.publish_full(raw_posts(spark), target)
    failing = raw_posts(spark).withColumn("score", F.when(F.col("id") == "30", F.raise_error(F.lit("no"))).otherwise(F.col("score")).cast("int"))
    for replace in (lambda: publish.publish_full(failing, target), lambda: publish.publish(failing, target, "overwrite")):
        with pytest.raises(Exception, match="no"):
            replace()
        assert target.read(spark).count() == 60
    clean = str(tmp_path / "clean")
    curate.write_partitioned(curate.curate(raw_posts(spark)), clean, fmt)
    with pytest.raises(Exception, match="no"):
        curate.write_partitioned(curate.curate(failing), clean, fmt)
    assert spark.read.format(fmt).load(clean).count() == 30
    assert sorted(os.listdir(tmp_path)) == ["clean", "serving"]


def test_sizes_count_empty_tables(spark, tmp_path):
    raw_posts(spark).coalesce(2).write.parquet(str(tmp_path / "a"))
    raw_posts(spark).limit(0).coalesce(1).write.parquet(str(tmp_path / "b"))
    (tmp_path / "c").mkdir()
    sizes = maintenance.file_sizes(spark, {name: str(tmp_path / name) for name in "abc"}).collect()
    assert [(row.table, row.files > 0, row.bytes > 0) for row in sizes] == [("a", True, True), ("b", True, True), ("c", False, False)]
    assert tables.read_if_present(spark, str(tmp_path / "c")) is None


def test_top_above_the_limit_of_window_cuts(spark):
    rows = spark.range(5000).selectExpr("CAST(id AS STRING) AS id", "IF(id % 9 = 0, 'a', 'b') AS subreddit", "id AS created_utc")
    found = reports.recent_per_subreddit(rows, 1500)
    assert {r.subreddit: r["count"] for r in found.groupBy("subreddit").count().collect()} == {"a": 556, "b": 1500}
    assert found.filter("rank = 1500").first().created_utc == sorted((at for at in range(5000) if at % 9), reverse=True)[1499]


def test_incremental_curation(spark, tmp_path):
    raw, clean = str(tmp_path / "raw"), str(tmp_path / "clean")
    with pytest.raises(ValueError):
        raw_posts(spark).write.parquet(str(tmp_path / "plain"))
        curation.curate_community(spark, "news", str(tmp_path / "plain"), clean, incremental=True)
    gained = []
    for batch in range(2):
        raw_posts(spark, 60 + 20 * batch).write.parquet(f"{raw}/run=x/batch_id={batch}")
        gained += [curation.curate_community(spark, "news", raw, clean, incremental=True)["curated"] for _ in range(2)]
    assert gained == [30, 0, 10, 0]
    assert spark.read.parquet(clean).count() == 40 and len(spark.read.parquet(clean).columns) == 103
