"""Checks of sinks, table upkeep and the catalog. They write under the shared folder."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from postlake.operators import catalog, curate, maintenance, publish, reports
from postlake.plans import curation, fixtures
from postlake.plans.batch_checks import ROW, best_row_sql
from postlake.plans.registry import check, plain_time
from postlake.session import shared_folder
from postlake.streaming.queries import batch_writer

CURATED = ["event_id", "id", "title", "author", "score", "created_utc", "date", "year", "month", "day"]

# Curation sees whole seconds, so the earliest row is the one with the smallest second, then id, then arrival.
CURATED_SQL = """
curated AS (
  SELECT event_id, id, subreddit, title, author, score, num_comments, url, selftext,
         date_trunc('second', created_utc) AS created_utc,
         CAST(created_utc AS DATE) AS date, CAST(year(created_utc) AS INTEGER) AS year,
         CAST(month(created_utc) AS INTEGER) AS month, CAST(day(created_utc) AS INTEGER) AS day
  FROM (
    SELECT *, row_number() OVER (
      PARTITION BY title ORDER BY date_trunc('second', created_utc) ASC NULLS LAST, id, event_id) AS n
    FROM posts
  ) AS ranked WHERE n = 1
)"""


def curated_path(spark, folder) -> str:
    path = shared_folder(spark, "clean")
    curate.write_partitioned(curate.curate(fixtures.raw_posts(spark, folder), "event_id"), path)
    return path


@check("curate_partitioned", f"WITH {CURATED_SQL} SELECT {', '.join(CURATED)} FROM curated")
def curate_partitioned(spark, folder):
    clean = spark.read.parquet(curated_path(spark, folder))
    return clean.withColumns(plain_time("created_utc")).select(*CURATED)


@check(
    "partition_pruned_range",
    f"WITH {CURATED_SQL} SELECT event_id, title, date FROM curated WHERE date BETWEEN '2024-01-10' AND '2024-01-12'",
)
def partition_pruned_range(spark, folder):
    clean = spark.read.parquet(curated_path(spark, folder))
    return reports.in_date_range(clean, dt.date(2024, 1, 10), dt.date(2024, 1, 12)).select("event_id", "title", "date")


@check(
    "curate_increment",
    f"""
    WITH {CURATED_SQL}
    SELECT title, date, CASE WHEN date = '2024-01-15' THEN 'second run' ELSE 'first run' END AS written_by FROM curated
    """,
)
def curate_increment(spark, folder):
    """A second run over one day replaces that day's partition and leaves the others."""
    path = shared_folder(spark, "clean")
    full = curate.curate(fixtures.raw_posts(spark, folder), "event_id")
    curate.write_partitioned(full.withColumn("written_by", F.lit("first run")), path)
    again = full.filter(F.col("date") == "2024-01-15").withColumn("written_by", F.lit("second run"))
    curate.write_partitioned(again, path, mode="replace_days")
    return spark.read.parquet(path).select("title", "date", "written_by")


@check(
    "curate_across_batches",
    """
    WITH batches AS (
      SELECT *, CASE WHEN subreddit = 'view' THEN 1 ELSE 2 END AS batch FROM posts
    ), firsts AS (
      SELECT *, row_number() OVER (
        PARTITION BY title ORDER BY batch, date_trunc('second', created_utc) ASC NULLS LAST, id, event_id) AS n
      FROM batches
    )
    SELECT event_id, title, subreddit, CAST(created_utc AS DATE) AS date FROM firsts WHERE n = 1
    """,
)
def curate_across_batches(spark, folder):
    """`view` posts arrive first; the second batch adds only titles that are new."""
    path = shared_folder(spark, "clean")
    raw = fixtures.raw_posts(spark, folder)
    curate.write_partitioned(curate.curate(raw.filter("subreddit = 'view'"), "event_id"), path)
    later = curate.curate_batch(raw.filter("subreddit <> 'view'"), spark.read.parquet(path), "event_id")
    curate.write_partitioned(later, path, mode="append")
    return spark.read.parquet(path).select("event_id", "title", "subreddit", "date")


PUBLISHED = ["post_id", "title", "author", "score", "num_comments", "created_utc", "url", "selftext"]


def newest_sql(where: str) -> str:
    return best_row_sql("id", "created_utc DESC NULLS LAST, event_id", "*", where)


@check(
    "publish_modes",
    f"""
    WITH seen AS ({newest_sql("subreddit = 'view'")}), every AS ({newest_sql("true")}),
         merged AS (SELECT * FROM seen UNION ALL SELECT * FROM every WHERE id NOT IN (SELECT id FROM seen))
    SELECT id AS post_id, title, author, score, num_comments, created_utc, url, selftext FROM merged
    """,
)
def publish_modes(spark, folder):
    """`view` posts are published first, then all posts twice: only new ids are added, and only once."""
    posts = fixtures.posts(spark, folder)
    target = publish.ServingTable(path=shared_folder(spark, "serving"))
    for batch in (posts.filter(F.col("subreddit") == "view"), posts, posts):
        publish.publish(batch, target, "skip", "event_id")
    return target.read(spark).select(*PUBLISHED)


@check(
    "publish_overwrite",
    f"""
    WITH clicked AS ({newest_sql("subreddit = 'click'")})
    SELECT id AS post_id, title, author, score, num_comments, created_utc, url, selftext FROM clicked
    """,
)
def publish_overwrite(spark, folder):
    posts = fixtures.posts(spark, folder)
    target = publish.ServingTable(path=shared_folder(spark, "serving"))
    publish.publish(posts, target, "overwrite", "event_id")
    publish.publish(posts.filter(F.col("subreddit") == "click"), target, "overwrite", "event_id")
    return target.read(spark).select(*PUBLISHED)


@check("publish_full", f"WITH {CURATED_SQL} SELECT {', '.join(CURATED)} FROM curated")
def publish_full(spark, folder):
    target = publish.ServingTable(path=shared_folder(spark, "serving"))
    publish.publish_full(spark.read.parquet(curated_path(spark, folder)), target)
    return target.read(spark).withColumns(plain_time("created_utc")).select(*CURATED)


@check(
    "sample_publish",
    """
    SELECT id AS post_id, title, author, score, num_comments, created_utc, url, selftext FROM posts
    ORDER BY post_id, title, author, score, num_comments, created_utc LIMIT 100
    """,
)
def sample_publish(spark, folder):
    target = publish.ServingTable(path=shared_folder(spark, "serving"))
    publish.publish_sample(fixtures.posts(spark, folder), target)
    return target.read(spark)


@check("create_or_append", f"SELECT {ROW} FROM posts")
def create_or_append(spark, folder):
    posts = fixtures.posts(spark, folder)
    path = shared_folder(spark, "raw")
    for name in fixtures.COMMUNITIES:
        maintenance.append_rows(posts.filter(F.col("subreddit") == name), path)
    return spark.read.parquet(path)


@check("rewrite_table", best_row_sql("id", "created_utc DESC NULLS LAST, event_id", ROW))
def rewrite_table(spark, folder):
    path = shared_folder(spark, "raw")
    maintenance.append_rows(fixtures.posts(spark, folder), path)
    maintenance.rewrite_deduplicated(spark, path, arrival="event_id")
    return spark.read.parquet(path)


@check(
    "curation_metrics",
    f"""
    WITH {CURATED_SQL}, gained AS (
      SELECT count(DISTINCT id) AS n FROM curated WHERE id NOT IN (SELECT id FROM posts WHERE subreddit = 'view')
    )
    SELECT 'events' AS subreddit, (SELECT count(*) FROM posts) AS "read", (SELECT count(*) FROM curated) AS curated,
           n AS published, (SELECT count(*) FROM curated) - n AS skipped
    FROM gained
    """,
)
def curation_metrics(spark, folder):
    raw = shared_folder(spark, "raw")
    maintenance.append_rows(fixtures.raw_posts(spark, folder), raw)
    earlier = fixtures.raw_posts(spark, folder).filter(F.col("subreddit") == "view")
    target = publish.ServingTable(path=shared_folder(spark, "serving"))
    publish.publish(curate.with_timestamps(earlier), target)
    run = curation.curate_community(
        spark, "events", raw, shared_folder(spark, "clean"), target, arrival="event_id"
    )
    return curation.metrics_frame(spark, [run])


@check("file_manifest", f"WITH {CURATED_SQL} SELECT DISTINCT year, month, day, true AS has_files FROM curated")
def file_manifest(spark, folder):
    path = shared_folder(spark, "manifest")
    maintenance.write_manifest(spark, curated_path(spark, folder), path)
    listed = spark.read.text(path).groupBy("year", "month", "day").agg(F.count("value").alias("files"))
    return listed.select("year", "month", "day", (F.col("files") >= 1).alias("has_files"))


@check(
    "table_sizes",
    """
    SELECT 'events' AS "table", CAST(1 AS BIGINT) AS files, count(*) > 0 AS has_bytes FROM events
    UNION ALL SELECT 'documents', 1, count(*) > 0 FROM documents
    UNION ALL SELECT 'pages', 1, count(*) > 0 FROM pages
    UNION ALL SELECT 'empty', 1, true
    UNION ALL SELECT 'none', 0, false
    """,
)
def table_sizes(spark, folder):
    """Three tables, one whose only file has no rows, and one without files."""
    paths = {name: f"{folder}/{name}.parquet" for name in ("events", "documents", "pages")}
    paths |= {name: shared_folder(spark, name) for name in ("empty", "none")}
    events = fixtures.table(spark, folder, "events")
    events.limit(0).coalesce(1).write.parquet(paths["empty"])
    events.filter("event_id < 0").write.partitionBy("event_type").parquet(paths["none"])
    sizes = maintenance.file_sizes(spark, paths)
    return sizes.select("table", "files", (F.col("bytes") > 0).alias("has_bytes"))


@check(
    "curate_incremental_job",
    """
    WITH batches AS (
      SELECT *, CASE WHEN subreddit = 'view' THEN 1 ELSE 2 END AS batch FROM posts
    ), firsts AS (
      SELECT *, row_number() OVER (
        PARTITION BY title ORDER BY batch, date_trunc('second', created_utc) ASC NULLS LAST, id, event_id) AS n
      FROM batches
    )
    SELECT id, title, subreddit, author, score, CAST(created_utc AS DATE) AS date, CAST(103 AS INTEGER) AS columns,
           false AS edited
    FROM firsts WHERE n = 1
    """,
)
def curate_incremental_job(spark, folder):
    """Two batches are ingested and curated one after the other, a third run finds nothing new."""
    base = shared_folder(spark, "lake")
    raw = fixtures.payload(fixtures.raw_posts(spark, folder), "subreddit", F.col("event_id").alias("arrival"))
    write = batch_writer(f"{base}/news", f"{base}/quarantine", f"{base}/dead", unique_ids=False)
    for number, batch in enumerate((raw.filter("subreddit = 'view'"), raw.filter("subreddit <> 'view'"))):
        write(batch.select("arrival", "value"), number)
        for _ in range(2):
            curation.curate_community(spark, "news", f"{base}/news", f"{base}/news_clean", incremental=True)
    clean = spark.read.parquet(f"{base}/news_clean")
    shown = clean.withColumn("columns", F.lit(len(clean.columns)))
    return shown.select("id", "title", "subreddit", "author", "score", "date", "columns", "edited")


@check(
    "repair_partitions",
    f"""
    WITH {CURATED_SQL} SELECT year, month, day, count(*) AS post_count FROM curated GROUP BY year, month, day
    """,
)
def repair_partitions(spark, folder):
    path = curated_path(spark, folder)
    table = "clean_" + path.rsplit("-", 1)[1]
    catalog.register_table(
        spark, table, path, schema=spark.read.parquet(path).schema, partitions=["year", "month", "day"]
    )
    repaired = maintenance.repair_partitions(spark, table)
    return repaired.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("post_count"))


@check(
    "catalog_inventory",
    """
    SELECT 'documents' AS table_name, 5 AS column_count, count(*) AS row_count FROM documents
    UNION ALL SELECT 'events', 6, count(*) FROM events
    UNION ALL SELECT 'pages', 3, count(*) FROM pages
    """,
)
def catalog_inventory(spark, folder):
    location = shared_folder(spark, "database")
    database = "posts_" + location.rsplit("-", 1)[1]
    catalog.create_schema(spark, database, location)
    paths = {name: f"{folder}/{name}.parquet" for name in ("documents", "events", "pages")}
    catalog.register_communities(spark, database, paths)
    return catalog.inventory(spark, database)


@check(
    "table_columns",
    """
    SELECT 'event_id' AS name, 'bigint' AS type, count(event_id) AS non_null FROM events
    UNION ALL SELECT 'ts', 'timestamp_ntz', count(ts) FROM events
    UNION ALL SELECT 'user_id', 'bigint', count(user_id) FROM events
    UNION ALL SELECT 'event_type', 'string', count(event_type) FROM events
    UNION ALL SELECT 'value', 'double', count(value) FROM events
    UNION ALL SELECT 'props', 'string', count(props) FROM events
    """,
)
def table_columns(spark, folder):
    """Names and types from the catalog, counts from the table."""
    location = shared_folder(spark, "database")
    database = "columns_" + location.rsplit("-", 1)[1]
    catalog.create_schema(spark, database, location)
    catalog.register_communities(spark, database, {"events": f"{folder}/events.parquet"})
    described = catalog.table_columns(spark, f"{database}.events")
    counted = catalog.column_report(spark.table(f"{database}.events")).select("name", "non_null")
    return described.join(counted, "name").select("name", "type", "non_null")


@check(
    "publish_fail_mode",
    "SELECT count(DISTINCT id) AS rows_kept, true AS refused FROM posts",
)
def publish_fail_mode(spark, folder):
    """The second publication of the same ids is refused and the table stays as it was."""
    posts = fixtures.posts(spark, folder)
    target = publish.ServingTable(path=shared_folder(spark, "serving"))
    publish.publish(posts, target, "fail")
    try:
        publish.publish(posts, target, "fail")
        refused = False
    except ValueError:
        refused = True
    return target.read(spark).agg(F.count(F.lit(1)).alias("rows_kept")).withColumn("refused", F.lit(refused))
