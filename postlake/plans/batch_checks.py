"""Checks of parsing, scalar functions, filters, joins, deduplication, reports and top-k."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from postlake.functions.columns import (
    encode_json,
    is_outbound_link,
    iso_timestamp,
    relative_age,
    select_available,
    table_name,
    topic_name,
    truncate_text,
    with_optional,
)
from postlake.operators import curate, dedup, feed, matching, publish, reports
from postlake.plans import fixtures
from postlake.plans.registry import check, plain_time
from postlake.schema import POST_SCHEMA, SERVING_COLUMNS, TOPIC_PREFIX
from postlake.sources import messages, tables
from postlake.streaming.queries import monitor_columns

NOW = dt.datetime(2024, 1, 31)

PARSED = ["event_id", "id", "subreddit", "title", "author", "score", "num_comments", "created_utc", "url", "selftext"]
PARSED_SQL = """
SELECT event_id, id, subreddit, title, author, score, num_comments,
       CAST(floor(epoch(created_utc)) AS DOUBLE) AS created_utc, url, selftext
FROM posts
"""


# Scans


@check("scan_raw_posts", "SELECT * FROM posts")
def scan_raw_posts(spark, folder):
    return fixtures.event_posts(tables.read_table(spark, f"{folder}/events.parquet"))


@check("distinct_existing_ids", "SELECT DISTINCT id AS post_id FROM posts")
def distinct_existing_ids(spark, folder):
    return matching.distinct_ids(publish.serving_rows(fixtures.posts(spark, folder)))


@check(
    "tolerant_union_load",
    """
    SELECT 'events' AS subreddit, id, author, score FROM posts
    UNION ALL
    SELECT 'documents', CAST(doc_id AS VARCHAR), source, CAST(n_chars AS INTEGER) FROM documents
    """,
)
def tolerant_union_load(spark, folder):
    paths = {name: f"{folder}/{name}.parquet" for name in ("events", "documents", "not_collected_yet")}

    def shape(name, table):
        rows = fixtures.event_posts(table) if name == "events" else fixtures.document_rows(table)
        return rows.select("id", "author", "score")

    return tables.load_union(spark, paths, shape=shape).select("subreddit", "id", "author", "score")


@check(
    "view_sql_report",
    """
    SELECT CAST(created_utc AS DATE) AS date, count(*) AS post_count FROM posts GROUP BY 1 ORDER BY 1
    """,
)
def view_sql_report(spark, folder):
    sql = "SELECT to_date(created_utc) AS date, count(*) AS post_count FROM post_view GROUP BY 1 ORDER BY 1"
    return reports.view_report(fixtures.posts(spark, folder), "post_view", sql)


@check("preview_rows", "SELECT * FROM posts ORDER BY event_id LIMIT 100")
def preview_rows(spark, folder):
    return reports.preview(fixtures.posts(spark, folder), ["event_id"], 100)


@check(
    "listing_unwrap",
    """
    SELECT id, title, score, 't3_' || CAST(event_id AS VARCHAR) AS after FROM posts WHERE subreddit <> 'error'
    """,
)
def listing_unwrap(spark, folder):
    unwrapped = messages.unwrap_listing(fixtures.listings(spark, folder))
    return messages.parse_posts(unwrapped).select("id", "title", "score", "after")


# Parsing


@check("parse_json_payload", PARSED_SQL)
def parse_json_payload(spark, folder):
    return messages.parse_fields(fixtures.post_messages(spark, folder), *PARSED[1:]).select(*PARSED)


@check(
    "nested_to_json_text",
    """
    SELECT event_id, '{"k":' || CAST(num_comments AS VARCHAR) || ',"tags":["' || subreddit || '"]}' AS media FROM posts
    """,
)
def nested_to_json_text(spark, folder):
    return messages.parse_fields(fixtures.post_messages(spark, folder), "media")


@check("schema_null_fill", "SELECT event_id, 10 AS filled, 89 AS missing FROM events")
def schema_null_fill(spark, folder):
    parsed = messages.parse_posts(fixtures.post_messages(spark, folder))
    present = F.size(F.array_compact(F.array(*[F.col(name).cast("string") for name in POST_SCHEMA.names])))
    return parsed.select("event_id", present.alias("filled"), (len(POST_SCHEMA) - present).alias("missing"))


@check("quarantine_malformed", "SELECT text AS message FROM documents")
def quarantine_malformed(spark, folder):
    return messages.quarantined(messages.parse_messages(fixtures.mixed_messages(spark, folder), messages.ID_ONLY))


@check("malformed_by_id", "SELECT text AS message FROM documents")
def malformed_by_id(spark, folder):
    return messages.malformed(fixtures.mixed_messages(spark, folder))


@check("parse_mixed_messages", "SELECT id, title, score FROM posts")
def parse_mixed_messages(spark, folder):
    return messages.parse_fields(fixtures.mixed_messages(spark, folder), "id", "title", "score")


@check(
    "drop_nested_keys",
    """
    SELECT event_id,
           'author,created_utc,id,media,num_comments,score,selftext,subreddit,title,unlisted_field,url' AS keys
    FROM events
    """,
)
def drop_nested_keys(spark, folder):
    kept = messages.drop_nested_keys(F.col("value"))
    names = F.array_join(F.array_sort(F.map_keys(kept)), ",")
    return fixtures.post_messages(spark, folder).select("event_id", names.alias("keys"))


# Scalar functions


@check(
    "epoch_to_timestamp",
    """
    SELECT event_id, date_trunc('second', created_utc) AS created_utc, date_trunc('second', created_utc) AS created,
           true AS no_approval, true AS no_ban
    FROM posts
    """,
)
def epoch_to_timestamp(spark, folder):
    cast = curate.with_timestamps(fixtures.raw_posts(spark, folder)).withColumns(plain_time("created_utc", "created"))
    return cast.select(
        "event_id",
        "created_utc",
        "created",
        F.col("approved_at_utc").isNull().alias("no_approval"),
        F.col("banned_at_utc").isNull().alias("no_ban"),
    )


@check(
    "date_parts",
    """
    SELECT event_id, CAST(created_utc AS DATE) AS date, CAST(year(created_utc) AS INTEGER) AS year,
           CAST(month(created_utc) AS INTEGER) AS month, CAST(day(created_utc) AS INTEGER) AS day
    FROM posts
    """,
)
def date_parts(spark, folder):
    parts = curate.with_date_parts(fixtures.posts(spark, folder))
    return parts.select("event_id", "date", "year", "month", "day")


@check(
    "select_available",
    """
    SELECT CAST(doc_id AS VARCHAR) AS id, text AS title, source AS author, CAST(n_chars AS INTEGER) AS score
    FROM documents
    """,
)
def select_available_columns(spark, folder):
    return select_available(fixtures.document_posts(spark, folder), SERVING_COLUMNS)


@check(
    "publish_projection",
    "SELECT id AS post_id, title, author, score, num_comments, created_utc, url, selftext FROM posts",
)
def publish_projection(spark, folder):
    return publish.serving_rows(fixtures.posts(spark, folder))


@check(
    "derive_table_name",
    f"SELECT event_id, lower(replace(title, ' ', '_')) AS table_name, '{TOPIC_PREFIX}' || subreddit AS topic FROM posts",
)
def derive_table_name(spark, folder):
    names = table_name(F.col("title")).alias("table_name"), topic_name(F.col("subreddit")).alias("topic")
    return fixtures.posts(spark, folder).select("event_id", *names)


@check(
    "optional_columns",
    """
    SELECT CAST(doc_id AS VARCHAR) AS id, 'int' AS count_type, 'timestamp' AS time_type, true AS is_unset
    FROM documents
    """,
)
def optional_columns(spark, folder):
    rows = with_optional(fixtures.document_posts(spark, folder), {"num_comments": "int", "created_utc": "timestamp"})
    return rows.selectExpr(
        "id",
        "typeof(num_comments) AS count_type",
        "typeof(created_utc) AS time_type",
        "num_comments IS NULL AND created_utc IS NULL AS is_unset",
    )


@check(
    "iso_timestamp",
    "SELECT event_id, replace(strftime(created_utc, '%Y-%m-%dT%H:%M:%S.%f'), '.000000', '') AS created FROM posts",
)
def iso_timestamps(spark, folder):
    return fixtures.posts(spark, folder).select("event_id", iso_timestamp(F.col("created_utc")).alias("created"))


@check(
    "relative_age",
    """
    WITH ages AS (
      SELECT event_id, (epoch_ms(TIMESTAMP '2024-01-31') - epoch_ms(created_utc)) // 1000 AS s FROM posts
    )
    SELECT event_id,
           CASE WHEN s < 60 THEN CAST(s AS VARCHAR) || 's ago'
                WHEN s < 3600 THEN CAST(s // 60 AS VARCHAR) || 'm ago'
                WHEN s < 86400 THEN CAST(s // 3600 AS VARCHAR) || 'h ago'
                ELSE CAST(s // 86400 AS VARCHAR) || 'd ago' END AS age
    FROM ages
    """,
)
def relative_ages(spark, folder):
    age = relative_age(F.col("created_utc"), F.lit(NOW))
    return fixtures.posts(spark, folder).select("event_id", age.alias("age"))


@check(
    "external_link_flag",
    "SELECT page_id, url IS NOT NULL AND url <> '' AND NOT contains(url, 'example.org') AS is_link FROM pages",
)
def external_link_flag(spark, folder):
    flag = is_outbound_link(F.col("url"), "example.org")
    return fixtures.table(spark, folder, "pages").select("page_id", flag.alias("is_link"))


@check("truncate_text", "SELECT page_id, substring(html, 1, 80) AS shown FROM pages")
def truncated_text(spark, folder):
    return fixtures.table(spark, folder, "pages").select("page_id", truncate_text(F.col("html"), 80).alias("shown"))


@check(
    "json_encode_rows",
    """
    SELECT event_id, '{"id":"' || id || '","title":"' || title || '","score":' || CAST(score AS VARCHAR) || '}' AS value
    FROM posts
    """,
)
def json_encode_rows(spark, folder):
    value = encode_json(["id", "title", "score"]).cast("string")
    return fixtures.posts(spark, folder).select("event_id", value.alias("value"))


@check(
    "monitor_projection",
    "SELECT subreddit, title, score, date_trunc('second', created_utc) AS created_utc FROM posts",
)
def monitor_projection(spark, folder):
    return monitor_columns(fixtures.raw_posts(spark, folder)).withColumns(plain_time("created_utc"))


# Filters and joins


@check("feed_filter_subreddit", "SELECT * FROM posts WHERE subreddit = 'click'")
def feed_filter_subreddit(spark, folder):
    return feed.filter_subreddit(fixtures.posts(spark, folder), "click", fixtures.COMMUNITIES)


@check(
    "feed_search",
    "SELECT doc_id AS event_id FROM documents WHERE contains(lower(text), 'tion') OR contains(lower(source), 'tion')",
)
def feed_search(spark, folder):
    return feed.search_posts(fixtures.document_posts(spark, folder), "Tion").select("event_id")


@check(
    "high_engagement_recent",
    """
    SELECT event_id, title, score, created_utc FROM posts WHERE score > 100
    ORDER BY created_utc DESC NULLS LAST, event_id LIMIT 20
    """,
)
def high_engagement_recent(spark, folder):
    columns = ["event_id", "title", "score", "created_utc"]
    return reports.high_engagement_recent(fixtures.posts(spark, folder), columns, tie="event_id")


@check(
    "last_24h",
    """
    SELECT event_id, title, author, score, created_utc FROM posts
    WHERE created_utc > (SELECT max(created_utc) FROM posts) - INTERVAL 24 HOUR
    """,
)
def last_24h(spark, folder):
    posts = fixtures.posts(spark, folder)
    now = posts.select(F.max("created_utc")).scalar()
    return reports.last_hours(posts, now).select("event_id", "title", "author", "score", "created_utc")


@check(
    "non_null_range",
    """
    SELECT min(created_utc) AS oldest, max(created_utc) AS newest, count(*) AS total FROM posts
    WHERE created_utc IS NOT NULL
    """,
)
def non_null_range(spark, folder):
    return reports.non_null_range(fixtures.posts(spark, folder), "created_utc")


@check(
    "skip_existing",
    """
    SELECT id AS post_id, title, author, score, created_utc FROM posts
    WHERE id NOT IN (SELECT id FROM posts WHERE subreddit = 'view')
    """,
)
def skip_existing(spark, folder):
    posts = fixtures.posts(spark, folder)
    published = publish.serving_rows(posts.filter(F.col("subreddit") == "view"))
    new = publish.serving_rows(posts).select("post_id", "title", "author", "score", "created_utc")
    return matching.skip_existing(new, published)


@check(
    "semi_new_titles",
    """
    SELECT event_id, title, score FROM posts WHERE title IN (SELECT title FROM posts WHERE subreddit = 'purchase')
    """,
)
def semi_new_titles(spark, folder):
    posts = fixtures.posts(spark, folder)
    bought = posts.filter(F.col("subreddit") == "purchase")
    return matching.keep_existing(posts.select("event_id", "title", "score"), bought, "title")


@check(
    "reconcile_keys",
    """
    WITH r AS (SELECT id, count(*) AS n FROM posts WHERE subreddit <> 'signup' GROUP BY id),
         c AS (SELECT id, count(*) AS n FROM posts WHERE subreddit <> 'error' GROUP BY id)
    SELECT coalesce(r.id, c.id) AS id, coalesce(r.n, 0) AS raw_rows, coalesce(c.n, 0) AS clean_rows,
           CASE WHEN c.id IS NULL THEN 'raw only' WHEN r.id IS NULL THEN 'clean only' ELSE 'both' END AS status
    FROM r FULL OUTER JOIN c ON r.id = c.id
    """,
)
def reconcile_keys(spark, folder):
    posts = fixtures.posts(spark, folder)
    raw, clean = posts.filter("subreddit <> 'signup'"), posts.filter("subreddit <> 'error'")
    return matching.reconcile_keys(raw, clean, "id")


# Deduplication


def best_row_sql(key: str, order: str, columns: str = "*", where: str = "true") -> str:
    return f"""
    SELECT {columns} FROM (
      SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS n FROM posts WHERE {where}
    ) AS ranked WHERE n = 1
    """


ROW = "event_id, id, subreddit, title, author, score, num_comments, created_utc, url, selftext"


@check("dedup_title", best_row_sql("title", "created_utc ASC NULLS LAST, id, event_id", ROW))
def dedup_title(spark, folder):
    return dedup.dedup_title(fixtures.posts(spark, folder), "event_id")


@check("dedup_latest", best_row_sql("id", "created_utc DESC NULLS LAST, event_id", ROW))
def dedup_latest(spark, folder):
    return dedup.dedup_latest(fixtures.posts(spark, folder), "event_id")


@check("dedup_first", best_row_sql("id", "event_id", ROW.replace(" created_utc,", "")))
def dedup_first(spark, folder):
    return dedup.dedup_latest(fixtures.posts(spark, folder).drop("created_utc"), "event_id")


@check(
    "dedup_without_arrival",
    """
    SELECT CAST(event_id AS VARCHAR) AS id, title, score, 'a' AS first, CAST(NULL AS VARCHAR) AS second FROM posts
    """,
)
def dedup_without_arrival(spark, folder):
    """Rows that tie in every way but where their nulls stand: the same one is kept whatever their order."""
    posts = fixtures.posts(spark, folder).select(F.col("event_id").cast("string").alias("id"), "title", "score")
    left = posts.withColumns({"first": F.lit(None).cast("string"), "second": F.lit("a")})
    right = posts.withColumns({"first": F.lit("a"), "second": F.lit(None).cast("string")})
    return dedup.dedup_first(left.unionAll(right))


@check("dedup_highest_score", best_row_sql("id", "coalesce(score, 0) DESC, event_id", ROW, "id <> ''"))
def dedup_highest_score(spark, folder):
    return dedup.dedup_posts(fixtures.posts(spark, folder), "highest_score", "id", "event_id")


@check("dedup_most_recent", best_row_sql("id", "created_utc DESC NULLS LAST, event_id", ROW, "id <> ''"))
def dedup_most_recent(spark, folder):
    return dedup.dedup_posts(fixtures.posts(spark, folder), "most_recent", "id", "event_id")


@check(
    "dedup_document_text",
    """
    SELECT doc_id, lang, source FROM (
      SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS n FROM documents
    ) AS ranked WHERE n = 1
    """,
)
def dedup_document_text(spark, folder):
    rows = fixtures.document_posts(spark, folder)
    kept = dedup.keep_best(rows, ["title"], [F.asc("event_id")])
    return kept.selectExpr("event_id AS doc_id", "subreddit AS lang", "author AS source")


@check(
    "rewrite_dedup_stats",
    """
    WITH per AS (
      SELECT subreddit, count(*) AS b, count(DISTINCT id) AS a FROM posts GROUP BY subreddit
    ), every AS (
      SELECT * FROM per UNION ALL SELECT 'TOTAL', CAST(sum(b) AS BIGINT), CAST(sum(a) AS BIGINT) FROM per
    )
    SELECT subreddit, b AS before_count, a AS after_count, b - a AS duplicates_removed,
           round((b - a) * 100.0 / CAST(b AS DOUBLE), 2) AS percent_removed
    FROM every
    """,
)
def rewrite_dedup_stats(spark, folder):
    return dedup.dedup_stats(fixtures.posts(spark, folder))


# Reports and top-k


@check("total_count", "SELECT count(*) AS total FROM posts")
def total_count(spark, folder):
    return reports.total_count(fixtures.posts(spark, folder))


@check("count_by_date", "SELECT CAST(created_utc AS DATE) AS date, count(*) AS post_count FROM posts GROUP BY 1")
def count_by_date(spark, folder):
    return reports.count_by_date(fixtures.posts(spark, folder))


BY_DATE_SUBREDDIT_SQL = """
SELECT CAST(created_utc AS DATE) AS post_date, subreddit, count(*) AS post_count FROM posts GROUP BY 1, 2
"""


@check("raw_counts_by_date_subreddit", BY_DATE_SUBREDDIT_SQL)
def raw_counts_by_date_subreddit(spark, folder):
    return reports.count_by_date_subreddit(fixtures.raw_posts(spark, folder))


@check(
    "curated_counts",
    """
    WITH firsts AS (
      SELECT *, row_number() OVER (PARTITION BY title ORDER BY created_utc ASC NULLS LAST, id, event_id) AS n FROM posts
    )
    SELECT CAST(created_utc AS DATE) AS post_date, subreddit, count(*) AS post_count
    FROM firsts WHERE n = 1 GROUP BY 1, 2
    """,
)
def curated_counts(spark, folder):
    unique = dedup.dedup_title(fixtures.posts(spark, folder), "event_id")
    return reports.count_by_date_subreddit(unique)


@check("count_by_date_subreddit", BY_DATE_SUBREDDIT_SQL)
def count_by_date_subreddit(spark, folder):
    return reports.count_by_date_subreddit(fixtures.posts(spark, folder))


@check(
    "top_counts_by_date_subreddit",
    BY_DATE_SUBREDDIT_SQL + "ORDER BY post_date DESC NULLS LAST, post_count DESC, subreddit ASC NULLS LAST LIMIT 20",
)
def top_counts_by_date_subreddit(spark, folder):
    return reports.count_by_date_subreddit(fixtures.posts(spark, folder), 20, largest_first=True)


@check(
    "first_counts_by_date_subreddit",
    BY_DATE_SUBREDDIT_SQL + "ORDER BY post_date DESC NULLS LAST, subreddit ASC NULLS LAST LIMIT 20",
)
def first_counts_by_date_subreddit(spark, folder):
    return reports.count_by_date_subreddit(fixtures.posts(spark, folder), 20)


@check(
    "top_authors_by_score",
    """
    SELECT author, count(*) AS post_count, CAST(sum(score) AS BIGINT) AS total_score, avg(score) AS avg_score
    FROM posts GROUP BY author ORDER BY total_score DESC NULLS LAST, author LIMIT 25
    """,
)
def top_authors_by_score(spark, folder):
    return reports.top_authors_by_score(fixtures.posts(spark, folder))


@check(
    "top_authors_by_count",
    "SELECT author, count(*) AS post_count FROM posts GROUP BY author ORDER BY post_count DESC, author LIMIT 20",
)
def top_authors_by_count(spark, folder):
    return reports.top_authors_by_count(fixtures.posts(spark, folder))


@check(
    "time_range", "SELECT min(created_utc) AS oldest, max(created_utc) AS newest, count(*) AS total FROM posts"
)
def time_range(spark, folder):
    return reports.time_range(fixtures.posts(spark, folder))


@check(
    "summary_by_subreddit",
    """
    SELECT subreddit, count(*) AS records, avg(score) AS avg_score, avg(num_comments) AS avg_comments
    FROM posts GROUP BY subreddit
    """,
)
def summary_by_subreddit(spark, folder):
    return reports.summary_by_subreddit(fixtures.posts(spark, folder))


@check(
    "raw_vs_clean",
    """
    SELECT count(*) AS raw_count, count(DISTINCT title) AS clean_count,
           count(*) - count(DISTINCT title) AS filtered_count
    FROM posts
    """,
)
def raw_vs_clean(spark, folder):
    posts = fixtures.posts(spark, folder)
    return reports.raw_vs_clean(posts, dedup.dedup_title(posts, "event_id"))


@check(
    "count_per_table",
    """
    SELECT 'events' AS subreddit, count(*) AS posts FROM events
    UNION ALL SELECT 'documents', count(*) FROM documents
    UNION ALL SELECT 'pages', count(*) FROM pages
    UNION ALL SELECT 'conversations', count(*) FROM conversations
    UNION ALL SELECT 'empty', 0
    """,
)
def count_per_table(spark, folder):
    counted = fixtures.community_tables(spark, folder)
    return reports.count_per_table(counted | {"empty": counted["events"].filter("score < 0")})


RECENT_SQL = "SELECT event_id, title, author, created_utc FROM posts ORDER BY created_utc"
RECENT = ["event_id", "title", "author", "created_utc"]


@check("most_recent_posts", RECENT_SQL + " DESC NULLS LAST, event_id LIMIT 100")
def most_recent_posts(spark, folder):
    return reports.most_recent(fixtures.posts(spark, folder), RECENT, 100, "event_id")


@check("oldest_posts", RECENT_SQL + " ASC NULLS LAST, event_id LIMIT 10")
def oldest_posts(spark, folder):
    return reports.oldest_posts(fixtures.posts(spark, folder), RECENT, 10, "event_id")


@check("newest_post", RECENT_SQL + " DESC NULLS LAST, event_id LIMIT 1")
def newest_post(spark, folder):
    return reports.newest_post(fixtures.posts(spark, folder), RECENT, "event_id")


@check(
    "top_scoring",
    "SELECT event_id, title, score FROM posts ORDER BY score DESC NULLS LAST, event_id LIMIT 10",
)
def top_scoring(spark, folder):
    return reports.top_scoring(fixtures.posts(spark, folder), ["event_id", "title", "score"], 10, "event_id")


@check(
    "latest_retrieved",
    """
    SELECT event_id, title FROM posts
    ORDER BY CASE WHEN num_comments >= 50 THEN created_utc END DESC NULLS LAST, event_id LIMIT 15
    """,
)
def latest_retrieved(spark, folder):
    posts = fixtures.posts(spark, folder)
    seen = posts.withColumn("retrieved_at", F.when(F.col("num_comments") >= 50, F.col("created_utc")))
    return reports.latest_retrieved(seen, ["event_id", "title"], tie="event_id")


@check(
    "recent_per_subreddit",
    """
    SELECT subreddit, event_id, title, created_utc, CAST(n AS INTEGER) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY subreddit ORDER BY created_utc DESC NULLS LAST, event_id) AS n FROM posts
    ) AS ranked WHERE n <= 10
    """,
)
def recent_per_subreddit(spark, folder):
    ranked = reports.recent_per_subreddit(fixtures.posts(spark, folder), 10, "event_id")
    return ranked.select("subreddit", "event_id", "title", "created_utc", "rank")


@check(
    "union_all_recent",
    """
    WITH u AS (
      SELECT id, title, created_utc FROM posts
      UNION ALL SELECT CAST(doc_id AS VARCHAR), text, NULL FROM documents
      UNION ALL SELECT CAST(page_id AS VARCHAR), NULL, NULL FROM pages
      UNION ALL SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR), text, NULL FROM conversations
    )
    SELECT id, title, created_utc FROM u ORDER BY created_utc DESC NULLS LAST, id LIMIT 100
    """,
)
def union_all_recent(spark, folder):
    united = feed.union_all(list(fixtures.community_tables(spark, folder).values()))
    return reports.most_recent(united, ["id", "title", "created_utc"], 100)


@check(
    "tagged_union",
    """
    SELECT 'events' AS subreddit, id, coalesce(title, '') AS title, coalesce(score, -1) AS score FROM posts
    UNION ALL SELECT 'documents', CAST(doc_id AS VARCHAR), text, CAST(n_chars AS INTEGER) FROM documents
    UNION ALL SELECT 'pages', CAST(page_id AS VARCHAR), '', -1 FROM pages
    UNION ALL SELECT 'conversations', CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR), text, -1
    FROM conversations
    """,
)
def tagged_union(spark, folder):
    united = feed.tagged_union(fixtures.community_tables(spark, folder))
    return united.selectExpr("subreddit", "id", "coalesce(title, '') AS title", "coalesce(score, -1) AS score")
