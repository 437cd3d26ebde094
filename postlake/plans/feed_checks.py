"""Checks of the feed: pages, summaries and the list of communities."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlake.operators import cursor, feed, search_index
from postlake.plans import fixtures
from postlake.plans.registry import check
from postlake.session import shared_folder

FEED = """
post_id, title, author, score, num_comments,
replace(strftime(created_utc, '%Y-%m-%dT%H:%M:%S.%f'), '.000000', '') AS created_utc, url, selftext, subreddit
"""
CLEAN = "(SELECT *, id AS post_id FROM posts) AS clean"
BEST = """(
  SELECT *, id AS post_id,
         row_number() OVER (PARTITION BY id ORDER BY coalesce(score, 0) DESC, event_id) AS n
  FROM posts WHERE {where}
) AS best WHERE n = 1
"""
SEARCH = "(contains(lower(title), '{text}') OR contains(lower(author), '{text}'))"


def tables(spark, folder):
    return fixtures.posts(spark, folder), fixtures.COMMUNITIES


@check(
    "feed_page",
    f"SELECT {FEED} FROM {CLEAN} ORDER BY clean.created_utc DESC NULLS LAST, post_id, event_id LIMIT 25 OFFSET 50",
)
def feed_page(spark, folder):
    return feed.feed_page(*tables(spark, folder), offset=50, arrival="event_id")


@check(
    "feed_page_searched",
    f"""
    SELECT {FEED} FROM {CLEAN} WHERE subreddit = 'click' AND {SEARCH.format(text="post 1")}
    ORDER BY score ASC NULLS LAST, post_id, event_id LIMIT 100
    """,
)
def feed_page_searched(spark, folder):
    return feed.feed_page(
        *tables(spark, folder),
        limit=100,
        subreddit="click",
        search="POST 1",
        sort="score",
        order="asc",
        arrival="event_id",
    )


@check(
    "feed_page_unknown_names",
    f"SELECT {FEED} FROM {CLEAN} ORDER BY clean.created_utc DESC NULLS LAST, post_id, event_id LIMIT 25",
)
def feed_page_unknown_names(spark, folder):
    return feed.feed_page(*tables(spark, folder), subreddit="unlisted", sort="unlisted", arrival="event_id")


@check(
    "feed_page_raw",
    f"""
    SELECT {FEED} FROM {BEST.format(where="id <> ''")}
    ORDER BY coalesce(score, 0) DESC, post_id LIMIT 25 OFFSET 25
    """,
)
def feed_page_raw(spark, folder):
    return feed.feed_page(*tables(spark, folder), source="trino", offset=25, sort="score", arrival="event_id")


@check(
    "feed_page_raw_searched",
    f"""
    SELECT {FEED} FROM {BEST.format(where=SEARCH.format(text="post 2") + " AND subreddit = 'view' AND id <> ''")}
    ORDER BY best.created_utc ASC NULLS FIRST, post_id LIMIT 100
    """,
)
def feed_page_raw_searched(spark, folder):
    return feed.feed_page(
        *tables(spark, folder),
        source="trino",
        limit=100,
        subreddit="view",
        search="Post 2",
        order="asc",
        arrival="event_id",
    )


@check(
    "feed_source_selector",
    f"""
    (SELECT 'postgres' AS source, {FEED} FROM {CLEAN}
     ORDER BY clean.created_utc DESC NULLS LAST, post_id, event_id LIMIT 20)
    UNION ALL
    (SELECT 'trino' AS source, {FEED} FROM {BEST.format(where="id <> ''")}
     ORDER BY best.created_utc DESC, post_id LIMIT 20)
    """,
)
def feed_source_selector(spark, folder):
    """The same request to every source: clean rows as they are, raw rows one per post."""
    pages = [
        feed.feed_page(*tables(spark, folder), source=source, limit=20, arrival="event_id").withColumn("source", F.lit(source))
        for source in feed.SOURCES
    ]
    return feed.union_all(pages)


@check(
    "feed_page_deep",
    f"""
    (SELECT {FEED} FROM {CLEAN} ORDER BY score DESC NULLS LAST, post_id, event_id LIMIT 50 OFFSET 10)
    UNION ALL
    (SELECT {FEED} FROM {CLEAN} ORDER BY score DESC NULLS LAST, post_id, event_id
     LIMIT 50 OFFSET (SELECT count(*) - 70 FROM posts))
    """,
)
def feed_page_deep(spark, folder):
    """One page among the first rows and one near the end of the table, by the same plan."""
    posts, communities = tables(spark, folder)
    offsets = (10, posts.count() - 70)
    pages = [feed.feed_page(posts, communities, limit=50, offset=n, sort="score", arrival="event_id") for n in offsets]
    return pages[0].unionAll(pages[1])


@check(
    "feed_page_deep_raw",
    f"""
    SELECT {FEED} FROM {BEST.format(where="id <> ''")}
    ORDER BY best.created_utc DESC, post_id LIMIT 30 OFFSET (SELECT count(DISTINCT id) - 40 FROM posts)
    """,
)
def feed_page_deep_raw(spark, folder):
    posts, communities = tables(spark, folder)
    offset = posts.select("id").distinct().count() - 40
    return feed.feed_page(posts, communities, source="trino", limit=30, offset=offset, arrival="event_id")


@check(
    "feed_summary",
    f"""
    SELECT count(DISTINCT id) AS total, 25 AS "limit", 50 AS "offset", 'trino' AS source,
           count(*) - count(DISTINCT id) AS duplicate_count,
           CAST(ceil(count(DISTINCT id) / 25) AS BIGINT) AS total_pages,
           CAST(51 AS BIGINT) AS first_shown, least(CAST(75 AS BIGINT), count(DISTINCT id)) AS last_shown
    FROM posts WHERE {SEARCH.format(text="post 1")}
    """,
)
def feed_summary(spark, folder):
    return feed.feed_summary(*tables(spark, folder), source="trino", offset=50, search="POST 1")


@check(
    "feed_summary_clean",
    """
    SELECT count(*) AS total, CAST(ceil(count(*) / 40) AS BIGINT) AS total_pages,
           CAST(1 AS BIGINT) AS first_shown, least(CAST(40 AS BIGINT), count(*)) AS last_shown
    FROM posts WHERE subreddit = 'error'
    """,
)
def feed_summary_clean(spark, folder):
    summary = feed.feed_summary(*tables(spark, folder), limit=40, subreddit="error")
    return summary.select("total", "total_pages", "first_shown", "last_shown")


@check("list_subreddits", "SELECT DISTINCT subreddit FROM posts")
def list_subreddits(spark, folder):
    return feed.list_subreddits(fixtures.posts(spark, folder))


@check(
    "feed_page_of_epochs",
    f"""
    SELECT {FEED} FROM (
      SELECT * REPLACE (date_trunc('second', created_utc) AS created_utc), id AS post_id,
             row_number() OVER (PARTITION BY id ORDER BY coalesce(score, 0) DESC, event_id) AS n
      FROM posts WHERE id <> ''
    ) AS best WHERE n = 1
    ORDER BY best.created_utc DESC, post_id LIMIT 25
    """,
)
def feed_page_of_epochs(spark, folder):
    """A raw table whose times are epoch seconds."""
    raw = fixtures.raw_posts(spark, folder)
    return feed.feed_page(raw, fixtures.COMMUNITIES, source="trino", arrival="event_id")


@check(
    "feed_page_without_arrival",
    f"""
    SELECT {FEED} FROM {CLEAN}
    ORDER BY score DESC NULLS LAST, post_id, title, author, num_comments, clean.created_utc, url, selftext, subreddit
    LIMIT 40 OFFSET 300
    """,
)
def feed_page_without_arrival(spark, folder):
    """Rows without an arrival number: ties are decided by the columns, in their order."""
    return feed.feed_page(*tables(spark, folder), limit=40, offset=300, sort="score")


@check(
    "feed_search_indexed",
    f"SELECT event_id, title, author, subreddit FROM posts WHERE {SEARCH.format(text='post 12')}",
)
def feed_search_indexed(spark, folder):
    """The index is built over all posts and answers the search."""
    posts, path = fixtures.posts(spark, folder), shared_folder(spark, "search")
    search_index.build_index(posts, path, "event_id")
    found = search_index.search_indexed(posts, path, "POST 12", "event_id")
    return found.select("event_id", "title", "author", "subreddit")


@check(
    "feed_cursor_walk",
    f"""
    SELECT {FEED}, CAST((n - 1) // 50 AS INTEGER) AS page FROM (
      SELECT *, row_number() OVER (ORDER BY clean.created_utc DESC NULLS LAST, post_id, event_id) AS n
      FROM {CLEAN} WHERE subreddit = 'error' AND {SEARCH.format(text="post 1")}
    ) AS clean WHERE n <= 300
    """,
)
def feed_cursor_walk(spark, folder):
    """Six pages in a row, each found by the cursor of the last row before it."""
    posts, communities = tables(spark, folder)
    pages, last = [], None
    for number in range(6):
        request = {"arrival": "event_id", "limit": 50, "subreddit": "error", "search": "POST 1"}
        rows = cursor.page_after(posts, communities, last, **request)
        fetched = rows.collect()
        if not fetched:
            break
        last = fetched[-1][cursor.PLACE]
        pages.append(rows.drop(cursor.PLACE).withColumn("page", F.lit(number)))
    return feed.union_all(pages)
