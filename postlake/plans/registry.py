"""Named checks: a Spark query over the test tables next to the SQL that must return the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The post view of `fixtures.event_posts` in the oracle's dialect.
POSTS = """
posts AS (
  SELECT event_id,
         CAST(event_id // 4 AS VARCHAR) AS id,
         event_type AS subreddit,
         'Post ' || CAST(event_id // 11 AS VARCHAR) AS title,
         CAST(user_id AS VARCHAR) AS author,
         CAST(FLOOR(value) AS INTEGER) AS score,
         CAST(json_extract(props, '$.k') AS INTEGER) AS num_comments,
         ts AS created_utc,
         'https://' || event_type || '.example.org/' || CAST(event_id AS VARCHAR) AS url,
         props AS selftext
  FROM events
)"""


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its oracle when SQL can express it. `posts` is defined for the oracle."""

    def register(query: Query) -> Query:
        @wraps(query)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return query(spark, folder)

        QUERIES[name] = run
        if sql:
            text = sql.strip()
            joined = text.replace("WITH", ",", 1) if text.startswith("WITH") else text
            ORACLES[name] = f"WITH {POSTS.strip()} {joined}" if "posts" in text else text
        return run

    return register


def plain_time(*names: str) -> dict[str, Column]:
    """Timestamps without zone, the type the oracle returns."""
    return {name: F.col(name).cast("timestamp_ntz") for name in names}
