"""Counts, rollups and top-k reports over post tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from postlake.functions.columns import with_time
from postlake.operators.feed import union_all
from postlake.schema import PARTITION_COLUMNS

TOP_PARTS = 64  # into so many parts a community is cut before its newest posts are chosen


def rows() -> Column:
    return F.count(F.lit(1))


def newest_first(tie: str = "id") -> list[Column]:
    return [F.desc_nulls_last("created_utc"), F.asc_nulls_last(tie)]


def total_count(df: DataFrame) -> DataFrame:
    return df.agg(rows().alias("total"))


def count_by_date(df: DataFrame) -> DataFrame:
    """Posts per day, newest day first."""
    per_day = with_time(df).groupBy(F.to_date("created_utc").alias("date")).agg(rows().alias("post_count"))
    return per_day.orderBy(F.desc_nulls_last("date"))


def count_by_date_subreddit(df: DataFrame, top: int | None = None, largest_first: bool = False) -> DataFrame:
    """Posts per day and community: newest day first, then by community name or by count."""
    day = F.to_date("created_utc").alias("post_date")
    counted = with_time(df).groupBy(day, "subreddit").agg(rows().alias("post_count"))
    by_count = [F.desc("post_count")] if largest_first else []
    ordered = counted.orderBy(F.desc_nulls_last("post_date"), *by_count, F.asc_nulls_last("subreddit"))
    return ordered.limit(top) if top else ordered


def top_authors_by_score(df: DataFrame, top: int = 25) -> DataFrame:
    rolled = df.groupBy("author").agg(
        rows().alias("post_count"), F.sum("score").alias("total_score"), F.avg("score").alias("avg_score")
    )
    return rolled.orderBy(F.desc_nulls_last("total_score"), F.asc_nulls_last("author")).limit(top)


def top_authors_by_count(df: DataFrame, top: int = 20) -> DataFrame:
    counted = df.groupBy("author").agg(rows().alias("post_count"))
    return counted.orderBy(F.desc("post_count"), F.asc_nulls_last("author")).limit(top)


def time_range(df: DataFrame, column: str = "created_utc") -> DataFrame:
    return df.agg(F.min(column).alias("oldest"), F.max(column).alias("newest"), rows().alias("total"))


def non_null_range(df: DataFrame, column: str) -> DataFrame:
    """Oldest, newest and count of the rows where `column` is set."""
    return time_range(df.filter(F.col(column).isNotNull()), column)


def summary_by_subreddit(df: DataFrame) -> DataFrame:
    return df.groupBy("subreddit").agg(
        rows().alias("records"), F.avg("score").alias("avg_score"), F.avg("num_comments").alias("avg_comments")
    )


def raw_vs_clean(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Row counts of both tables and their difference, in one aggregation over tagged rows."""
    tagged = raw.select(F.lit(1).alias("raw"), F.lit(0).alias("clean")).unionAll(
        clean.select(F.lit(0).alias("raw"), F.lit(1).alias("clean"))
    )
    counted = tagged.agg(
        F.coalesce(F.sum("raw"), F.lit(0)).alias("raw_count"),
        F.coalesce(F.sum("clean"), F.lit(0)).alias("clean_count"),
    )
    return counted.withColumn("filtered_count", F.col("raw_count") - F.col("clean_count"))


def count_per_table(tables: dict[str, DataFrame], tag: str = "subreddit") -> DataFrame:
    """One row per table, empty tables included."""
    return union_all(
        [table.agg(rows().alias("posts")).select(F.lit(name).alias(tag), "posts") for name, table in tables.items()]
    )


def most_recent(df: DataFrame, columns: Sequence[str], top: int = 10, tie: str = "id") -> DataFrame:
    return df.orderBy(*newest_first(tie)).limit(top).select(*columns)


def oldest_posts(df: DataFrame, columns: Sequence[str], top: int = 10, tie: str = "id") -> DataFrame:
    return df.orderBy(F.asc_nulls_last("created_utc"), F.asc_nulls_last(tie)).limit(top).select(*columns)


def newest_post(df: DataFrame, columns: Sequence[str], tie: str = "id") -> DataFrame:
    return most_recent(df, columns, 1, tie)


def top_scoring(df: DataFrame, columns: Sequence[str], top: int = 10, tie: str = "id") -> DataFrame:
    return df.orderBy(F.desc_nulls_last("score"), F.asc_nulls_last(tie)).limit(top).select(*columns)


def latest_retrieved(df: DataFrame, columns: Sequence[str], top: int = 15, tie: str = "post_id") -> DataFrame:
    return df.orderBy(F.desc_nulls_last("retrieved_at"), F.asc_nulls_last(tie)).limit(top).select(*columns)


def high_engagement_recent(
    df: DataFrame, columns: Sequence[str], above: int = 100, top: int = 20, tie: str = "id"
) -> DataFrame:
    """The newest posts whose score is above a threshold."""
    return most_recent(df.filter(F.col("score") > above), columns, top, tie)


def last_hours(df: DataFrame, now: Column | None = None, hours: int = 24) -> DataFrame:
    """Posts created in the hours before `now`, highest score first; a clean table is read from that day on."""
    since = (F.current_timestamp() if now is None else now) - F.expr(f"INTERVAL {int(hours)} HOURS")
    if isinstance(df.schema["created_utc"].dataType, NumericType):
        # In the stored type and a second early, which a scan can skip files by; the exact filter follows.
        df = df.filter(F.col("created_utc") > F.unix_micros(since.cast("timestamp")) / 1_000_000 - 1)
    recent = with_time(df).filter(F.col("created_utc") > since)
    if set(PARTITION_COLUMNS) <= set(df.columns):
        recent = recent.filter(F.make_date("year", "month", "day") >= F.to_date(since))
    return recent.orderBy(F.desc_nulls_last("score"), F.asc_nulls_last("created_utc"))


def recent_per_subreddit(df: DataFrame, top: int, tie: str = "id") -> DataFrame:
    """The newest posts of every community, in two steps: first the newest of each of its parts, then of them all.

    The parts are hashes of the tie-break, so no task orders more of a community than a part and the parts' newest.
    """
    order = newest_first(tie)
    part = F.pmod(F.xxhash64(tie), F.lit(TOP_PARTS))
    parted = Window.partitionBy("subreddit", "_part").orderBy(*order)
    newest = df.withColumn("_part", part).withColumn("_place", F.row_number().over(parted)).filter(F.col("_place") <= top)
    whole = Window.partitionBy("subreddit").orderBy(*order)
    ranked = newest.drop("_part", "_place").withColumn("rank", F.row_number().over(whole))
    return ranked.filter(F.col("rank") <= top)


def preview(df: DataFrame, order: Sequence[Column | str], count: int) -> DataFrame:
    return df.orderBy(*order).limit(count)


def in_date_range(df: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Rows of a table partitioned by year, month and day, reading only the partitions of the range."""

    def number(day: dt.date) -> int:
        return day.year * 10_000 + day.month * 100 + day.day

    partition = F.col("year") * 10_000 + F.col("month") * 100 + F.col("day")
    return df.filter(F.col("year").between(first.year, last.year) & partition.between(number(first), number(last)))


def view_report(df: DataFrame, view: str, sql: str) -> DataFrame:
    """Register `df` as a temporary view and run a SQL report that names it."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(sql)
