"""Counts and distinct counts that are kept next to a table and need no rescan.

Counts: every batch adds its rows per day and community; a rewrite that removes rows adds what it removed with a minus
sign. Entries are never changed, so a report is the sum of a few narrow rows, and a batch that is replayed overwrites its
own entry. Distinct counts: a sketch per day and community is stored, and sketches of any range of days are united.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.functions.columns import with_time

GROUPS = ("post_date", "subreddit")
ENTRY = "entry"
LG_CONFIG = 12  # base-2 logarithm of a sketch's size
ERROR_BOUND = 3 * 1.04 / 2 ** (LG_CONFIG / 2)  # three standard errors, as a share of the exact count


def by_day(posts: DataFrame) -> DataFrame:
    """`posts` with the day of their time, as a table's date partitions have it."""
    return with_time(posts).withColumn("post_date", F.to_date("created_utc"))


def counted(posts: DataFrame, sign: int = 1) -> DataFrame:
    return by_day(posts).groupBy(*GROUPS).agg((F.count(F.lit(1)) * sign).alias("post_count"))


def add_counts(posts: DataFrame, path: str, entry: str) -> None:
    """Add the rows of a batch under a name of its own, which a replay overwrites."""
    counted(posts).write.mode("overwrite").parquet(f"{path}/{ENTRY}={entry}")


def retract_counts(before: DataFrame, after: DataFrame, path: str, entry: str) -> None:
    """Take back what a rewrite has removed: the difference of both tables per group. Groups without change add nothing."""
    both = counted(after).unionByName(counted(before, -1))
    change = both.groupBy(*GROUPS).agg(F.sum("post_count").alias("post_count")).filter("post_count <> 0")
    change.write.mode("overwrite").parquet(f"{path}/{ENTRY}={entry}")


def kept_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows per day and community as all entries tell; groups that have become empty are left out."""
    entries = spark.read.parquet(path)
    return entries.groupBy(*GROUPS).agg(F.sum("post_count").alias("post_count")).filter("post_count <> 0")


def compact_counts(spark: SparkSession, path: str, target: str) -> None:
    """All entries as a single one in a new folder."""
    kept_counts(spark, path).write.parquet(f"{target}/{ENTRY}=compacted")


def sketches(posts: DataFrame, *columns: str, lg_config: int = LG_CONFIG) -> DataFrame:
    """One row per day and community with a sketch of the distinct values of each column; a group without values has none."""
    grouped = by_day(posts).groupBy(*GROUPS)
    return grouped.agg(*[F.hll_sketch_agg(name, lg_config).alias(f"{name}_sketch") for name in columns])


def distinct_estimate(sketch: str) -> Column:
    """The number of distinct values in the union of a group's sketches."""
    return F.hll_sketch_estimate(F.hll_union_agg(sketch))


def distinct_in_range(stored: DataFrame, first: str, last: str, *columns: str, per: Sequence[str] = ()) -> DataFrame:
    """Estimated distinct values of each column over the days `first` to `last`, per community if asked."""
    chosen = stored.filter(F.col("post_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return chosen.groupBy(*per).agg(*[distinct_estimate(f"{name}_sketch").alias(f"{name}_estimate") for name in columns])
