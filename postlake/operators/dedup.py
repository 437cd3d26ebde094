"""Deduplication: one row per key under a full ordering.

Every operator here ranks rows with `row_number() = 1`. Spark keeps one row per key and input partition
before the shuffle, so a key that holds a large share of the table reaches its reducer as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

KEEP_STRATEGIES = ("highest_score", "most_recent")


def keep_best(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key under `order`; null keys form one group."""
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def orderable(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return orderable(kind.elementType)
    if isinstance(kind, StructType):
        return all(orderable(field.dataType) for field in kind)
    return not isinstance(kind, (MapType, VariantType))


def tie_break(df: DataFrame, arrival: str | None = None) -> list[Column]:
    """Arrival order when the table records it, else a hash of the row and then its columns.

    The hash skips nulls, so rows that differ only in where a null stands share it; the columns, null flags included,
    tell them apart.
    """
    if arrival:
        return [F.asc_nulls_last(arrival)]
    columns = [F.asc_nulls_last(field.name) for field in df.schema if orderable(field.dataType)]
    return [F.xxhash64(*df.columns).asc(), *columns]


def has_key(key: str) -> Column:
    return F.col(key).isNotNull() & (F.col(key) != "")


def dedup_title(df: DataFrame, arrival: str | None = None) -> DataFrame:
    """One row per title: the earliest, then the smallest id."""
    order = [F.asc_nulls_last("created_utc"), F.asc_nulls_last("id"), *tie_break(df, arrival)]
    return keep_best(df, ["title"], order)


def dedup_first(df: DataFrame, arrival: str | None = None) -> DataFrame:
    """The first arrival per id."""
    return keep_best(df, ["id"], tie_break(df, arrival))


def dedup_latest(df: DataFrame, arrival: str | None = None) -> DataFrame:
    """The newest row per id, or the first arrival where the table has no `created_utc`."""
    if "created_utc" not in df.columns:
        return dedup_first(df, arrival)
    return keep_best(df, ["id"], [F.desc_nulls_last("created_utc"), *tie_break(df, arrival)])


def preference(strategy: str) -> Column:
    if strategy == "highest_score":
        return F.coalesce(F.col("score"), F.lit(0)).desc()
    if strategy == "most_recent":
        return F.desc_nulls_last("created_utc")
    raise ValueError(f"unknown keep strategy {strategy!r}; use one of {KEEP_STRATEGIES}")


def dedup_posts(
    df: DataFrame, strategy: str = "highest_score", key: str = "post_id", arrival: str | None = None
) -> DataFrame:
    """One row per non-empty key; the first arrival wins ties and a null score counts as 0."""
    order = [preference(strategy), *tie_break(df, arrival)]
    return keep_best(df.filter(has_key(key)), [key], order)


def distinct_keys(key: str) -> Column:
    """How many groups `keep_best` would leave, a null key being one group."""
    null_group = F.coalesce(F.max(F.when(F.col(key).isNull(), 1)), F.lit(0))
    return F.count_distinct(key) + null_group


def dedup_stats(df: DataFrame, table: str = "subreddit", key: str = "id") -> DataFrame:
    """Rows before, after and removed per table, plus a `TOTAL` row summed over the tables."""
    per_table = df.groupBy(table).agg(
        F.count(F.lit(1)).alias("before_count"), distinct_keys(key).alias("after_count")
    )
    summed = per_table.rollup(table).agg(
        F.sum("before_count").alias("before_count"),
        F.sum("after_count").alias("after_count"),
        F.grouping(table).alias("_total"),
    )
    removed = F.col("before_count") - F.col("after_count")
    return summed.select(
        F.when(F.col("_total") == 1, "TOTAL").otherwise(F.col(table)).alias(table),
        "before_count",
        "after_count",
        removed.alias("duplicates_removed"),
        F.round(F.try_divide(removed * 100.0, F.col("before_count")), 2).alias("percent_removed"),
    )
