"""Joins against already known keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_ids(existing: DataFrame, key: str = "post_id") -> DataFrame:
    """Known keys, once each."""
    return existing.select(key).filter(F.col(key).isNotNull()).distinct()


def join_keys(existing: DataFrame, key: str) -> DataFrame:
    """Known keys, once each, ready to be joined against rows in which a key may be very frequent.

    Adaptive execution splits a skewed join only where both inputs are shuffled for that join. Making the
    keys distinct together with their hash leaves that shuffle to the join; it moves narrow rows only.
    """
    known = existing.select(key, F.xxhash64(key).alias("_hash")).filter(F.col(key).isNotNull())
    return known.distinct().select(key)


def skip_existing(new: DataFrame, existing: DataFrame, key: str = "post_id") -> DataFrame:
    """Rows whose key is not known yet; null keys cannot be checked and are left out."""
    return new.filter(F.col(key).isNotNull()).join(join_keys(existing, key), key, "left_anti")


def keep_existing(new: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among the known ones."""
    return new.filter(F.col(key).isNotNull()).join(join_keys(existing, key), key, "left_semi")


def reconcile_keys(raw: DataFrame, clean: DataFrame, key: str) -> DataFrame:
    """Rows per key on both sides. Each side is counted before the shuffle, so no join can skew."""
    sides = raw.select(key, F.lit(1).alias("in_raw"), F.lit(0).alias("in_clean")).unionAll(
        clean.select(key, F.lit(0).alias("in_raw"), F.lit(1).alias("in_clean"))
    )
    counted = sides.groupBy(key).agg(F.sum("in_raw").alias("raw_rows"), F.sum("in_clean").alias("clean_rows"))
    status = (
        F.when(F.col("clean_rows") == 0, "raw only").when(F.col("raw_rows") == 0, "clean only").otherwise("both")
    )
    return counted.withColumn("status", status)
