"""Raw posts to the clean table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from postlake.functions.columns import date_parts, epoch_to_timestamp, with_optional
from postlake.operators.dedup import dedup_title
from postlake.operators.maintenance import replace_table
from postlake.schema import CLEAN_SCHEMA, EPOCH_COLUMNS, PARTITION_COLUMNS
from postlake.sources.messages import edited_flag


def with_timestamps(raw: DataFrame) -> DataFrame:
    """Epoch columns as timestamps; absent ones become null timestamps."""
    full = with_optional(raw, dict.fromkeys(EPOCH_COLUMNS, "double"))
    return full.withColumns({name: epoch_to_timestamp(F.col(name)) for name in EPOCH_COLUMNS})


def with_date_parts(posts: DataFrame) -> DataFrame:
    return posts.withColumn("date", F.to_date("created_utc")).withColumns(date_parts(F.col("date")))


def curate(raw: DataFrame, arrival: str | None = None) -> DataFrame:
    """Timestamps, date parts and one row per title. Titles are compared before the casts, on narrow types."""
    return with_date_parts(with_timestamps(dedup_title(raw, arrival)))


def clean_columns(curated: DataFrame) -> DataFrame:
    """Exactly the columns and types of the clean table: what ingest adds is left out, what is missing is null, and
    `edited` is a flag."""
    known = {name.lower(): name for name in curated.columns}
    columns = []
    for field in CLEAN_SCHEMA:
        own = F.col(known[field.name.lower()]) if field.name.lower() in known else F.lit(None)
        if field.name == "edited" and known.get("edited") and curated.schema[known["edited"]].dataType == StringType():
            own = edited_flag(own)
        columns.append(own.cast(field.dataType).alias(field.name))
    return curated.select(*columns)


def new_titles(curated: DataFrame, clean: DataFrame) -> DataFrame:
    """Curated rows whose title the clean table does not hold; a null title counts as one title."""
    known = clean.select(F.col("title").alias("_title"))
    return curated.join(known, F.col("title").eqNullSafe(F.col("_title")), "left_anti")


def curate_batch(raw: DataFrame, clean: DataFrame, arrival: str | None = None) -> DataFrame:
    """What a batch of raw posts adds to the clean table, without reading earlier raw posts again."""
    return new_titles(curate(raw, arrival), clean)


def write_partitioned(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", **options) -> None:
    """Write by day: `overwrite` replaces the table, `replace_days` the days present in `df`, `append` adds rows.

    Plain files are staged and swapped in on `overwrite`, so readers and failed runs keep the last table. The rebalance puts one day in few files and lets Spark split a day that is larger than a partition.
    """
    rows = df.hint("rebalance", *PARTITION_COLUMNS)
    if mode == "overwrite":
        replace_table(rows, path, fmt, PARTITION_COLUMNS, **options)
        return
    writer = rows.write.format(fmt).options(**options)
    if mode == "replace_days":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer = writer.mode("append" if mode == "append" else "overwrite")
    writer.partitionBy(*PARTITION_COLUMNS).save(path)
