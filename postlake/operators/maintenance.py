"""Table upkeep: replacing, staged rewrite, vacuum, manifest, partition discovery, sizes."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.operators.dedup import dedup_latest, distinct_keys
from postlake.schema import ARRIVAL_COLUMN, BATCH_COLUMN, PARTITION_COLUMNS, RUN_COLUMN

RETENTION_HOURS = 168

# Fixed value: formats that are plain files; a table format commits through its own log.
FILE_FORMATS = ("parquet", "orc", "json", "csv", "text", "avro")


def commits_by_itself(fmt: str) -> bool:
    return fmt not in FILE_FORMATS


def append_rows(df: DataFrame, path: str, fmt: str = "parquet", **options: str) -> None:
    """Append, creating the table when it is absent. An unreadable table is an error, never replaced."""
    df.write.format(fmt).options(**options).mode("append").save(path)


def folder_access(spark: SparkSession, path: str):
    """The Hadoop path and the file system that holds it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def staging_path(path: str) -> str:
    return f"{path.rstrip('/')}__staged_{uuid.uuid4().hex}"


def swap_folder(spark: SparkSession, staged: str, path: str) -> str | None:
    """Put the staged table in place of `path` and return where the old one was moved, if there was one.

    Both copies exist until the caller drops the old one; if the driver is lost between the two moves, they lie
    next to `path` under `__staged_` and `__replaced_` names.
    """
    source, files = folder_access(spark, staged)
    target, _ = folder_access(spark, path)
    old, _ = folder_access(spark, f"{path.rstrip('/')}__replaced_{uuid.uuid4().hex}")
    replaced = files.exists(target)
    if replaced and not files.rename(target, old):
        raise OSError(f"could not move {path} aside; the new table is at {staged}")
    if not files.rename(source, target):
        raise OSError(f"could not move {staged} to {path}; the old table is at {old.toString()}")
    return old.toString() if replaced else None


def drop_folder(spark: SparkSession, path: str | None) -> None:
    if path:
        place, files = folder_access(spark, path)
        files.delete(place, True)


def replace_table(
    df: DataFrame, path: str, fmt: str = "parquet", partitions: Sequence[str] = (), **options: str
) -> None:
    """Put `df` in place of the table at `path`. A failed write leaves the old table as it was.

    Plain files are written next to the table and swapped in; a table format overwrites in one commit of its log.
    """
    spark = df.sparkSession
    staged = path if commits_by_itself(fmt) else staging_path(path)
    writer = df.write.format(fmt).options(**options).mode("overwrite")
    writer = writer.partitionBy(*partitions) if partitions else writer
    try:
        writer.save(staged)
    except Exception:
        if staged != path:
            drop_folder(spark, staged)
        raise
    if staged != path:
        drop_folder(spark, swap_folder(spark, staged, path))


def rewrite_deduplicated(
    spark: SparkSession, path: str, fmt: str = "parquet", dry_run: bool = False, arrival: str | None = None
) -> dict:
    """Replace a raw table by its newest row per id, checking the staged copy before the swap.

    The table is never overwritten while it is read, and its stream has to be stopped meanwhile. The old files
    stay next to the table, and their place is returned, until the caller removes them. Folders per
    micro-batch are kept, so that the stream can go on. A table with a sink log cannot be rewritten this way:
    readers would follow the log to files that are gone.
    """
    log, files = folder_access(spark, f"{path.rstrip('/')}/_spark_metadata")
    if files.exists(log):
        raise ValueError(f"{path} is managed by a file sink; ingest it with batch_writer or a table format")
    raw = spark.read.format(fmt).load(path)
    if "id" not in raw.columns:
        raise ValueError(f"{path} has no id column")
    counts = raw.agg(F.count(F.lit(1)).alias("before"), distinct_keys("id").alias("after")).collect()[0]
    before, after = counts["before"], counts["after"]
    stats = {"before": before, "after": after, "removed": before - after, "replaced": None}
    if dry_run or after == before:
        return stats
    arrival = arrival or (ARRIVAL_COLUMN if ARRIVAL_COLUMN in raw.columns else None)
    latest = dedup_latest(raw, arrival)
    folders = [name for name in (RUN_COLUMN, BATCH_COLUMN) if name in raw.columns]
    if commits_by_itself(fmt):
        latest.write.format(fmt).mode("overwrite").save(path)
        return stats
    staged = staging_path(path)
    writer = (latest.hint("rebalance", *folders) if folders else latest).write.format(fmt)
    (writer.partitionBy(*folders) if folders else writer).save(staged)
    written = spark.read.format(fmt).load(staged).count()
    if written != after:
        raise RuntimeError(f"staged table {staged} holds {written} rows instead of {after}")
    return stats | {"replaced": swap_folder(spark, staged, path)}


def vacuum_statement(table: str, fmt: str, hours: int = RETENTION_HOURS) -> str | None:
    """VACUUM for table formats that keep old versions; plain files have none to remove."""
    return f"VACUUM {table} RETAIN {hours} HOURS" if fmt == "delta" else None


def vacuum(spark: SparkSession, table: str, fmt: str, hours: int = RETENTION_HOURS) -> None:
    statement = vacuum_statement(table, fmt, hours)
    if statement:
        spark.sql(statement)


def listed_files(spark: SparkSession, path: str) -> DataFrame:
    """file_path and bytes of every data file under a folder, from the listing alone; empty files included."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.col("path").alias("file_path"), F.col("length").alias("bytes"))


def live_files(spark: SparkSession, path: str, partitions: Sequence[str] = PARTITION_COLUMNS) -> DataFrame:
    """Each data file of a partitioned table with its partition values, read from the file's path."""
    values = [F.regexp_extract("file_path", f"/{name}=([^/]*)/", 1).cast("int").alias(name) for name in partitions]
    return listed_files(spark, path).select("file_path", *values)


def write_manifest(
    spark: SparkSession, table_path: str, path: str, partitions: Sequence[str] = PARTITION_COLUMNS
) -> None:
    """One text folder per partition listing its files."""
    files = live_files(spark, table_path, partitions)
    files.repartition(*partitions).write.mode("overwrite").partitionBy(*partitions).text(path)


def file_sizes(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Files and bytes per table, largest first; a table without files counts 0."""
    listed = [
        listed_files(spark, path)
        .agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))
        .select(F.lit(name).alias("table"), "files", "bytes")
        for name, path in paths.items()
    ]
    return reduce(DataFrame.unionAll, listed).orderBy(F.desc("bytes"), "table")


def repair_partitions(spark: SparkSession, table: str) -> DataFrame:
    """Make the catalog see partitions that were written straight to the table's folder."""
    spark.sql(f"MSCK REPAIR TABLE {table}")
    return spark.table(table)
