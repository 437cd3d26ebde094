"""Registering tables over data paths and listing what is registered."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def create_schema(spark: SparkSession, database: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{place}")


def register_table(
    spark: SparkSession,
    table: str,
    path: str,
    fmt: str = "parquet",
    schema: StructType | None = None,
    partitions: Sequence[str] = (),
) -> None:
    """An external table over `path`. A partitioned table needs its schema and a repair before it has rows."""
    columns = f" ({schema.toDDL()})" if schema else ""
    layout = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table}{columns} USING {fmt}{layout} LOCATION '{path}'")


def register_communities(
    spark: SparkSession, database: str, paths: dict[str, str], fmt: str = "parquet"
) -> list[str]:
    """One table per name, such as `news_raw` and `news_clean`."""
    create_schema(spark, database)
    for name, path in paths.items():
        register_table(spark, f"`{database}`.`{name}`", path, fmt)
    return list(paths)


def describe_columns(df: DataFrame) -> DataFrame:
    """Name, type and nullability of each column of a frame."""
    rows = [(at, f.name, f.dataType.simpleString(), f.nullable) for at, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string, nullable boolean")


def column_report(df: DataFrame) -> DataFrame:
    """Name, type and number of set values of each column, counted in one pass over the table."""
    counted = df.agg(*[F.count(F.col(f"`{name}`")).alias(name) for name in df.columns])
    rows = [
        F.struct(
            F.lit(f.name).alias("name"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col(f"`{f.name}`").alias("non_null"),
        )
        for f in df.schema.fields
    ]
    return counted.select(F.inline(F.array(*rows)))


def table_columns(spark: SparkSession, table: str) -> DataFrame:
    if not spark.catalog.tableExists(table):
        raise ValueError(f"no table {table}")
    return describe_columns(spark.table(table))


def inventory(spark: SparkSession, database: str) -> DataFrame:
    """Rows and columns of every table of a database; only names and schemas pass through the driver.

    Temporary views are listed with every database and are left out.
    """
    counted = []
    for entry in spark.catalog.listTables(database):
        if entry.isTemporary:
            continue
        table = spark.table(f"`{database}`.`{entry.name}`")
        counted.append(
            table.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(entry.name).alias("table_name"), F.lit(len(table.columns)).alias("column_count"), "row_count"
            )
        )
    empty = spark.createDataFrame([], "table_name string, column_count int, row_count bigint")
    return reduce(DataFrame.unionAll, counted, empty)
