"""Reading tables by path, over JDBC, and many at once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from postlake.operators.feed import tagged_union
from postlake.schema import POST_SCHEMA


# Fixed value: conditions by which Spark and table formats say that there is no table.
ABSENT = (
    "PATH_NOT_FOUND",
    "UNABLE_TO_INFER_SCHEMA",
    "TABLE_OR_VIEW_NOT_FOUND",
    "DELTA_TABLE_NOT_FOUND",
    "DELTA_MISSING_DELTA_TABLE",
    "DELTA_PATH_DOES_NOT_EXIST",
)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    return spark.read.format(fmt).options(**options).load(path)


def read_if_present(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame | None:
    """The table, or None when it does not exist or its folder holds no data file. Every other error is raised."""
    try:
        return read_table(spark, path, fmt, **options)
    except AnalysisException as error:
        if error.getCondition() in ABSENT:
            return None
        raise


def load_present(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> dict[str, DataFrame]:
    """The tables that exist, by name."""
    found = {name: read_if_present(spark, path, fmt) for name, path in paths.items()}
    return {name: table for name, table in found.items() if table is not None}


def load_union(
    spark: SparkSession,
    paths: dict[str, str],
    fmt: str = "parquet",
    shape: Callable[[str, DataFrame], DataFrame] = lambda name, table: table,
) -> DataFrame:
    """Tagged union of the tables that exist; an empty frame of posts when none does."""
    tables = {name: shape(name, table) for name, table in load_present(spark, paths, fmt).items()}
    return tagged_union(tables) if tables else spark.createDataFrame([], POST_SCHEMA)


def jdbc_options(
    url: str, driver: str, user: str | None = None, password: str | None = None, **options: str
) -> dict[str, str]:
    """Connection options; every connection value is the caller's.

    An overwrite empties the table and keeps its definition, and writers share few connections.
    """
    login = {name: value for name, value in {"user": user, "password": password}.items() if value is not None}
    defaults = {"truncate": "true", "batchsize": "10000", "numPartitions": "16"}
    return {"url": url, "driver": driver} | login | defaults | options


def read_jdbc(
    spark: SparkSession, table: str, connection: dict[str, str], predicates: Sequence[str] | None = None
) -> DataFrame:
    """A database table. With `predicates` each condition is one parallel read; they must not overlap."""
    if predicates:
        properties = {k: v for k, v in connection.items() if k != "url"}
        return spark.read.jdbc(connection["url"], table, predicates=list(predicates), properties=properties)
    return spark.read.format("jdbc").options(**connection, dbtable=table).load()


def distinct_keys_query(table: str, key: str) -> str:
    """A table expression by which the database itself returns each key once."""
    return f"(SELECT DISTINCT {key} FROM {table} WHERE {key} IS NOT NULL) known_keys"


def read_jdbc_keys(
    spark: SparkSession, table: str, key: str, connection: dict[str, str], predicates: Sequence[str] | None = None
) -> DataFrame:
    """The distinct keys of a database table, made distinct there. `predicates` are conditions on the key."""
    return read_jdbc(spark, distinct_keys_query(table, key), connection, predicates)


def jdbc_bounds(spark: SparkSession, table: str, column: str, connection: dict[str, str]) -> tuple[str, str] | None:
    """The smallest and the largest value of a column, asked of the database; None if there is none."""
    row = read_jdbc(spark, f"(SELECT MIN({column}) AS low, MAX({column}) AS high FROM {table}) bounds", connection).first()
    return None if row is None or row["low"] is None else (str(row["low"]), str(row["high"]))


def read_jdbc_split(spark: SparkSession, table: str, connection: dict[str, str], column: str, parts: int = 16) -> DataFrame:
    """A database table read in `parts` ranges of a number, date or timestamp column, between the table's own bounds."""
    bounds = jdbc_bounds(spark, table, column, connection)
    if bounds is None:
        return read_jdbc(spark, table, connection)
    low, high = bounds
    ranges = {"partitionColumn": column, "lowerBound": low, "upperBound": high, "numPartitions": str(parts)}
    return spark.read.format("jdbc").options(**connection | ranges, dbtable=table).load()
