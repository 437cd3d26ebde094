"""Every named query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return str(value)


def as_rows(names, rows):
    order = sorted(range(len(names)), key=lambda at: names[at])
    return sorted(tuple(plain(row[at]) for at in order) for row in rows)


FAMILY = {
    "tinyint": "int", "smallint": "int", "int": "int", "integer": "int", "bigint": "bigint", "double": "double",
    "decimal": "decimal", "string": "text", "varchar": "text", "date": "date", "boolean": "boolean",
    "timestamp_ntz": "timestamp", "timestamp": "timestamp", "hugeint": "hugeint",
}


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, oracle, name):
    df = entry.queries()[name](spark, FOLDER)
    rows = [tuple(row) for row in df.collect()]
    assert rows
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return
    expected = oracle.sql(sql)
    assert sorted(df.columns) == sorted(expected.columns)
    ours = {field.name: FAMILY[field.dataType.simpleString()] for field in df.schema.fields}
    theirs = {n: FAMILY[str(t).lower().split("(")[0]] for n, t in zip(expected.columns, expected.types)}
    assert ours == theirs
    assert as_rows(df.columns, rows) == as_rows(expected.columns, expected.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
