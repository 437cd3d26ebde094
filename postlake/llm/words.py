"""The word definition and small helpers that several operators share."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: words are runs of anything but a space and the characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
ARROW_ROWS_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
ARROW_ROWS = 512
word_pattern = re.compile(WORD)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def portions(column: pa.Array, most_chars: int, rows: int = 64) -> Iterator[list[str | None]]:
    """The texts of an Arrow column in order, taken together up to a number of characters, at least one at a time."""
    portion, chars = [], 0
    for start in range(0, len(column), rows):
        for text in column.slice(start, rows).to_pylist():
            portion.append(text)
            chars += len(text or "")
            if chars >= most_chars:
                yield portion
                portion, chars = [], 0
    if portion:
        yield portion


def map_batches(rows: DataFrame, run: Callable, schema) -> DataFrame:
    """`mapInArrow` with few rows in a batch, since texts may be long: a task holds a batch several times over.

    Spark reads the number from the session when the frame runs, so it is lowered there and stays so.
    """
    conf = rows.sparkSession.conf
    if int(conf.get(ARROW_ROWS_SETTING)) > ARROW_ROWS:
        conf.set(ARROW_ROWS_SETTING, ARROW_ROWS)
    return rows.mapInArrow(run, schema)


def split_words(text: str | None) -> list[str]:
    return word_pattern.findall(text) if text else []


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold_of(doc_id: Column, folds: int = 5) -> Column:
    """The cross-validation fold of a document: crc32 of its id as text, modulo `folds`; null ids fall in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0)).cast("int")
