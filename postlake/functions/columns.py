"""Column expressions shared by batch and streaming frames."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from postlake.schema import HOME_SITE, TOPIC_PREFIX


def epoch_to_timestamp(epoch: Column) -> Column:
    return F.timestamp_seconds(epoch)


def with_time(df: DataFrame, name: str = "created_utc") -> DataFrame:
    """`name` as a timestamp: raw tables hold epoch seconds, clean tables already hold timestamps."""
    if isinstance(df.schema[name].dataType, NumericType):
        return df.withColumn(name, epoch_to_timestamp(F.col(name)))
    return df


def date_parts(day: Column) -> dict[str, Column]:
    return {"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)}


def table_name(label: Column) -> Column:
    """A community label as a table name: lower case, spaces to underscores."""
    return F.replace(F.lower(label), F.lit(" "), F.lit("_"))


def table_name_of(label: str) -> str:
    return label.lower().replace(" ", "_")


def topic_name(label: Column) -> Column:
    return F.concat(F.lit(TOPIC_PREFIX), label)


def label_of_topic(topic: Column) -> Column:
    return F.substring(topic, len(TOPIC_PREFIX) + 1, 2**31 - 1)


def iso_timestamp(moment: Column) -> Column:
    """ISO-8601 text; microseconds appear only when they are not zero."""
    seconds = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(moment, ".SSSSSS")
    return F.concat(seconds, F.when(fraction == ".000000", "").otherwise(fraction))


def relative_age(moment: Column, now: Column) -> Column:
    """`12s ago`, `5m ago`, `3h ago`, `2d ago`, rounding down at each step."""
    millis = F.unix_millis(now.cast("timestamp")) - F.unix_millis(moment.cast("timestamp"))
    seconds = F.floor(millis / 1000)
    minutes = F.floor(seconds / 60)
    hours = F.floor(minutes / 60)
    days = F.floor(hours / 24)
    return (
        F.when(seconds < 60, F.concat(seconds.cast("string"), F.lit("s ago")))
        .when(minutes < 60, F.concat(minutes.cast("string"), F.lit("m ago")))
        .when(hours < 24, F.concat(hours.cast("string"), F.lit("h ago")))
        .otherwise(F.concat(days.cast("string"), F.lit("d ago")))
    )


def is_outbound_link(url: Column, site: str = HOME_SITE) -> Column:
    return F.coalesce((url != "") & ~url.contains(site), F.lit(False))


def truncate_text(text: Column, length: int) -> Column:
    return F.substring(text, 1, length)


def matches_search(text: str, *columns: str, wildcards: bool = False) -> Column:
    """Case-insensitive substring on any column; `%` and `_` are literal unless `wildcards` is set."""
    found = F.lit(False)
    for name in columns:
        value = F.lower(F.col(name))
        hit = F.like(value, F.lower(F.lit(f"%{text}%"))) if wildcards else F.contains(value, F.lower(F.lit(text)))
        found = found | hit
    return found


def encode_json(columns: Iterable[str | Column]) -> Column:
    """A row as UTF-8 JSON bytes, nulls included."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).cast("binary")


def select_available(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The named columns that the frame has, in the named order."""
    return df.select(*[name for name in names if name in df.columns])


def with_optional(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Add each named column that is absent as a typed null."""
    absent = {name: F.lit(None).cast(kind) for name, kind in types.items() if name not in df.columns}
    return df.withColumns(absent) if absent else df
