"""The feed by cursor: a page starts after the last row of the page before, so every page costs as much as the first.

A cursor names sort column, direction and the place of a row in the feed's order: sort value, post id, arrival. Its
predicate bounds the sort column from one side, which prunes the scan, and only the rows of one page are ordered and kept per
task. Rows that come in meanwhile move no page boundary, unlike with offsets.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from postlake.functions.columns import iso_timestamp
from postlake.operators.feed import (
    DEFAULT_LIMIT,
    DEFAULT_SORT,
    SORT_COLUMNS,
    check_request,
    feed_order,
    matching_posts,
    stored_bound,
)
from postlake.schema import FEED_COLUMNS

PLACE = "_cursor"


def place_columns(sort: str, arrival: str) -> list[Column]:
    """Sort value, post id and arrival as text, null where they are null."""
    value = F.unix_micros(F.col(sort).cast("timestamp")) if sort == "created_utc" else F.col(sort)
    return [value.cast("string").alias("value"), F.col("post_id").alias("post_id"), F.col(arrival).cast("string").alias("arrival")]


def sort_name(sort: str) -> str:
    return sort if sort in SORT_COLUMNS else DEFAULT_SORT


def read_cursor(cursor: str, sort: str, order: str) -> dict:
    """The place that a cursor names; one of another feed is refused."""
    try:
        place = json.loads(cursor)
        found = place["sort"], place["order"]
        place["value"], place["post_id"], place["arrival"]
    except (ValueError, TypeError, KeyError) as error:
        raise ValueError("not a cursor of this feed") from error
    if found != (sort, order):
        raise ValueError(f"the cursor belongs to a feed sorted by {found[0]} {found[1]}")
    return place


def behind(place: dict, sort: str, order: str, rows: DataFrame, arrival: str) -> Column:
    """Rows that follow the place: numbers and times in their direction, then ids, then arrivals; nulls last."""

    def beyond(name: str, value: Column | None, descending: bool, tail: Column) -> Column:
        own = F.col(name)
        if value is None:
            return own.isNull() & tail
        further = own < value if descending else own > value
        return further | own.isNull() | ((own == value) & tail)

    def literal(name: str, text: str | None) -> Column | None:
        kind = rows.schema[name].dataType
        if text is None:
            return None
        if name == "created_utc":
            return F.timestamp_micros(F.lit(int(text))).cast(kind)
        return F.lit(text).cast(kind)

    tail = beyond(arrival, literal(arrival, place["arrival"]), False, F.lit(False))
    tail = beyond("post_id", literal("post_id", place["post_id"]), False, tail)
    return beyond(sort, literal(sort, place["value"]), order == "desc", tail)


def stored_side(place: dict, sort: str, order: str, posts: DataFrame) -> Column:
    """A bound on the sort column as it is stored, a little wide, which the scan can be pruned by."""
    if place["value"] is None:
        return F.col(sort).isNull()
    kind, margin = posts.schema[sort].dataType, 1 if order == "desc" else -1
    if sort == "created_utc":
        bound = stored_bound(F.timestamp_micros(F.lit(int(place["value"]))), kind, margin).cast(kind)
    else:
        bound = F.lit(place["value"]).cast(kind)
    return F.col(sort).isNull() | (F.col(sort) <= bound if order == "desc" else F.col(sort) >= bound)


def page_after(
    posts: DataFrame,
    subreddits: Sequence[str],
    cursor: str | None = None,
    *,
    arrival: str,
    limit: int = DEFAULT_LIMIT,
    subreddit: str | None = None,
    search: str | None = None,
    sort: str = DEFAULT_SORT,
    order: str = "desc",
) -> DataFrame:
    """The feed columns of the rows after `cursor` (of the first page without one), and the cursor of each row.

    `posts` are clean rows; `arrival` names a column of theirs without nulls, unique within a post id.
    """
    check_request("postgres", limit, 0)
    name, direction = sort_name(sort), "desc" if order.lower() == "desc" else "asc"
    place = read_cursor(cursor, name, direction) if cursor else None
    if place:
        posts = posts.filter(stored_side(place, name, direction, posts))
    rows = matching_posts(posts, subreddits, subreddit, search, arrival=arrival)
    if place:
        rows = rows.filter(behind(place, name, direction, rows, arrival))
    ordered = rows.orderBy(*feed_order(name, direction, False), F.asc_nulls_last(arrival)).limit(limit)
    described = F.struct(F.lit(name).alias("sort"), F.lit(direction).alias("order"), *place_columns(name, arrival))
    shown = [iso_timestamp(F.col(c)).alias(c) if c == "created_utc" else F.col(c) for c in FEED_COLUMNS]
    return ordered.select(*shown, F.to_json(described, {"ignoreNullFields": "false"}).alias(PLACE))


def walk(posts: DataFrame, subreddits: Sequence[str], **request) -> Iterator[list[Row]]:
    """Page after page, each of at most `limit` rows, until none is left."""
    cursor = None
    while True:
        rows = page_after(posts, subreddits, cursor, **request).collect()
        if not rows:
            return
        yield rows
        cursor = rows[-1][PLACE]
