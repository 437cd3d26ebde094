"""The post feed: union of community tables, filter, deduplicate, count, sort and page."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType

from postlake.functions.columns import iso_timestamp, matches_search, with_time
from postlake.operators.dedup import dedup_posts, has_key
from postlake.operators.paging import page
from postlake.schema import FEED_COLUMNS
from postlake.session import checkpointed

# Source ids, sortable columns, page bounds and defaults of the feed interface.
# `postgres` stands for clean tables, `trino` for raw ones.
SOURCES = ("postgres", "trino")
SORT_COLUMNS = ("created_utc", "score", "num_comments")
DEFAULT_SORT = "created_utc"
DEFAULT_LIMIT, MAX_LIMIT = 25, 100
ID_PREFIXES = (3, 6, 12, 24)  # characters by which ids of one sort value are told apart, as far as there are too many to order


def union_all(tables: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name; a column that one table lacks is null there."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), tables)


def tagged_union(tables: dict[str, DataFrame]) -> DataFrame:
    """UNION ALL of per-community tables with the community name as `subreddit`."""
    return union_all([table.withColumn("subreddit", F.lit(tag)) for tag, table in tables.items()])


def feed_rows(posts: DataFrame, arrival: str | None = None) -> DataFrame:
    """The nine feed columns, `id` renamed and the time a timestamp, plus the arrival column if there is one."""
    renamed = posts if "post_id" in posts.columns else posts.withColumnRenamed("id", "post_id")
    return with_time(renamed.select(*dict.fromkeys([*FEED_COLUMNS, *([arrival] if arrival else [])])))


def filter_subreddit(posts: DataFrame, subreddit: str | None, subreddits: Sequence[str]) -> DataFrame:
    """Keep one community; a name that is not on the list is ignored."""
    return posts.filter(F.col("subreddit") == subreddit) if subreddit in subreddits else posts


def search_posts(posts: DataFrame, search: str | None, wildcards: bool = False) -> DataFrame:
    """Case-insensitive substring on title or author."""
    return posts.filter(matches_search(search, "title", "author", wildcards=wildcards)) if search else posts


def check_request(source: str, limit: int, offset: int) -> None:
    if source not in SOURCES:
        raise ValueError(f"unknown source {source!r}; use one of {SOURCES}")
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}")
    if offset < 0:
        raise ValueError("offset must not be negative")


def feed_order(sort: str, order: str, raw: bool) -> list[Column]:
    """Sort column from the allow-list and the post id as tie-break.

    The raw feed counts a missing number as 0 and puts a missing time before all others; the clean feed
    keeps nulls last in both directions.
    """
    name = sort if sort in SORT_COLUMNS else DEFAULT_SORT
    descending = order.lower() == "desc"
    value = F.coalesce(F.col(name), F.lit(0)) if raw and name != "created_utc" else F.col(name)
    if descending:
        first = value.desc_nulls_last()
    else:
        first = value.asc_nulls_first() if raw else value.asc_nulls_last()
    return [first, F.asc_nulls_last("post_id")]


def matching_posts(posts, subreddits, subreddit=None, search=None, wildcards=False, arrival=None) -> DataFrame:
    rows = feed_rows(posts, arrival)
    return search_posts(filter_subreddit(rows, subreddit, subreddits), search, wildcards)


def page_levels(sort: str, order: str, raw: bool) -> list[tuple[Column, str]]:
    """What coarsens the feed's order: hour and time, or the number, then ever longer starts of the id."""
    name = sort if sort in SORT_COLUMNS else DEFAULT_SORT
    descending = order.lower() == "desc"
    direction = "desc_nulls_last" if descending else "asc_nulls_first" if raw else "asc_nulls_last"
    if name == "created_utc":
        values = [F.date_trunc("hour", name), F.col(name)]
    else:
        values = [F.coalesce(F.col(name), F.lit(0)) if raw else F.col(name)]
    levels = [(value, direction) for value in values]
    return [*levels, *((F.substring("post_id", 1, length), "asc_nulls_last") for length in ID_PREFIXES)]


def stored_bound(value: Column, kind: DataType, margin: int) -> Column:
    """A time as the type that a table stores, `margin` seconds off, so that a scan can be pruned by it."""
    if isinstance(kind, NumericType):
        return (F.unix_micros(value.cast("timestamp")) / 1_000_000 + margin).cast(kind)
    return value


def ranked_page(
    rows: DataFrame, raw: bool, sort: str, order: Sequence[Column], levels, offset: int, limit: int, arrival: str | None,
    stored: DataType | None = None, refine: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """Page over all rows, or over the best row per post when `raw`.

    With an arrival column the page is chosen from narrow rows and fixed in the checkpoint folder, at most `limit` of them.
    The long text columns are then read for these rows alone, and only from the parts of the table that hold the page's
    range of sort values. `rows` are as stored; `refine` renames, converts and filters them.
    """
    full = refine(rows)
    if not arrival:
        return page(checkpointed(dedup_posts(full)) if raw else full, levels, order, offset, limit)
    name = sort if sort in SORT_COLUMNS else DEFAULT_SORT
    locator = list(dict.fromkeys(["subreddit", "post_id", arrival]))
    needed = dict.fromkeys([*locator, name, *(["score"] if raw else [])])
    narrow = full.select(*needed)
    # Raw rows are deduplicated once; clean ones are read by each level straight from the table.
    chosen = page(checkpointed(dedup_posts(narrow, arrival=arrival)) if raw else narrow, levels, order, offset, limit)
    wanted = checkpointed(chosen.select(*[F.col(column).alias(f"_{column}") for column in {*locator, name}]))
    # Two separate lookups: Spark would merge a minimum and a maximum into one, which the scan cannot prune by.
    values = wanted.filter(F.col(f"_{name}").isNotNull())
    kind = stored or full.schema[name].dataType
    as_stored = (lambda value, margin: stored_bound(value, kind, margin)) if name == "created_utc" else lambda value, _: value
    lowest, highest = (
        values.orderBy(by(f"_{name}")).limit(1).select(as_stored(F.col(f"_{name}"), margin).alias("bound")).scalar()
        for by, margin in ((F.asc, -1), (F.desc, 1))
    )
    near = F.col(name).isNull() | F.col(name).between(lowest, highest)
    matches = [F.col(column).eqNullSafe(F.col(f"_{column}")) for column in locator]
    return refine(rows.filter(near)).join(F.broadcast(wanted), matches, "left_semi").orderBy(*order).limit(limit)


def feed_page(
    posts: DataFrame,
    subreddits: Sequence[str],
    *,
    source: str = "postgres",
    limit: int = DEFAULT_LIMIT,
    offset: int = 0,
    subreddit: str | None = None,
    search: str | None = None,
    sort: str = DEFAULT_SORT,
    order: str = "desc",
    wildcards: bool = False,
    arrival: str | None = None,
) -> DataFrame:
    """One page of posts. `postgres` reads clean rows as they are, `trino` deduplicates raw rows first.

    `arrival` names a column that is unique within a community, such as an arrival number, or `post_id` itself
    where ids do not repeat. It lets the page be found without reading the text of all posts.
    """
    check_request(source, limit, offset)
    raw = source == "trino"
    ordering = feed_order(sort, order, raw)
    tie = [F.asc_nulls_last(arrival)] if arrival else [F.asc_nulls_last(name) for name in FEED_COLUMNS]

    def refine(rows: DataFrame) -> DataFrame:
        return matching_posts(rows, subreddits, subreddit, search, wildcards, arrival)

    stored = posts.schema["created_utc"].dataType
    levels = page_levels(sort, order, raw)
    rows = ranked_page(posts, raw, sort, [*ordering, *tie], levels, offset, limit, arrival, stored, refine)
    return rows.select(*FEED_COLUMNS).withColumn("created_utc", iso_timestamp(F.col("created_utc")))


def feed_summary(
    posts: DataFrame,
    subreddits: Sequence[str],
    *,
    source: str = "postgres",
    limit: int = DEFAULT_LIMIT,
    offset: int = 0,
    subreddit: str | None = None,
    search: str | None = None,
    wildcards: bool = False,
) -> DataFrame:
    """One row: total, duplicates removed, number of pages and the range shown."""
    check_request(source, limit, offset)
    rows = matching_posts(posts, subreddits, subreddit, search, wildcards)
    if source == "trino":
        counted = rows.agg(
            F.count_distinct(F.when(has_key("post_id"), F.col("post_id"))).alias("total"),
            F.count(F.lit(1)).alias("_rows"),
        ).withColumn("duplicate_count", F.col("_rows") - F.col("total"))
    else:
        counted = rows.agg(F.count(F.lit(1)).alias("total")).withColumn(
            "duplicate_count", F.lit(None).cast("bigint")
        )
    return counted.select(
        "total",
        F.lit(limit).alias("limit"),
        F.lit(offset).alias("offset"),
        F.lit(source).alias("source"),
        "duplicate_count",
        F.ceil(F.col("total") / limit).alias("total_pages"),
        F.lit(offset + 1).cast("bigint").alias("first_shown"),
        F.least(F.lit(offset + limit).cast("bigint"), "total").alias("last_shown"),
    )


def list_subreddits(posts: DataFrame) -> DataFrame:
    return posts.select("subreddit").distinct()
