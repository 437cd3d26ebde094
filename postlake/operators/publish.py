"""Publishing curated posts to a serving table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from postlake.functions.columns import select_available
from postlake.operators.dedup import dedup_posts, has_key, keep_best, tie_break
from postlake.operators.maintenance import drop_folder, replace_table
from postlake.operators.matching import keep_existing, skip_existing
from postlake.schema import SERVING_COLUMNS, SERVING_TYPES
from postlake.session import shared_folder
from postlake.sources.tables import read_if_present, read_jdbc, read_jdbc_keys, read_jdbc_split

MODES = ("skip", "overwrite", "fail")


@dataclass(frozen=True)
class ServingTable:
    """Where rows are published: a path for file formats, a `dbtable` option for `jdbc`.

    `exists=False` says that a database table is still to be created; file tables are looked up. `predicates` are
    conditions on the key that do not overlap and together cover a database table; each is read by a task of its own.
    Without them, `split_column` names a number, date or time by whose own bounds the table is read in parallel.
    """

    fmt: str = "parquet"
    path: str | None = None
    options: dict[str, str] = field(default_factory=dict)
    exists: bool = True
    predicates: tuple[str, ...] = ()
    split_column: str | None = None

    def connection(self) -> dict[str, str]:
        return {name: value for name, value in self.options.items() if name != "dbtable"}

    def read(self, spark: SparkSession) -> DataFrame | None:
        if self.fmt != "jdbc":
            return read_if_present(spark, self.path, self.fmt, **self.options)
        if not self.exists:
            return None
        if self.split_column and not self.predicates:
            return read_jdbc_split(spark, self.options["dbtable"], self.connection(), self.split_column)
        return read_jdbc(spark, self.options["dbtable"], self.connection(), self.predicates)

    def keys(self, spark: SparkSession, key: str = "post_id") -> DataFrame | None:
        """The published keys and nothing else; None if there is no table yet. A database makes them distinct itself."""
        if self.fmt == "jdbc":
            if not self.exists:
                return None
            return read_jdbc_keys(spark, self.options["dbtable"], key, self.connection(), self.predicates)
        table = self.read(spark)
        return None if table is None else table.select(key)

    def write(self, df: DataFrame, mode: str) -> None:
        """A file table is never overwritten in place: a failed write leaves the old one."""
        if mode == "overwrite" and self.path:
            replace_table(df, self.path, self.fmt, **self.options)
        else:
            df.write.format(self.fmt).options(**self.options).mode(mode).save(self.path)


def column_types() -> str:
    """Column types for a serving table that Spark creates in a database; the key is the database's to declare."""
    return ", ".join(f"{name} {kind.replace('TEXT', 'STRING')}" for name, kind in SERVING_TYPES.items())


def serving_rows(posts: DataFrame) -> DataFrame:
    """The serving columns that exist, with `id` as `post_id`."""
    return select_available(posts, SERVING_COLUMNS).withColumnRenamed("id", "post_id")


def unique_rows(rows: DataFrame, arrival: str | None = None) -> DataFrame:
    """One row per post id, the serving table's key."""
    if "created_utc" in rows.columns:
        return dedup_posts(rows, "most_recent", arrival=arrival)
    return keep_best(rows.filter(has_key("post_id")), ["post_id"], tie_break(rows, arrival))


def publish(posts: DataFrame, target: ServingTable, mode: str = "skip", arrival: str | None = None) -> int:
    """Publish curated posts and return how many rows were written.

    `skip` appends the ids that are new, so that repeating a run (or finishing one that lost its executors)
    adds nothing twice; `overwrite` replaces the table; `fail` raises when any id is already there. `arrival` names a
    column of `posts` that records the order of arrival; it decides ties and is not published.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; use one of {MODES}")
    spark = posts.sparkSession
    columns = serving_rows(posts).columns
    kept = select_available(posts, [*SERVING_COLUMNS, *([arrival] if arrival else [])]).withColumnRenamed("id", "post_id")
    rows = unique_rows(kept, arrival).select(*columns)
    existing = None if mode == "overwrite" else target.keys(spark)
    if existing is not None and mode == "skip":
        rows = skip_existing(rows, existing, "post_id")
    staged = shared_folder(spark, "publish")
    try:
        # The rows are fixed once: they are counted and written from there, whatever happens to the target meanwhile.
        rows.write.parquet(staged)
        ready = spark.read.schema(rows.schema).parquet(staged)
        if existing is not None and mode == "fail" and not keep_existing(ready, existing, "post_id").isEmpty():
            raise ValueError("some post ids are already published")
        added = ready.count()
        if added or mode == "overwrite" or existing is None:
            target.write(ready, "overwrite" if mode == "overwrite" else "append")
    finally:
        drop_folder(spark, staged)
    return added


def publish_full(clean: DataFrame, target: ServingTable) -> int:
    """Replace the target with every column of the clean table and return its number of rows."""
    written = Observation("published")
    target.write(clean.observe(written, F.count(F.lit(1)).alias("rows")), "overwrite")
    return written.get["rows"]


def publish_sample(posts: DataFrame, target: ServingTable, limit: int = 100) -> None:
    """Append the first rows by id, for a trial of the target."""
    target.write(sample_rows(posts, limit), "append")


def sample_rows(posts: DataFrame, limit: int = 100) -> DataFrame:
    rows = serving_rows(posts)
    return rows.orderBy(*[F.asc_nulls_last(name) for name in rows.columns]).limit(limit)
