"""The scheduled batch work: deduplicate raw tables, curate them, publish the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from postlake.operators.curate import clean_columns, curate, curate_batch, write_partitioned
from postlake.operators.maintenance import commits_by_itself, replace_table, vacuum
from postlake.operators.publish import ServingTable, publish
from postlake.schema import ARRIVAL_COLUMN, BATCH_COLUMN, RUN_COLUMN
from postlake.session import checkpointed
from postlake.sources.tables import read_if_present, read_table

METRICS = "subreddit string, read bigint, curated bigint, published bigint, skipped bigint"


def arrival_of(raw: DataFrame, arrival: str | None) -> str | None:
    """The named column, or the one that ingest writes where the table has it."""
    return arrival or (ARRIVAL_COLUMN if ARRIVAL_COLUMN in raw.columns else None)


def curate_community(
    spark: SparkSession,
    name: str,
    raw_path: str,
    clean_path: str,
    target: ServingTable | None = None,
    *,
    mode: str = "skip",
    fmt: str = "parquet",
    arrival: str | None = None,
    incremental: bool = False,
) -> dict:
    """Raw table to clean table to serving table, each stage reading what the one before has written.

    A clean table is replaced as a whole, or, if `incremental`, gains what the raw batches add that it does not know yet:
    batches are known by the `batches` table next to it, which is written last, so a failed run is done again and adds
    nothing twice. `curated` counts the posts that this run put into the clean table.
    """
    raw = read_table(spark, raw_path, fmt)
    done_path = f"{clean_path.rstrip('/')}__batches"
    clean = read_if_present(spark, clean_path, fmt) if incremental else None
    batches = [column for column in (RUN_COLUMN, BATCH_COLUMN) if column in raw.columns]
    if incremental and not batches:
        raise ValueError(f"{raw_path} has no batches; ingest it with batch_writer")
    if incremental:
        present = checkpointed(raw.select(*batches).distinct())
        done = read_if_present(spark, done_path)
        fresh = present if done is None or clean is None else checkpointed(present.join(done, batches, "left_anti"))
        raw = raw.join(fresh, batches, "left_semi")
    order = arrival_of(raw, arrival)
    curated = curate(raw, order) if clean is None else curate_batch(raw, clean, order)
    posts = clean_columns(curated)
    written = Observation("curated")
    counted = posts.observe(written, F.count(F.lit(1)).alias("rows"))
    how = "append" if clean is not None else "overwrite"
    options = {"mergeSchema": "true", "overwriteSchema": "true"} if commits_by_itself(fmt) else {}
    write_partitioned(counted, clean_path, fmt, how, **options)
    if incremental:
        replace_table(present, done_path)
    clean = spark.read.format(fmt).schema(posts.schema).load(clean_path)
    published = publish(clean, target, mode) if target else 0
    vacuum(spark, f"{fmt}.`{clean_path}`", fmt)
    rows = written.get["rows"]
    return {
        "subreddit": name,
        "read": raw.count(),
        "curated": rows,
        "published": published,
        "skipped": rows - published if target else 0,
    }


def metrics_frame(spark: SparkSession, runs: list[dict]) -> DataFrame:
    return spark.createDataFrame(runs, METRICS)
