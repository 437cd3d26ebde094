"""Publishing from a stream: each micro-batch adds the posts that no earlier one has published."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.operators.matching import skip_existing
from postlake.operators.publish import ServingTable, unique_rows
from postlake.operators.search_index import SEARCHED, build_index
from postlake.schema import BATCH_COLUMN, RUN_COLUMN
from postlake.sources.tables import read_if_present
from postlake.streaming.queries import append_batch, running_query

KEY = "post_id"


def new_posts_writer(
    path: str, serving: ServingTable | None = None, arrival: str | None = None, fmt: str = "parquet"
) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` function that appends to `path` one row per post id that is neither in `serving` nor in `path`.

    The published keys are read anew for every batch and joined as a static side, so rows published meanwhile by other jobs
    count. Rows that this very batch has written before a failure are left out of that snapshot: its replay chooses the
    same rows and overwrites them, or finds its commit in a table format.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, run = batch.sparkSession, running_query(batch)
        rows = unique_rows(batch, arrival)
        known = serving.keys(spark, KEY) if serving else None
        if known is not None:
            rows = skip_existing(rows, known, KEY)
        published = read_if_present(spark, path, fmt)
        if published is not None:
            own = (F.col(RUN_COLUMN) == run) & (F.col(BATCH_COLUMN) == batch_id)
            rows = skip_existing(rows, published.filter(~own).select(KEY), KEY)
        append_batch(rows.select(*batch.columns), path, fmt, run, batch_id)

    return write


def indexed_writer(
    write: Callable[[DataFrame, int], None], path: str, key: str, columns: Sequence[str] = SEARCHED
) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` function that writes a batch by `write` and then adds it to the search index at `path`.

    Each micro-batch is an entry of its own, named by stream and batch, which a replay overwrites. Rows of a batch that
    `write` leaves out are harmless: a search verifies what the index names.
    """

    def write_indexed(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        build_index(batch, path, key, columns, f"{running_query(batch)}-{batch_id}")

    return write_indexed
