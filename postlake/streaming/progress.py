"""What streaming queries did: offsets, rows, state and failures of each batch, kept in a table."""

from __future__ import annotations

import json
import logging
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from postlake.schema import BATCH_COLUMN, RUN_COLUMN
from postlake.sources.tables import read_if_present

logger = logging.getLogger(__name__)

PROGRESS = (
    "name string, started_run string, timestamp string, start_offsets string, end_offsets string, input_rows long, "
    "state_rows long, state_bytes long, late_rows long, duration_ms long"
)
FAILURE = "error string"


class ProgressTable(StreamingQueryListener):
    """Writes a row for each batch to a folder of its own under `path`, named by stream and batch.

    The stream's id lives in its checkpoint, so a batch that is repeated after a restart overwrites its row, and the table
    names each batch once. Triggers that find nothing repeat the number of the next batch and are left out. Failures are
    written by run. A row that cannot be written is logged and does not stop the query.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, values: tuple, schema: str, folder: str) -> None:
        try:
            self.spark.createDataFrame([values], schema).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{folder}")
        except Exception:
            logger.exception("progress was not written to %s/%s", self.path, folder)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        states = progress.stateOperators
        if not progress.numInputRows and not any(state.numRowsUpdated or state.numRowsRemoved for state in states):
            return
        values = (
            progress.name,
            str(progress.runId),
            progress.timestamp,
            json.dumps([source.startOffset for source in progress.sources]),
            json.dumps([source.endOffset for source in progress.sources]),
            progress.numInputRows,
            sum(state.numRowsTotal for state in states),
            sum(state.memoryUsedBytes for state in states),
            sum(state.numRowsDroppedByWatermark for state in states),
            progress.durationMs.get("triggerExecution"),
        )
        self.add(values, PROGRESS, f"batches/{RUN_COLUMN}={progress.id}/{BATCH_COLUMN}={progress.batchId}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.add((event.exception,), FAILURE, f"failures/{RUN_COLUMN}={event.id}/failed_run={event.runId}")


def batches(spark: SparkSession, path: str) -> DataFrame | None:
    """One row per stream and batch; None before the first one."""
    return read_if_present(spark, f"{path}/batches", "parquet")


def awaited(spark: SparkSession, path: str, number: int, seconds: float = 30) -> DataFrame:
    """`batches` as soon as it has so many rows; events of a stream that has ended come a little later."""
    end = time.monotonic() + seconds
    while True:
        found = batches(spark, path)
        if found is not None and found.count() >= number:
            return found
        if time.monotonic() > end:
            raise TimeoutError(f"{path} does not name {number} batches")
        time.sleep(0.2)


def failures(spark: SparkSession, path: str) -> DataFrame | None:
    """One row per failed run; None without any."""
    return read_if_present(spark, f"{path}/failures", "parquet")


def totals(spark: SparkSession, path: str) -> DataFrame:
    """Batches, rows, late rows and the last state per stream."""
    return batches(spark, path).groupBy(RUN_COLUMN).agg(
        F.count(F.lit(1)).alias("batch_count"),
        F.sum("input_rows").alias("input_rows"),
        F.sum("late_rows").alias("late_rows"),
        F.max_by("state_rows", BATCH_COLUMN).alias("state_rows"),
    )
