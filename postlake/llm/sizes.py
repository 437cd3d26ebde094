"""Plans that depend on a checked size: broadcasts and work in a single partition."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from postlake.session import checkpointed

MOST_ROWS = 50_000


def fixed_and_counted(rows: DataFrame) -> tuple[DataFrame, int]:
    """`rows` in the shared folder and their number, counted while they are written (never less than there are)."""
    seen = Observation()
    fixed = checkpointed(rows.observe(seen, F.count(F.lit(1)).alias("n")))
    return fixed, seen.get["n"]


def broadcast_if_small(rows: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """Narrow rows, fixed in the shared folder: marked for broadcast if there are at most `most`, else left to the planner."""
    fixed, n = fixed_and_counted(rows)
    return F.broadcast(fixed) if n <= most else fixed


def settled(rows: DataFrame, path: str, most: int = MOST_ROWS) -> DataFrame:
    """Narrow rows, written to `path`: in one partition if there are at most `most`, so that joins and sums of such rows take
    one task and no shuffle; else as they are.

    A checkpoint keeps the planner's estimate of its size, for a join the product of both sides. Where every round joins rows
    of the round before, this number has more than twice the digits after each join, until it alone fills the driver's memory.
    Files bring a size of their own; they are written plainly, so that a few bytes never stand for many rows.
    """
    seen = Observation()
    writer = rows.observe(seen, F.count(F.lit(1)).alias("n")).write
    writer.option("compression", "none").option("parquet.enable.dictionary", "false").parquet(path)
    fixed = rows.sparkSession.read.schema(rows.schema).parquet(path)
    return fixed.coalesce(1) if seen.get["n"] <= most else fixed
