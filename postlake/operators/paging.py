"""One page of an ordered result, at any offset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from postlake.session import checkpointed


SORTED_ROWS = 50_000  # that are ordered at once, once no more than these can be on the page


def page(df: DataFrame, levels: Sequence[tuple[Column, str]], order: Sequence[Column], offset: int, limit: int) -> DataFrame:
    """Rows `offset + 1 ... offset + limit` under `order`, which has to be total.

    Each level is a value that coarsens `order` further than the next one, and the direction it is ordered in (a method
    of Column). Level by level the rows are counted per value, and running sums over these few counts leave the values that
    hold the page, at most `limit`. They are fixed in the shared folder, so each level reads `df` once and the next one starts
    from the rows of the open values. No further level is counted once these are few enough to
    be ordered. Nothing is sorted as a whole, and no task holds the skipped rows, whatever the offset.
    """
    names = [f"_level{at}" for at in range(len(levels))]
    rows = df.withColumn("_before", F.lit(0).cast("long"))
    used: list[str] = []
    for name, (value, direction) in zip(names, levels):
        rows = rows.withColumn(name, value)
        keys = [*used, name]
        counts = rows.groupBy("_before", *keys).agg(F.count(F.lit(1)).alias("_held"))
        by = Window.partitionBy("_before", *used).orderBy(getattr(F.col(name), direction)())
        earlier = F.coalesce(F.sum("_held").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        open_values = (
            counts.withColumn("_start", F.col("_before") + earlier)
            .filter((F.col("_start") < offset + limit) & (F.col("_start") + F.col("_held") > offset))
            .select(*[F.col(key).alias(f"{key}_open") for key in keys], "_start", "_held")
        )
        # Each value holds a row of the page, so there are at most `limit`.
        seen = Observation()
        fixed = checkpointed(open_values.observe(seen, F.coalesce(F.sum("_held"), F.lit(0)).alias("held"))).drop("_held")
        match = [F.col(key).eqNullSafe(F.col(f"{key}_open")) for key in keys]
        rows = rows.join(F.broadcast(fixed), match).drop("_before", *[f"{key}_open" for key in keys])
        rows = rows.withColumnRenamed("_start", "_before")
        used = keys
        if seen.get["held"] <= SORTED_ROWS:
            break
    rank = F.row_number().over(Window.partitionBy("_before", *used).orderBy(*order))
    return (
        rows.withColumn("_position", F.col("_before") + rank)
        .filter(F.col("_position").between(offset + 1, offset + limit))
        .orderBy("_position")
        .drop("_position", "_before", *used)
    )
