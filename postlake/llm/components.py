"""Connected components of a table of links, by contraction.

In each round every node is hooked to the smallest node among its neighbours and itself, hooks are followed to their ends, and
the links are rewritten to lead from hook to hook; links inside a hook vanish. The links shrink from round to round until none is
left; once they are few, a round is one task without shuffles. Neighbourhoods are never gathered: a node with any number of
links is one `min`, aggregated before the shuffle. What a round leaves is written to the shared folder until the end.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.sizes import settled
from postlake.operators.maintenance import drop_folder
from postlake.session import checkpointed, shared_folder


def followed(hooks: DataFrame, fixed: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Hooks followed to their ends; each step doubles the way, so a chain takes a logarithmic number of steps."""
    while True:
        above = hooks.select(F.col("node").alias("root"), F.col("root").alias("above"))
        moved = (F.col("above") != F.col("root")).alias("moved")
        steps = fixed(hooks.join(above, "root").select("node", F.col("above").alias("root"), moved))
        hooks = steps.select("node", "root")
        if steps.where("moved").isEmpty():
            return hooks


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and root for every node of `links`; the root is the smallest node of the component. Values must order."""
    spark, numbers = links.sparkSession, count()
    folder = shared_folder(spark, "components")
    try:
        return checkpointed(contracted(links, a, b, lambda rows: settled(rows, f"{folder}/{next(numbers)}")))
    finally:
        drop_folder(spark, folder)


def contracted(links: DataFrame, a: str, b: str, fixed: Callable[[DataFrame], DataFrame]) -> DataFrame:
    both = links.select(F.col(a).alias("node"), F.col(b).alias("other")).unionByName(
        links.select(F.col(b).alias("node"), F.col(a).alias("other"))
    )
    edges = fixed(both.where(F.col("node") != F.col("other")).distinct())
    roots = None
    while True:
        hooks = followed(fixed(edges.groupBy("node").agg(F.least("node", F.min("other")).alias("root"))), fixed)
        if roots is None:
            roots = hooks
        else:
            moved = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
            roots = fixed(roots.join(moved, "root", "left").select("node", F.coalesce("next", "root").alias("root")))
        ends = hooks.select(F.col("node").alias("other"), F.col("root").alias("end"))
        edges = fixed(
            edges.join(hooks, "node")
            .select(F.col("root").alias("node"), "other")
            .join(ends, "other")
            .select("node", F.col("end").alias("other"))
            .where(F.col("node") != F.col("other"))
            .distinct()
        )
        if edges.isEmpty():
            return roots
