"""The scheduled deduplication of several raw tables."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.operators.maintenance import rewrite_deduplicated

logger = logging.getLogger(__name__)

OUTCOME = "subreddit string, before bigint, after bigint, removed bigint, error string"


def deduplicate_tables(
    spark: SparkSession, paths: dict[str, str], fmt: str = "parquet", dry_run: bool = False, arrival: str | None = None
) -> DataFrame:
    """Rewrite each raw table without repeated ids. A table that fails is reported and the others go on."""
    outcomes = []
    for name, path in paths.items():
        try:
            stats = rewrite_deduplicated(spark, path, fmt, dry_run, arrival)
            outcomes.append((name, stats["before"], stats["after"], stats["removed"], None))
        except Exception as error:
            logger.exception("%s was not deduplicated", name)
            outcomes.append((name, None, None, None, str(error)))
    return spark.createDataFrame(outcomes, OUTCOME)


def with_total(outcomes: DataFrame) -> DataFrame:
    """The outcomes with a `TOTAL` row and the share of rows removed."""
    total = outcomes.agg(
        F.lit("TOTAL").alias("subreddit"),
        F.sum("before").alias("before"),
        F.sum("after").alias("after"),
        F.sum("removed").alias("removed"),
    )
    share = F.round(F.try_divide(F.col("removed") * 100.0, F.col("before")), 2)
    return outcomes.unionByName(total, allowMissingColumns=True).withColumn("percent_removed", share)
