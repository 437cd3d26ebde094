"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Cluster size decides executors, memory and shuffle partitions; those stay with the caller.
# Timestamps are written as integers, because the older layout has no minimum and maximum to prune by.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.scheduler.mode": "FAIR",
}


def build_session(app_name: str = "postlake", **settings: str) -> SparkSession:
    """A session with the settings above; keyword arguments use `__` for a dot in the setting name."""
    builder = SparkSession.builder.appName(app_name)
    chosen = SESSION_SETTINGS | {name.replace("__", "."): value for name, value in settings.items()}
    for name, value in chosen.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`, or a temporary one in local mode only."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not context.getCheckpointDir():
        if not root and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(root or tempfile.mkdtemp(prefix="postlake-"))
    return (root or context.getCheckpointDir()).rstrip("/")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that nobody else uses."""
    return f"{shared_root(spark)}/postlake/{purpose}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of `df` in the shared folder, so that later jobs see exactly these partitions."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)
