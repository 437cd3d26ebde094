"""The corpus pipeline: each stage takes what the one before kept, fixed as Parquet, and its decisions take effect."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from postlake.llm import contamination, jaccard, mixing, packing, toxicity
from postlake.llm.words import table
from postlake.operators.maintenance import drop_folder
from postlake.session import shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on labelled rows of this input, does not reject."""
    return toxicity.clean_rows(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: the one with the smallest id."""
    return jaccard.leaders(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any item of the benchmark."""
    return contamination.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix_rows(docs)


def pack_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed rows of token ids."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("token_ids", pack_token_ids),
]

# A trained classifier, a randomised join and a tokenizer can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; a stage's rows are dropped once the next stage has written its own."""
    docs = table(spark, sf_dir, "documents")
    folder, before = shared_folder(spark, "pipeline"), None
    for at, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{at}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        drop_folder(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
