"""The named queries of the corpus operators, each over its whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from postlake.llm import (
    chat,
    clustering,
    contamination,
    divergence,
    jaccard,
    licenses,
    mixing,
    packing,
    quality,
    repetition,
    secrets,
    token_counts,
    toxicity,
)
from postlake.llm.words import table


def op1_toxicity_subwords(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return toxicity.score(documents, toxicity.train(documents, table(spark, folder, "labels")))


def op2_quality_byte_network(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return quality.score(documents, quality.train(documents, table(spark, folder, "labels")))


def op3_repetition_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return repetition.repetition(table(spark, folder, "documents"))


def op4_jaccard_chosen_path(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar(table(spark, folder, "documents")).select("doc_id", "class_id", "n_links", "copies")


def op5_secret_randomness(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digests(secrets.scan(table(spark, folder, "documents")))


def op6_license_sentences(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def op7_pack_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op8_chat_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    extra = spark.sql(
        "SELECT -7L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text "
        "FROM VALUES (0L, 'user'), (1L, 'assistant') AS said(turn, role)"
    )
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digests(chat.format_conversations(rows))


def op9_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return contamination.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op10_mix_water_filling(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_counts(table(spark, folder, "documents"))


def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


def op12_simplex_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return clustering.cluster(table(spark, folder, "embeddings"))


def op13_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity_subwords": op1_toxicity_subwords,
    "op2_quality_byte_network": op2_quality_byte_network,
    "op3_repetition_coverage": op3_repetition_coverage,
    "op4_jaccard_chosen_path": op4_jaccard_chosen_path,
    "op5_secret_randomness": op5_secret_randomness,
    "op6_license_sentences": op6_license_sentences,
    "op7_pack_token_ids": op7_pack_token_ids,
    "op8_chat_round_trip": op8_chat_round_trip,
    "op9_benchmark_leaks": op9_benchmark_leaks,
    "op10_mix_water_filling": op10_mix_water_filling,
    "op11_source_divergence": op11_source_divergence,
    "op12_simplex_clusters": op12_simplex_clusters,
    "op13_token_counts": op13_token_counts,
}

ORACLES: dict[str, str] = {
    "op6_license_sentences": licenses.oracle(),
    "op8_chat_round_trip": chat.ORACLE,
    "op10_mix_water_filling": mixing.ORACLE,
    "op11_source_divergence": divergence.ORACLE,
    "op12_simplex_clusters": clustering.oracle(),
}
