"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.words import fold_of


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, most_chars: int, doc_id: str = "doc_id", text: str = "text"
) -> list[tuple[str, int]]:
    """At most `per_class` texts of each label, of `most_chars` code points or fewer, in the order of a hash of the id.

    Only documents outside fold 0 are used. The ids are chosen from the labels alone and then looked up in the documents,
    so only the texts of the sample are shuffled; the list of ids is bounded by `per_class` and so broadcast. Of rows that
    share an id the smallest text is taken.
    """
    known = (
        labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (fold_of(F.col("doc_id")) != 0))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    order = F.md5(F.col("doc_id").cast("string"))
    # More ids than rows are asked for, since some texts are missing or too long.
    chosen = [known.where(F.col("label") == value).orderBy(order, "doc_id").limit(3 * per_class) for value in (0, 1)]
    ids = F.broadcast(chosen[0].unionByName(chosen[1]))
    found = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).where(
        F.length("text").between(1, most_chars)
    )
    one_each = found.join(ids, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    rows = one_each.select(order.alias("order"), "text", "label").collect()
    sample: list[tuple[str, int]] = []
    for value in (0, 1):
        own = sorted((row["order"], row["text"]) for row in rows if row["label"] == value)
        sample += [(text, value) for _, text in own[:per_class]]
    return sample
