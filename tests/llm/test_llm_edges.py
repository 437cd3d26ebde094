"""Nulls, empty and long texts, repeated rows, empty tables and clashing column names, for every operator."""

import pytest
from pyspark.sql import functions as F

from postlake.llm import chat, contamination, jaccard, licenses, mixing, packing, quality, repetition, secrets, toxicity

LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 4000
ROWS = [
    (1, None, None),
    (2, "", "a"),
    (3, "   \n\t ", "a"),
    (4, "one two", None),
    (5, LONG, "b"),
    (6, "a plain text of some seven words here", "b"),
    (6, "a plain text of some seven words here", "b"),
    (None, "no id but some words in this text", "c"),
    (7, "x" * 50_000, "c"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows, with columns named like the operators' own."""
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    for name in ("size", "score", "mark", "key", "group", "taken", "target", "spans", "cut", "at", "lead_key", "ids", "n"):
        docs = docs.withColumn(name, F.lit("x"))
    return docs


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("doc_id = -1")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame(
        [(1, None), (2, ""), (3, "some seven words here that never occur in any document of these at all"), (4, "words in this")],
        "item_id long, text string",
    )


def toxic_model():
    sample = [(f"good day number {at} to all of you people " * 6, 0) for at in range(40)]
    sample += [(f"good day number {at} to you horrible " * 6, 1) for at in range(40)]
    return toxicity.fit(sample, steps=8)


def quality_model():
    sample = [(f"good day number {at} to all of you people", 1) for at in range(40)]
    return quality.fit(sample + [(f"$$$ ### {at} %%%" * 4, 0) for at in range(40)], 0.8, epochs=1)


def operators(bench):
    return {
        "toxicity": lambda docs: toxicity.score(docs, toxic_model()),
        "quality": lambda docs: quality.score(docs, quality_model()),
        "repetition": repetition.repetition,
        "jaccard": jaccard.similar,
        "secrets": lambda docs: secrets.digests(secrets.scan(docs)),
        "licenses": licenses.scan,
        "contamination": lambda docs: contamination.leaks(docs, bench),
        "mixing": mixing.mix_counts,
    }


@pytest.mark.parametrize("name", sorted(operators(None)))
def test_one_row_per_document(odd, none, bench, name):
    operator = operators(bench)[name]
    rows = operator(odd).collect()
    assert sorted((row["doc_id"] or 0) for row in rows) == sorted((row[0] or 0) for row in ROWS)
    twins = [{k: v for k, v in row.asDict().items()} for row in rows if row["doc_id"] == 6]
    assert twins[0] == twins[1]
    assert operator(none).count() == 0


@pytest.mark.parametrize("name", ["toxicity", "jaccard", "contamination", "mixing"])
def test_filters_keep_the_columns(odd, none, bench, name):
    keep = {
        "toxicity": lambda docs: toxicity.clean_rows(docs, toxic_model()),
        "jaccard": jaccard.leaders,
        "contamination": lambda docs: contamination.clean_rows(docs, bench),
        "mixing": mixing.mix_rows,
    }[name]
    kept = keep(odd)
    assert kept.columns == odd.columns
    assert 0 < kept.count() <= 3 * len(ROWS)
    assert keep(none).count() == 0


def test_defined_results(odd, bench):
    leaks = {row["doc_id"]: row["item_ids"] for row in contamination.leaks(odd, bench).collect()}
    assert leaks[None] == [4]
    assert all(ids == [] for doc_id, ids in leaks.items() if doc_id is not None)
    classes = {(row["doc_id"], row["class_id"], row["n_links"]) for row in jaccard.similar(odd).collect()}
    assert classes == {(1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 0), (5, 5, 0), (6, 6, 1), (None, None, 0), (7, 7, 0)}
    assert jaccard.leaders(odd).where("doc_id = 6").count() == 1
    words = {row["doc_id"]: (row["n_words"], row["kept"]) for row in repetition.repetition(odd).collect()}
    assert words[1] == (0, False) and words[5] == (40_000, False) and words[7] == (1, False)


def test_empty_conversations(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.format_conversations(empty)).count() == 0


def test_packing_of_odd_rows(odd, none):
    rows = packing.pack(odd).collect()
    assert sorted(i or 0 for row in rows for i, start in zip(row["doc_ids"], row["piece_starts"]) if start == 0) == sorted(
        (row[0] or 0) for row in ROWS
    )
    assert packing.pack(none).count() == 0
