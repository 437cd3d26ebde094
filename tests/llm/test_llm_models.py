"""Both networks against plain loops and finite differences, and queries over tables without rows or labels."""

import math
import random

import numpy as np
import pytest

import corpus_pipeline
from postlake.llm import quality, queries, toxicity

WORDS = "bad good day night évil x hello worlds foo".split()


def toxic_sample(number=60):
    draw = random.Random(1)
    return [
        (" ".join(draw.choices(WORDS, k=draw.randint(1, 40)) + ["horrible"] * (at % 2) + draw.choices(WORDS, k=5)), at % 2)
        for at in range(number)
    ]


def plain_margin(model, text):
    """One window after the other, one word after the other, one n-gram after the other."""
    words = toxicity.split_words(text)
    odds = []
    for word in words:
        _, entries = toxicity.subwords([word])
        odds.append(sum(float(model.odds[entry]) for entry in entries) / len(entries))
    windows = [odds[at : at + toxicity.WINDOW] for at in range(max(1, len(odds) - toxicity.WINDOW + 1))]
    most = max(sum(window) / len(window) for window in windows) if odds else 0.0
    return most + model.bias - model.cut


def test_toxicity_scores_by_a_plain_loop():
    model = toxicity.fit(toxic_sample(), steps=12)
    score = toxicity.Scorer(model)
    texts = ["", None, "bad", "bad good", "good day horrible night", *(text for text, _ in toxic_sample(12))]
    for text, found in zip(texts, score(texts)):
        assert found == pytest.approx(1 / (1 + math.exp(-plain_margin(model, text))), abs=1e-6)


def test_a_toxic_phrase_counts_wherever_it_stands():
    model = toxicity.fit(toxic_sample(200), steps=30)
    score = toxicity.Scorer(model)
    for text, label in toxic_sample(20):
        scores = score([" ".join(["day"] * lead + [text]) for lead in range(3, 9)])
        if label:
            assert min(scores) >= 0.5
        assert max(scores) - min(scores) < 1e-9


def test_toxicity_slopes_by_finite_differences():
    draw = np.random.default_rng(4)
    owner = np.array([0, 0, 1, 2, 2, 2, 4])
    words = toxicity.Vocabulary(5, np.array([2.0, 3, 3, 1, 2]), owner, np.array([0, 1, 1, 2, 3, 0, 4]))
    documents = [(np.array([0, 1, 2, 3]), 1), (np.array([4]), 0), (np.array([2, 2, 1, 0, 4, 3, 1]), 0)]
    values = [draw.normal(0, 1, shape) for shape in ((6, 3), (3, 2), (2,))]
    for offset in range(toxicity.WINDOW):
        laid = toxicity.lay_out(documents, 5, offset)
        assert [int(laid.filled[group].sum()) for group in laid.groups] == [4, 1, 7]
        weight = draw.uniform(0.1, 1, len(laid.windows))

        def loss():
            return toxicity.loss_and_slopes(*values, words, laid.windows, laid.filled, laid.label, weight)[0]

        _, slopes = toxicity.loss_and_slopes(*values, words, laid.windows, laid.filled, laid.label, weight)
        check_slopes(values, slopes, loss)


def check_slopes(values, slopes, loss, step=1e-6):
    for value, slope in zip(values, slopes):
        for at in np.ndindex(value.shape):
            kept = value[at]
            value[at] = kept + step
            above = loss()
            value[at] = kept - step
            below = loss()
            value[at] = kept
            assert slope[at] == pytest.approx((above - below) / (2 * step), abs=1e-5)


def test_quality_slopes_by_finite_differences(monkeypatch):
    draw = np.random.default_rng(6)
    texts = [b"abcabcab", b"", b"hello world, this is a text of more than one chunk" * 20]
    pieces = [quality.chunks(text) for text in texts]
    rows, sizes = np.concatenate(pieces), np.array([len(piece) for piece in pieces])
    assert sizes.tolist() == [1, 1, 3]
    values = [draw.normal(0, 0.5, shape) for shape in ((256, 2), (quality.WIDTH, 2, 3), (3,), (6,), (1,))]
    labels, importance = np.array([1, 0, 1]), np.array([0.5, 2.0, 1.0])

    def loss():
        return quality.loss_and_slopes(*values, rows, sizes, labels, importance)[0]

    _, slopes = quality.loss_and_slopes(*values, rows, sizes, labels, importance)
    seen = sorted(set(b"".join(texts)) | {quality.PAD})
    assert not slopes[0][[byte for byte in range(256) if byte not in seen]].any()
    vectors = values[0]
    some = vectors[seen[:6]].copy()

    def with_some():
        vectors[seen[:6]] = some
        return loss()

    check_slopes([some], [slopes[0][seen[:6]]], with_some)
    check_slopes(values[1:], slopes[1:], loss)


def test_quality_scores_by_a_plain_loop():
    sample = [(f"good day number {at} to all of you people", 1) for at in range(30)]
    model = quality.fit(sample + [(f"$$$ ### {at} %%%" * 4, 0) for at in range(30)], 0.7, epochs=2)
    texts = ["", None, "é", "plain words of a text", "x" * 600, "a longer text, " * 120]
    for text, found in zip(texts, model(texts)):
        data, step, best = (text or "").encode(), quality.CHUNK - quality.OVERLAP, []
        starts = range(0, max(len(data) - quality.OVERLAP, 1), step)
        for start in starts:
            row = data[start : start + quality.CHUNK + quality.WIDTH - 1].ljust(quality.CHUNK + quality.WIDTH - 1, b"\0")
            best.append(
                [
                    max(
                        0.0,
                        max(
                            sum(float(model.tables[k, row[place + k], f]) for k in range(quality.WIDTH))
                            for place in range(quality.CHUNK)
                        )
                        + float(model.filter_bias[f]),
                    )
                    for f in range(0, quality.FILTERS, 5)
                ]
            )
        best = np.array(best)
        pooled = model.pooled(quality.chunks(data))[:, ::5]
        assert np.allclose(best, pooled, atol=1e-4)
        seen = model.pooled(quality.chunks(data))
        margin = float(np.concatenate((seen.max(axis=0), seen.mean(axis=0))) @ model.weights + model.bias)
        assert found == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-6)


def folder_of(spark, base, documents, labels):
    """Tables with the given rows, and the other ones that the pipeline reads."""
    spark.createDataFrame(documents, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{base}/embeddings.parquet")
    spark.createDataFrame([], "conv_id long, turn int, role string, text string").write.parquet(f"{base}/conversations.parquet")
    return str(base)


def test_queries_over_empty_tables(spark, tmp_path):
    folder = folder_of(spark, tmp_path / "none", [], [])
    for name, query in queries.QUERIES.items():
        assert query(spark, folder).count() == (1 if name.startswith("op8") else 0), name
    assert corpus_pipeline.run(spark, folder).count() == 0


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0)], [(1, None, None), (9, 0, 1)]])
def test_queries_without_labels_of_both_kinds(spark, tmp_path, labels):
    documents = [(1, "some clean words of one text", "en", "a", 1), (2, None, None, None, None), (3, "", "en", "b", 0)]
    folder = folder_of(spark, tmp_path / "few", documents, labels)
    assert [row["predicted"] for row in queries.op1_toxicity_subwords(spark, folder).collect()] == [0, 0, 0]
    assert queries.op2_quality_byte_network(spark, folder).count() == 3
    assert 1 in {doc_id for row in corpus_pipeline.run(spark, folder).collect() for doc_id in row["doc_ids"]}
