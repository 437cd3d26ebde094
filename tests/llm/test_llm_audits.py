"""Divergence of sources, clustering and token counts, held against plain versions of themselves."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from postlake.llm import clustering, divergence, token_counts


def plain_audit(rows, least):
    """rows of (lang, source, text), by definition and with Python's integers."""
    rows = [tuple(value or "" for value in row) for row in rows]
    split = [
        (lang, source, [t.decode().translate(LOWER) for t in divergence.TERM.findall(text.encode())]) for lang, source, text in rows
    ]
    spread, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in split:
        spread[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = set()
    for lang in {row[0] for row in rows}:
        kept = [term for term, n in spread[lang].items() if n >= least]
        sources = sorted({row[1] for row in rows if row[0] == lang})
        own = {source: counts[lang, source] for source in sources}
        whole = sum(own.values(), Counter())

        def share(held):
            total = sum(held[term] for term in kept)
            return {t: 1 + (10**9 * (held[t] + 2)) // (total + 2 * len(kept)) for t in kept}

        shares = {source: share(held) for source, held in own.items()}
        base = share(whole)

        def apart(p, q):
            return (p - q) ** 2 // (p + q)

        for source in sources:
            pairs = [(-sum(apart(shares[source][t], shares[o][t]) for t in kept), o.encode(), o) for o in sources if o != source]
            high = [
                (-apart(shares[source][t], base[t]), t.encode(), t) for t in kept if own[source][t] and shares[source][t] > base[t]
            ]
            for part, ranked in (("pair", sorted(pairs)), ("term", sorted(high)[:10])):
                out |= {(lang, source, part, item, -value, rank) for rank, (value, _, item) in enumerate(ranked, 1)}
    return out


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def audited(df, **options):
    rows = [tuple(row) for row in divergence.audit(df, **options).select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture(scope="module")
def sourced(spark):
    draw = random.Random(3)
    words = ["Alpha", "beta", "ÉTÉ", "été", "naïve", "x", "Zug", "zug", "ñandú", "日本", "foo_bar", "12", "a1b"] + [f"w{chr(97 + i)}" for i in range(26)]
    rows = []
    for at in range(400):
        source = draw.choice(["hot"] * 3 + ["b", "B", "é", None])
        text = " ".join(draw.choices(words, k=draw.randrange(0, 30))) if at % 17 else None
        rows.append((at, draw.choice(["en", "en", "de", None]), source, text))
    rows += [(900, "en", "long", "Alpha beta " * 30_000), (901, "xx", "only", "rare"), (901, "xx", "only", "rare"), (902, "xx", "no", None)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")
    for name in ("digest", "split", "n", "docs", "term", "no", "value", "rank", "item", "part", "block"):
        df = df.withColumn(name, F.lit("x"))
    return df, [row[1:] for row in rows]


def test_divergence_by_definition(sourced):
    df, rows = sourced
    assert audited(df) == plain_audit(rows, 10)


def test_divergence_splits_terms_that_share_a_digest(sourced, monkeypatch):
    """With 3 bits every digest stands for many terms."""
    df, rows = sourced
    assert audited(df, bits=3) == plain_audit(rows, 10)


def test_divergence_in_many_blocks(sourced, monkeypatch):
    df, rows = sourced
    monkeypatch.setattr(divergence, "BLOCK_CELLS", 64)
    monkeypatch.setattr(divergence, "LEAST_WIDTH", 1)
    assert audited(df, least_documents=2) == plain_audit(rows, 2)


def test_divergence_of_odd_tables(spark):
    schema = "doc_id long, lang string, source string, text string"
    assert audited(spark.createDataFrame([], schema)) == set()
    alone = spark.createDataFrame([(1, "en", "a", "one two"), (2, "en", None, ""), (3, "de", "a", None)], schema)
    assert audited(alone) == {("en", "a", "pair", "", 0, 1), ("en", "", "pair", "a", 0, 1)}


def test_divergence_ties_at_the_last_rank(spark):
    """Twenty terms of equal value: the ten smallest by their bytes stay."""
    text = " ".join(chr(97 + at) * 2 for at in range(20))
    rows = [(at, "en", "a", text) for at in range(12)] + [(at, "en", "b", "zz top") for at in range(20, 32)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")
    assert audited(df) == plain_audit([row[1:] for row in rows], 10)


def test_shares_are_exact():
    draw = random.Random(1)
    for _ in range(2000):
        total = draw.randrange(0, 9 * 10 ** draw.randrange(1, 15))
        kept, count = draw.randrange(1, 10**6), draw.randrange(0, total + 1)
        own = divergence.shares(np.array([count]), total, kept)[0]
        assert int(own) == 1 + (10**9 * (count + 2)) // (total + 2 * kept)


def plain_clusters(rows, clusters=8, rounds=10):
    kept = []
    for vec_id, vector in rows:
        if vector is not None and len(vector) == 64 and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((vec_id, tuple(max(min(math.floor(1024 * x), 1 << 27), -(1 << 27)) for x in vector)))
    order = sorted(kept, key=lambda row: (hashlib.sha256(f"3:{'' if row[0] is None else row[0]}".encode()).hexdigest(), row[1]))
    centroids = [row[1] for row in order[:clusters]]

    def nearest(point):
        return min((sum((a - b) ** 2 for a, b in zip(point, c)), at) for at, c in enumerate(centroids))

    for _ in range(rounds):
        found = [nearest(point)[1] for _, point in kept]
        for at in range(len(centroids)):
            own = [point for (_, point), number in zip(kept, found) if number == at]
            if own:
                centroids[at] = tuple(sum(column) // len(own) for column in zip(*own))
    found = [nearest(point) for _, point in kept]
    inertia = Counter()
    for distance, number in found:
        inertia[number] += distance
    return Counter(
        (
            vec_id, number, distance, inertia[number], sum(inertia.values()),
            hashlib.sha256(",".join(map(str, centroids[number])).encode()).hexdigest(),
        )
        for (vec_id, _), (distance, number) in zip(kept, found)
    )


def vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for name in ("point", "apex", "values", "cluster", "distance", "size", "inertia"):
        df = df.withColumn(name, F.lit("x"))
    return df


def clustered(df, **options):
    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return Counter(tuple(row) for row in clustering.cluster(df, **options).select(*names).collect())


def test_clusters_by_definition(spark):
    draw = np.random.default_rng(5)
    centres = draw.normal(0, 1, (6, 64))
    rows = [(at, (centres[at % 6] + draw.normal(0, 0.2, 64)).tolist()) for at in range(150)]
    rows += [(200 + at, [float(at % 3)] * 64) for at in range(30)]  # many equal vectors
    rows += [(200, [0.0] * 64), (200, [0.0] * 64), (None, [0.5] * 64), (400, [1e30, -1e300] + [0.0] * 62)]
    odd = [(300, None), (301, []), (302, [1.0] * 63), (303, [1.0] * 65), (304, [None] + [1.0] * 63), (305, [math.nan] + [1.0] * 63),
           (306, [math.inf] + [1.0] * 63)]
    assert clustered(vectors(spark, rows + odd)) == plain_clusters(rows)
    assert clustered(vectors(spark, odd)) == Counter()
    assert clustered(vectors(spark, [])) == Counter()


@pytest.mark.parametrize("pivots", [1, 2, 12])
def test_few_vectors_and_pivots(spark, pivots):
    rows = [(1, [0.25] * 64), (2, [0.5] * 64), (3, [0.25] * 64)]
    assert clustered(vectors(spark, rows), pivots=pivots) == plain_clusters(rows)
    same = [(at, [0.125] * 64) for at in range(20)]
    assert clustered(vectors(spark, same), pivots=pivots) == plain_clusters(same)


def test_bounds_hold_and_spare_comparisons():
    draw = np.random.default_rng(7)
    centres = draw.integers(-1000, 1000, (8, 64))
    points = centres[draw.integers(0, 8, 4000)] + draw.integers(-150, 150, (4000, 64))
    points = np.concatenate((points, (centres[:4] + centres[4:]) // 2, centres)).astype(np.int64)
    centroids = np.concatenate((centres, centres[:1])).astype(np.int64)  # the last equals the first
    simplex = clustering.choose_simplex(points[:64])
    assert 2 <= len(simplex.pivots) <= clustering.PIVOTS
    exact = clustering.squared_distances(points, centroids)
    left = clustering.remaining(simplex.apexes(points), simplex.apexes(centroids))
    assert left[np.arange(len(points)), exact.argmin(axis=1)].all()
    assert (left == (exact == exact.min(axis=1)[:, None]))[:, [0, 8]].mean() > 0.5
    assert left.sum() < 0.6 * left.size
    assert (clustering.nearest(points, simplex.apexes(points), centroids, simplex) == exact.argmin(axis=1)).all()
    apexes, others = simplex.apexes(points), simplex.apexes(centroids)
    base = np.square(apexes[:, None, :-1] - others[None, :, :-1]).sum(axis=2)
    lower = base + np.square(apexes[:, None, -1] - others[None, :, -1])
    upper = base + np.square(apexes[:, None, -1] + others[None, :, -1])
    assert (lower <= exact * (1 + 1e-6) + 1).all() and (upper >= exact * (1 - 1e-6) - 1).all()


TEXTS = [
    None, "", " ", "   ", "a", " a", "a ", "a  b", "\n", "\n\n a\n", "tab\tand\rreturn", "</s><s> <unk> <0x41> ▁▁x▁", "été naïve 日本語 🎉🎉",
    "x" * 5000, "0123456789" * 700, "日本語" * 900, " " * 3000 + "end", "a\x00b", "mixed " * 2000, "don't stop—now… " * 500,
    "é" * 400, " " * 50, "supercalifragilistic" * 200,
]


@pytest.fixture(scope="module")
def model():
    return token_counts.load(token_counts.default_path())


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_proto=model.file)


def test_token_counts_equal_the_library(spark, model, library):
    rows = [(at, text) for at, text in enumerate(TEXTS)] + [(3, "   "), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("x")).withColumn("n_bytes", F.lit("x"))
    found = Counter(tuple(row) for row in token_counts.token_counts(df, model).collect())
    expected = Counter()
    for doc_id, text in rows:
        n = len(library.encode(text or ""))
        expected[doc_id, len((text or "").encode()), n, n > 4096] += 1
    assert found == expected
    assert token_counts.token_counts(df.where("doc_id = -1"), model).count() == 0


@pytest.mark.parametrize("most", [1, 7, 64])
def test_cuts_are_safe(model, library, most):
    """Any text in pieces of any size has as many tokens as the whole."""
    import pyarrow as pa

    draw = random.Random(most)
    alphabet = "abcde fghij  klmno\n\tpqrst'.,-0123é日▁"
    texts = [text or "" for text in TEXTS] + ["".join(draw.choices(alphabet, k=draw.randrange(1, 400))) for _ in range(300)]
    for text in texts:
        assert "".join(token_counts.cut(text, model.joined, most)) == text
    counter = token_counts.TokenCounter(model, piece_chars=most, portion_bytes=500)
    assert counter(pa.array(texts)) == [len(ids) for ids in library.encode(texts)]


def test_no_cuts_where_they_are_not_safe(model):
    assert model.joined
    assert token_counts.cut("some text " * 50, None, 10) == ["some text " * 50]
    assert max(map(len, token_counts.cut("some words of a long text " * 50, model.joined, 10))) <= 10
