"""Joins, decontamination, mixing, packing, chat and the pipeline against brute force and exact round trips."""

import collections
import hashlib
import os
import random
import sys
from functools import partial

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from postlake.llm import chat, contamination, jaccard, mixing, packing, toxicity
from postlake.llm.components import components
from postlake.llm.words import split_words, table
from postlake.session import shared_root

SMALL = "/root/testdata/sf0.001"


def prose(rng, words):
    return " ".join("".join(rng.choice("thaenroisl") for _ in range(rng.randint(3, 8))) for _ in range(words))


def near_copies(rng, base, number, changes):
    copies = []
    for _ in range(number):
        words = base.split()
        for _ in range(rng.randint(0, changes)):
            words[rng.randrange(len(words))] = prose(rng, 1)
        copies.append(" ".join(words))
    return copies


def brute_similar(texts):
    """class id and links of every document, by comparing all pairs."""
    shingle = jaccard.Shingler()
    sets = {doc: set(shingle(text).tolist()) for doc, text in texts.items()}
    parent, links = {doc: doc for doc in texts}, collections.Counter()

    def find(doc):
        while parent[doc] != doc:
            doc = parent[doc]
        return doc

    docs = sorted(texts)
    for at, a in enumerate(docs):
        for b in docs[at + 1 :]:
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                first, second = sorted((find(a), find(b)))
                parent[second] = first
    return {doc: (find(doc), links[doc]) for doc in docs}


@pytest.mark.parametrize("target_recall", [0.99999, jaccard.TARGET_RECALL])
def test_similar_documents(spark, monkeypatch, target_recall):
    # Small limits, so that buckets are split to the last level and clusters are compared in blocks.
    monkeypatch.setattr(jaccard, "SMALL", 4)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rng = random.Random(1)
    shared = prose(rng, 30)
    texts = near_copies(rng, prose(rng, 120), 60, 3) + [prose(rng, 60)] * 9
    texts += [shared + " " + prose(rng, 60) for _ in range(40)] + ["one two", "one two", "", None, prose(rng, 5)]
    for _ in range(15):
        texts += near_copies(rng, prose(rng, rng.randint(20, 200)), 3, 2)
    texts = dict(enumerate(texts))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {row["doc_id"]: (row["class_id"], row["n_links"]) for row in jaccard.similar(docs, target_recall=target_recall).collect()}
    expected = brute_similar(texts)
    assert found == expected
    leaders = {row["doc_id"] for row in jaccard.leaders(docs).select("doc_id").collect()}
    assert leaders == {doc for doc, (lead, _) in expected.items() if lead == doc}


def test_a_large_group_is_joined_once(spark, monkeypatch):
    """Links grow with the classes of a group of near-copies, not with its buckets, runs and blocks."""
    monkeypatch.setattr(jaccard, "BLOCK", 32)
    rng = random.Random(12)
    texts = near_copies(rng, prose(rng, 100), 300, 2) + [prose(rng, 60) for _ in range(50)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    info = jaccard.document_info(rows, jaccard.runs_for()).cache()
    buckets = jaccard.memberships(info).cache()
    classes = info.select("mark").distinct().count()
    assert buckets.count() > 10 * classes
    sketches = info.select("mark", "n", "bottom").dropDuplicates(["mark"])
    first = jaccard.by_group(jaccard.connecting_groups(buckets).join(sketches, "mark"), jaccard.likely_links, "a binary, b binary")
    clusters = components(first).select(F.col("node").alias("mark"), F.col("root").alias("cluster"))
    left = jaccard.remaining_groups(buckets, clusters)
    more = jaccard.by_group(left.join(sketches, "mark"), jaccard.likely_links, "a binary, b binary")
    assert 0 < first.count() <= jaccard.CONNECTING * classes and more.count() <= classes
    found = {row["doc_id"]: (row["class_id"], row["n_links"]) for row in jaccard.similar(docs).collect()}
    assert found == brute_similar(dict(enumerate(texts)))


def test_a_set_goes_once_into_each_bucket_that_is_split(spark, monkeypatch):
    """Rows of the split are the sets of large buckets, not their paths; the buckets are those of `chosen_paths`."""
    monkeypatch.setattr(jaccard, "SMALL", 4)
    rng = random.Random(21)
    passage = prose(rng, 30)
    texts = [passage + " " + prose(rng, 30) for _ in range(60)] + [prose(rng, 40) for _ in range(20)] + ["one two", "", None]
    shingle, runs = jaccard.Shingler(), jaccard.runs_for()
    paths = [list(zip(*jaccard.chosen_paths(tokens, runs))) for tokens in map(shingle, texts) if len(tokens)]
    expected, split = collections.Counter(), []
    for level in range(jaccard.DEPTH):
        sizes = collections.Counter(key for own in paths for key in {path[level] for path in own} if key)
        last = level + 1 == jaccard.DEPTH
        expected.update(n for n in sizes.values() if n > 1 and (last or n <= jaccard.SMALL))
        if not last:
            paths = [[path for path in own if sizes[path[level]] > jaccard.SMALL and path[level + 1]] for own in paths]
            split.append(sum(len({path[level] for path in own}) for own in paths))

    fixed, keep = [], jaccard.checkpointed
    monkeypatch.setattr(jaccard, "checkpointed", lambda rows: fixed.append(keep(rows)) or fixed[-1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    info = jaccard.document_info(docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text"), runs)
    found = jaccard.memberships(info).groupBy("bucket", "size").agg(F.count("*").alias("rows")).collect()
    assert collections.Counter(row["size"] for row in found) == expected and all(row["size"] == row["rows"] for row in found)
    assert [rows.count() for rows in fixed if "mark" in rows.columns] == split and min(split) > 100


def test_components(spark):
    rng = random.Random(7)
    links = [(at, at + 1) for at in range(0, 60)] + [(100, at) for at in range(101, 140)] + [(5, 5), (200, 200)]
    links += [(300 + rng.randrange(50), 300 + rng.randrange(50)) for _ in range(40)]
    rng.shuffle(links)
    parent = {node: node for link in links for node in link}

    def find(node):
        while parent[node] != node:
            node = parent[node]
        return node

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    found = {row["node"]: row["root"] for row in components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {node for a, b in links if a != b for node in (a, b)}
    assert found == {node: find(node) for node in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("most", [0, 50_000])
def test_estimates_do_not_grow_with_the_rounds(spark, monkeypatch, most):
    """The planner's size of the result is that of its rows, however many joins led to it, and no files are left."""
    module = sys.modules["postlake.llm.components"]
    monkeypatch.setattr(module, "settled", partial(module.settled, most=most))
    # Ends of chains in the order of their nodes take seven joins, and these chains are linked to each other by later nodes.
    links = [(100 * chain + at, 100 * chain + at + 1) for chain in range(4) for at in range(90)]
    links += [(100 * chain + 60, 100 * chain + 175) for chain in range(3)]
    found = components(spark.createDataFrame(links, "a long, b long"))
    assert {(row["node"], row["root"]) for row in found.collect()} == {(node, 0) for link in links for node in link}
    assert found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length() < 64
    kept = os.path.join(shared_root(spark).removeprefix("file:"), "postlake")
    assert not [name for name in os.listdir(kept) if name.startswith("components-")]


def test_runs_reach_the_target():
    assert jaccard.survival(1) > jaccard.survival(3) > 0.4
    assert (1 - jaccard.survival(jaccard.DEPTH)) ** jaccard.runs_for(0.999) <= 0.001


def test_contained_sets_share_a_path_at_the_target_of_the_query():
    rng = np.random.default_rng(3)
    runs, pairs, lost = jaccard.runs_for(), 4000, 0
    for _ in range(pairs):
        whole = rng.integers(0, 1 << 63, 100, dtype=np.uint64)
        own, other = (jaccard.chosen_paths(np.sort(part), runs)[-1] for part in (whole, whole[:80]))
        lost += not np.intersect1d(own[own != 0], other).size
    assert (1 - jaccard.survival(jaccard.DEPTH, common=1.0)) ** runs <= 1 - jaccard.TARGET_RECALL
    assert lost <= 2 * (1 - jaccard.TARGET_RECALL) * pairs


@pytest.fixture(scope="module")
def benchmark(spark):
    return table(spark, SMALL, "benchmark")


def planted_documents(benchmark):
    rng = random.Random(2)
    items = {row["item_id"]: row["text"] for row in benchmark.collect()}
    texts, truth = {}, {}
    for at in range(120):
        item = rng.choice(sorted(items))
        words = items[item].split()
        if at % 3 == 1:  # a change at the end leaves most shingles
            words[-1] = "changed"
        if at % 3 == 2:  # every third word changed: nothing is left
            words = [word if k % 3 else "other" for k, word in enumerate(words)]
        around = prose(rng, rng.randint(0, 80)).split()
        cut = rng.randint(0, len(around))
        texts[at] = " ".join(around[:cut] + words + around[cut:])
        truth[at] = [item] if at % 3 != 2 else []
    return texts, truth


@pytest.mark.parametrize("block_chars", [contamination.BLOCK_CHARS, 2000])
def test_benchmark_leaks(spark, benchmark, monkeypatch, block_chars):
    monkeypatch.setattr(contamination, "BLOCK_CHARS", block_chars)
    texts, truth = planted_documents(benchmark)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {row["doc_id"]: row["item_ids"] for row in contamination.leaks(docs, benchmark).collect()}
    assert found == truth
    kept = {row["doc_id"] for row in contamination.clean_rows(docs, benchmark).collect()}
    assert kept == {doc for doc, items in truth.items() if not items}


def test_blocks_find_every_fingerprint_within_the_radius():
    rng = np.random.default_rng(3)
    items = [(at, prose(random.Random(at), 40)) for at in range(30)]
    weights = collections.defaultdict(lambda: 1.0)
    index = contamination.Index(items, weights)
    own = np.array([mark for mark, _, _ in index.windows[32]], dtype=np.uint64)
    marks = np.concatenate((rng.integers(0, 1 << 63, 200, dtype=np.uint64), own[:50]))
    for at in range(200, 250):
        for bit in rng.choice(64, contamination.RADIUS, replace=False):
            marks[at] ^= np.uint64(1) << np.uint64(bit)
    found = set(zip(*(x.tolist() for x in index.near(32, marks))))
    brute = np.bitwise_count(marks[:, None] ^ own[None, :]) <= contamination.RADIUS
    assert found == set(zip(*(x.tolist() for x in np.nonzero(brute))))


def test_an_unchanged_item_is_found_at_every_place(benchmark):
    items = [(row["item_id"], row["text"]) for row in benchmark.collect()][:10]
    index = contamination.Index(items, collections.defaultdict(lambda: 1.0))
    search, rng = contamination.Searcher(index), random.Random(4)
    texts = [" ".join([prose(rng, 1)] * place + [text, prose(rng, 30)]) for _, text in items for place in range(9)]
    assert [sorted(found) for found in search(pa.array(texts))] == [[at] for at in range(10) for _ in range(9)]


def filled(sizes, weights, epochs):
    """Targets by clamping one round after the other."""
    clamped, total = {}, sum(sizes.values())
    while True:
        rest = total - sum(clamped.values())
        free = {name: weights[name] for name in sizes if name not in clamped}
        targets = {name: rest * weight / sum(free.values()) for name, weight in free.items()}
        over = {name: epochs * sizes[name] for name in free if targets[name] > epochs * sizes[name]}
        if not over:
            return targets | clamped
        clamped |= over


def test_mixing_against_rounds(spark):
    rng = random.Random(5)
    rows = []
    for source, number, words in (("a", 4, 3), ("b", 300, 50), ("c", 40, 10), (None, 20, 5), ("é", 100, 20), ("Z", 1, 900)):
        rows += [(source, prose(rng, rng.randint(1, 2 * words))) for _ in range(number)]
    docs = spark.createDataFrame([(at, *row) for at, row in enumerate(rows)], "doc_id long, source string, text string")
    mixed = mixing.mix_counts(docs).collect()
    sizes = collections.Counter()
    for source, text in rows:
        sizes[source] += len(text.split())
    order = sorted((name for name in sizes if name is not None), key=lambda name: [ord(c) for c in name]) + [None]
    targets = filled(sizes, {name: (5, 2, 1)[at % 3] for at, name in enumerate(order)}, 3)
    taken, largest = collections.Counter(), collections.Counter()
    for row in mixed:
        source = rows[row["doc_id"]][0]
        assert row["size"] == len(rows[row["doc_id"]][1].split()) and row["source_size"] == sizes[source]
        assert row["target"] == pytest.approx(targets[source]) and row["taken"] <= 3 * row["size"]
        taken[source] += row["taken"]
        largest[source] = max(largest[source], row["size"])
    assert all(abs(taken[source] - targets[source]) <= largest[source] / 2 + 1e-6 for source in sizes)
    assert sorted(mixed) == sorted(mixing.mix_counts(docs.repartition(7)).collect())
    copies = collections.Counter(row["doc_id"] for row in mixing.mix_rows(docs).collect())
    assert all(copies[row["doc_id"]] * row["size"] == row["taken"] for row in mixed)


def test_packed_rows_hold_every_token_once(spark):
    docs = table(spark, SMALL, "documents").select("doc_id", "text")
    rows = packing.pack(docs, row_tokens=256, window_tokens=5000).collect()
    with open(packing.VOCABULARY, "rb") as file:
        encoder = packing.Encoder(file.read())
    pieces = collections.defaultdict(dict)
    for row in rows:
        ids = packing.row_ids(row["ids"], 256)
        ends = row["cu_seqlens"]
        assert ends[0] == 0 and ends[-1] == row["n_tokens"] <= 256 and (ids[row["n_tokens"] :] == encoder.end).all()
        assert row["position_resets"] == ends[:-1]
        positions = packing.position_ids(row["position_resets"], 256)
        for doc_id, first, start, end in zip(row["doc_ids"], row["piece_starts"], ends, ends[1:]):
            assert positions[start:end].tolist() == list(range(end - start))
            assert first not in pieces[doc_id]
            pieces[doc_id][first] = ids[start:end]
    texts = {row["doc_id"]: row["text"] for row in docs.collect()}
    assert set(pieces) == set(texts)
    for doc_id, parts in pieces.items():
        ids = np.concatenate([parts[first] for first in sorted(parts)])
        assert ids[-1] == encoder.end
        assert encoder.encoding.decode(ids[:-1].tolist()) == texts[doc_id]
    assert sum(row["n_tokens"] for row in rows) >= 0.95 * 256 * len(rows)


def test_words_are_encoded_as_in_the_whole_text():
    with open(packing.VOCABULARY, "rb") as file:
        encoder = packing.Encoder(file.read())
    for text in ("a  b", " a", "a ", "\n a", "a\n b", "it's 's x", "a  b", "a  b", "", "   ", "é è 12 x\t y", "a\t\n  b c"):
        assert encoder.encode(text) == encoder.plain(text)


def test_best_fit_takes_the_fullest_row():
    rng = random.Random(6)
    for _ in range(200):
        most = rng.choice([1, 7, 16, 50, 64])
        lengths = [rng.randint(1, most) for _ in range(rng.randint(0, 80))]
        rows = packing.best_fit(lengths, most)
        free = []
        for length in sorted(lengths, reverse=True):
            fitting = [capacity for capacity in free if capacity >= length]
            if fitting:
                free[free.index(min(fitting))] -= length
            else:
                free.append(most - length)
        assert sorted(most - sum(lengths[at] for at in row) for row in rows) == sorted(free)
        assert sorted(at for row in rows for at in row) == list(range(len(lengths)))


TURNS = [
    (1, 1, "assistant", "</s>[INST] ok [/INST]"),
    (1, 0, "user", "</s>[INST] ok [/INST]"),
    (2, 0, "user", "plain [text] ~1 with < and ~"),
    (2, 1, "assistant", "answer ~0 é𝄞"),
    (3, 0, "system", "<<SYS>>~2[INST]<s!><s>"),
    (3, 1, "odd\nrole</s>", "x"),
    (3, 2, None, None),
    (4, None, "assistant", ""),
    (4, 0, "assistant", "a\nb"),
    (4, 0, "assistant", "a\nb"),
    (None, 0, "user", "[/INST]"),
]


def test_chat_round_trip(spark):
    rows = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(rows)
    read = {row["conv_id"]: row for row in chat.digests(formatted).collect()}
    levels = {row["conv_id"]: (row["escaping"], row["formatted"]) for row in formatted.collect()}
    assert levels[2][0] == "as_is" and levels[1][0] == levels[3][0] == "conflicts"
    assert levels[1][1] == "<s!>user\n[INST]~1/s>~2INST] ok ~2/INST][/INST]</s><s!>assistant\n~1/s>~2INST] ok ~2/INST]</s>"
    for conv_id in {turn[0] for turn in TURNS}:
        own = sorted((t[1] is not None, t[1] or 0, t[2] or "", t[3] or "") for t in TURNS if t[0] == conv_id)
        whole = "".join(f"{role}\n{text}\n" for _, _, role, text in own)
        learned = "".join(text for _, _, role, text in own if role == "assistant")
        row = read[conv_id]
        assert row["n_turns"] == len(own) and row["formatted_chars"] == len(levels[conv_id][1])
        assert row["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert (row["loss_chars"], row["loss_sha256"]) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())


def test_pipeline_stage_by_stage(spark):
    """Every stage against a plain version of what it decides."""
    docs = table(spark, SMALL, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "ngram_jaccard_join", "benchmark_decontamination", "mixing", "token_ids"]

    def rows_of(name, given):
        made = stages[name](spark, given, SMALL)
        return made, [row.asDict() for row in made.collect()]

    model = toxicity.train(docs, table(spark, SMALL, "labels"))
    score = toxicity.Scorer(model)
    given = [row.asDict() for row in docs.collect()]
    clean, rows = rows_of("toxicity", docs)
    assert clean.columns == docs.columns
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in given if score([r["text"]])[0] < 0.5)

    single, left = rows_of("ngram_jaccard_join", clean)
    brute = brute_similar({row["doc_id"]: row["text"] for row in rows})
    assert single.columns == docs.columns
    assert sorted(r["doc_id"] for r in left) == sorted(doc for doc, (lead, _) in brute.items() if lead == doc)

    items = [row["text"] for row in table(spark, SMALL, "benchmark").collect()]
    safe, kept = rows_of("benchmark_decontamination", single)
    leaked = {row["doc_id"] for row in left if any(item in row["text"] for item in items)}
    assert {row["doc_id"] for row in left} - {row["doc_id"] for row in kept} == leaked

    mixed, repeated = rows_of("mixing", safe)
    connection = duckdb.connect()
    documents = safe.toPandas()  # noqa: F841
    sql = mixing.ORACLE.replace("FROM documents", "FROM documents")
    taken = {row[0]: (row[1], row[4]) for row in connection.sql(sql).fetchall()}
    copies = collections.Counter(row["doc_id"] for row in repeated)
    assert all(copies[doc] * size == words for doc, (size, words) in taken.items())

    _, packed = rows_of("token_ids", mixed)
    starts = collections.Counter(i for row in packed for i, start in zip(row["doc_ids"], row["piece_starts"]) if start == 0)
    assert starts == copies


def test_words_of_the_contract():
    assert split_words("a b\x1cc\x85 d\x0be") == ["a b\x1cc\x85", "d", "e"]


def test_a_text_is_judged_the_same_in_any_company(benchmark):
    """Edited copies at all offsets, alone and behind texts of other lengths."""
    rng = random.Random(9)
    items = [(row["item_id"], row["text"]) for row in benchmark.collect()][:25]
    index = contamination.Index(items, collections.defaultdict(lambda: 1.0))
    texts = []
    for at in range(400):
        words = rng.choice(items)[1].split()
        for _ in range(rng.randint(0, 3)):
            place = rng.randrange(len(words))
            words[place : place + rng.randint(0, 1)] = [] if rng.random() < 0.3 else [prose(rng, 1)]
        texts.append(" ".join([prose(rng, 1) for _ in range(at % 17)] + words + [prose(rng, 20)]))
    alone = [found for text in texts for found in contamination.Searcher(index)(pa.array([text]))]
    for shift in range(1, 6):
        company = [x for text in texts for x in (prose(rng, rng.randint(1, 40) + shift), text)]
        assert list(contamination.Searcher(index)(pa.array(company)))[1::2] == alone


def test_similarity_is_the_weighted_share(benchmark):
    """What is reported is the share of the item's weight, by strings, in the stretch around the copy."""
    rows = benchmark.collect()[:8]
    weights = collections.defaultdict(lambda: 1.0)
    index = contamination.Index([(row["item_id"], row["text"]) for row in rows], weights)
    for at, row in enumerate(rows):
        words = row["text"].split()
        words[-1] = "changed"
        (found,) = contamination.Searcher(index)(pa.array(["before it " + " ".join(words) + " and after"]))
        own = set(contamination.shingles([contamination.comparable(word) for word in row["text"].split()]))
        held = set(contamination.shingles([contamination.comparable(word) for word in words]))
        assert found[at] == pytest.approx(len(own & held) / len(own))


def test_the_mix_leaves_documents_where_they_are(spark, monkeypatch):
    """No exchange, sort or broadcast of the rows themselves; beyond the bound of a broadcast sources are salted."""
    docs = table(spark, SMALL, "documents")

    def plan_of(df):
        return df._jdf.queryExecution().executedPlan().toString()

    small = plan_of(mixing.mix_rows(docs))
    assert "BroadcastHashJoin" in small and "BuildRight" in small and "SortMergeJoin" not in small
    assert "hashpartitioning" not in small
    counts = plan_of(mixing.mix_counts(docs))
    assert "BuildRight" in counts and "BuildLeft" not in counts and "SortMergeJoin" not in counts and "hashpartitioning" not in counts
    expected = sorted(tuple(row) for row in mixing.mix_counts(docs).collect())
    monkeypatch.setattr(mixing, "MOST_ROWS", 0)
    assert "mix_salt" in plan_of(mixing.mix_counts(docs))
    assert sorted(tuple(row) for row in mixing.mix_counts(docs).collect()) == expected
