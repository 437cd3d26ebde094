"""N-gram Jaccard join by chosen paths: which documents share at least 80 % of their five-word shingles.

Documents with equal shingle sets are one class; a class is compared once. In every run a set chooses each of its shingles
with probability 1 / (similarity * size), by a hash that all sets share, so similar sets tend to choose the same ones. A
chosen shingle is a bucket. Buckets with more than SMALL classes are split again by further shingles, down to DEPTH levels;
the others are compared by brute force. At the last level a bucket of any size is compared, cut into blocks of BLOCK classes
of which every pair is a group of its own. Runs are repeated until a pair at the threshold is missed with a probability of
at most 1 - TARGET_RECALL; closer pairs are missed less often.

Comparison has three steps. First every class is compared in its `CONNECTING` largest buckets, a large one only within blocks of
BLOCK members, by the 32 smallest shingle hashes of each class, which tell apart what is clearly different (no more than one
pair in 10,000 at the threshold is lost there). What is alike is joined into clusters. Then all buckets are looked at cluster
by cluster: one that lies within a single cluster is dropped; in the others every pair of blocks is compared, except that the
members of a bucket's largest cluster are not compared with each other again. A group returns links between clusters only,
fewer than it holds clusters. So a large group of near-copies is joined once and not once more in every run. At last each
cluster, in pairs of blocks of at most about BLOCK members and BLOCK_TOKENS shingles, is compared exactly over the whole shingle
sets. A group returns for each class the number of documents linked to it and one link towards the smallest linked class; no
link between different texts is left out of the counts. A cluster of m different near-copies costs m * m comparisons in numpy
and sends each set m / BLOCK times.

Defined results: words are taken as they are; a text of fewer than five words is a single shingle; a null text or one without
words has no shingles and no links and is a class of its own; repeated rows and copies link to each other and share a class;
the class id is the smallest id in the class, null only if all ids are null; sets are compared whole, however long; an empty
table gives no rows. Only id and text are read, so other columns can't clash.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.llm.components import components
from postlake.llm.sizes import broadcast_if_small
from postlake.llm.words import map_batches, split_words
from postlake.session import checkpointed

SHINGLE = 5
SIMILARITY = 0.8
TARGET_RECALL = 0.999
DEPTH = 3
SMALL = 32
BLOCK = 2048
BLOCK_TOKENS = 1 << 20
BOTTOM = 32
CONNECTING = 3
CACHED_WORDS = 100_000
MATRIX_CELLS = 1 << 20  # of a matrix of sets by shingles that numpy holds at once
SEED = 0x5DEECE66D


def survival(depth: int, similarity: float = SIMILARITY, common: float | None = None) -> float:
    """Chance that two sets at the threshold share a bucket of the given level in one run.

    `common` is the mean number of choices that both make: (1 + smaller / larger size) / (1 + similarity). Sets of equal
    size, the default, share most; a set that holds the other one, as large as 1 / similarity, shares least, which is 1.
    """
    common = 2 / (1 + similarity) if common is None else common
    chance = 1.0
    for _ in range(depth):
        chance = 1 - math.exp(-common * chance)
    return chance


def runs_for(target: float = TARGET_RECALL, depth: int = DEPTH, similarity: float = SIMILARITY) -> int:
    """Runs that reach the target for sets of any two sizes."""
    return math.ceil(math.log(1 - target) / math.log(1 - survival(depth, similarity, common=1.0)))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted, distinct 64-bit hashes of the shingles of a text."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = split_words(text)
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        known = self.known
        for word in set(words):
            if word not in known:
                known[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        hashes = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        length = min(SHINGLE, len(words))
        if not length:
            return hashes
        rolled = np.full(len(words) - length + 1, length, dtype=np.uint64)
        for at in range(length):
            rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[at : at + len(rolled)]
        return np.unique(mixed(rolled))


def odd(keys: np.ndarray) -> np.ndarray:
    return mixed(keys ^ np.uint64(SEED)) | np.uint64(1)


def children(tokens: np.ndarray, nodes: np.ndarray, most: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """The tokens that each node chooses, as (position of the node, key of the child)."""
    at, keys = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint64)]
    rows = max(1, MATRIX_CELLS // len(tokens))
    for start in range(0, len(nodes), rows):
        part = nodes[start : start + rows]
        parent, token = np.nonzero(tokens[None, :] * odd(part)[:, None] < most)
        at.append(parent + start)
        keys.append(mixed(part[parent] * np.uint64(0x9E3779B97F4A7C15) + tokens[token]))
    return np.concatenate(at), np.concatenate(keys)


def chosen_paths(tokens: np.ndarray, runs: int) -> list[np.ndarray]:
    """Bucket keys of a set: one array per level, rows aligned; 0 where a path ends before the level."""
    share = SIMILARITY * len(tokens)
    most = np.uint64(min(2.0**64 / share, 2.0**64 - 2049)) if share > 1 else np.uint64(2**64 - 1)
    # Levels draw by keys of their own, so a path may choose a token again; that only leaves its bucket as it was.
    levels: list[np.ndarray] = [np.arange(1, runs + 1, dtype=np.uint64)]
    for _ in range(DEPTH):
        last = levels[-1]
        open_at = np.flatnonzero(last)
        parent, keys = children(tokens, last[open_at], most)
        parent = open_at[parent]
        ended = np.flatnonzero(np.bincount(parent, minlength=len(last)) == 0)
        order = np.argsort(np.concatenate((parent, ended)), kind="stable")
        rows = np.concatenate((parent, ended))[order]
        levels = [level[rows] for level in levels]
        levels.append(np.concatenate((keys, np.zeros(len(ended), dtype=np.uint64)))[order])
    kept = levels[1] != 0
    return [level[kept] for level in levels[1:]]


def firsts(keys: np.ndarray) -> np.ndarray:
    """True at the first row of each run of equal keys."""
    return np.concatenate(([True], keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=bool)


def path_type(levels: int = DEPTH) -> T.ArrayType:
    """Buckets of a level, each once and with those that a set chooses below it; the last level has keys only."""
    if levels == 1:
        return T.ArrayType(T.LongType())
    return T.ArrayType(T.StructType([T.StructField("bucket", T.LongType()), T.StructField("below", path_type(levels - 1))]))


INFO = [
    T.StructField("mark", T.BinaryType()),
    T.StructField("n", T.LongType()),
    T.StructField("bottom", T.BinaryType()),
    T.StructField("paths", path_type()),
]


def mark_of(tokens: np.ndarray) -> bytes | None:
    """128 bits that stand for the whole set."""
    return xxhash.xxh3_128_digest(tokens.tobytes()) if len(tokens) else None


def path_arrays(sets: list[np.ndarray], runs: int) -> pa.ListArray:
    """The buckets of each set as nested lists, see `path_type`."""
    paths = [chosen_paths(tokens, runs) if len(tokens) else [np.zeros(0, dtype=np.uint64)] * DEPTH for tokens in sets]
    keys = [np.concatenate([own[level] for own in paths]) for level in range(DEPTH)]
    new = [np.concatenate([firsts(own[level]) & (own[level] != 0) for own in paths]) for level in range(DEPTH)]
    # Row numbers at which the lists of a level begin, and the end of the last one.
    begins = [np.cumsum([0, *(len(own[0]) for own in paths)]), *(np.append(np.flatnonzero(x), len(x)) for x in new[:-1])]
    nested = None
    for level in reversed(range(DEPTH)):
        values = pa.array(keys[level][new[level]].view(np.int64))
        if nested is not None:
            values = pa.StructArray.from_arrays([values, nested], names=["bucket", "below"])
        before = np.concatenate(([0], np.cumsum(new[level])))
        nested = pa.ListArray.from_arrays(pa.array(before[begins[level]], type=pa.int32()), values)
    return nested


def document_info(docs: DataFrame, runs: int) -> DataFrame:
    """doc_id, text_key, and for the shingle set: mark, n, bottom, paths. `docs` has doc_id, text_key, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler()
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                part = batch.slice(start, 128)
                sets = [shingle(text.as_py()) for text in part.column("text")]
                bottoms = [(tokens[:BOTTOM] & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() for tokens in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("text_key"),
                        pa.array([mark_of(tokens) for tokens in sets], type=pa.binary()),
                        pa.array([len(tokens) for tokens in sets], type=pa.int64()),
                        pa.array(bottoms, type=pa.binary()),
                        path_arrays(sets, runs),
                    ],
                    names=["doc_id", "text_key", *[field.name for field in INFO]],
                )

    return map_batches(docs, run, T.StructType([docs.schema["doc_id"], docs.schema["text_key"], *INFO]))


def memberships(info: DataFrame) -> DataFrame:
    """bucket, size, mark: the classes of every bucket that is to be compared."""
    paths = info.where("mark IS NOT NULL").select("mark", "paths").dropDuplicates(["mark"])
    rows = paths.select("mark", F.inline("paths"))
    parts = []
    for level in range(1, DEPTH + 1):
        own = rows.select("mark", "bucket")
        sizes = checkpointed(own.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"))
        last = level == DEPTH
        compared = sizes if last else sizes.where(F.col("size") <= SMALL)
        parts.append(own.join(compared, "bucket"))
        if not last:
            # A set goes once into a bucket that is split and takes all it has chosen below along.
            split = broadcast_if_small(sizes.where(F.col("size") > SMALL).select("bucket"))
            opened = checkpointed(rows.where(F.size("below") > 0).join(split, "bucket", "left_semi"))
            below = F.inline("below") if level + 1 < DEPTH else F.explode("below").alias("bucket")
            rows = opened.select("mark", below)
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged


def pairs_of_blocks(rows: DataFrame, first: Column, last: Column) -> DataFrame:
    """`rows`, which have a `block`, once for each block from `first` to `last`; i and j name the pair."""
    return (
        rows.withColumn("other", F.explode(F.sequence(first.cast("int"), last.cast("int"))))
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
        .drop("other")
    )


def dealt(member: str, key: str, blocks: Column) -> Column:
    """A block out of `blocks` for a member, by a hash that differs from key to key."""
    return F.pmod(F.xxhash64(member, key, F.lit(3)), blocks).cast("int")


def connecting_groups(buckets: DataFrame) -> DataFrame:
    """Every class in its largest buckets, large ones cut into blocks; every class is a cluster of its own."""
    largest = Window.partitionBy("mark").orderBy(F.desc("size"), "bucket")
    chosen = buckets.withColumn("place", F.row_number().over(largest)).where(F.col("place") <= CONNECTING)
    rows = chosen.withColumn("block", dealt("mark", "bucket", F.ceil(F.col("size") / BLOCK)))
    return rows.select(F.col("bucket").alias("key"), F.col("block").alias("i"), F.col("block").alias("j"), "block", "mark",
                       F.col("mark").alias("cluster"))


def remaining_groups(buckets: DataFrame, clusters: DataFrame) -> DataFrame:
    """The buckets that hold several clusters.

    A large bucket is cut into blocks of its largest cluster and blocks of the rest; two of the former are never paired.
    """
    rows = checkpointed(
        buckets.select("bucket", "mark")
        .join(broadcast_if_small(clusters), "mark", "left")
        .select("bucket", "mark", F.coalesce("cluster", "mark").alias("cluster"))
    )
    held = rows.groupBy("bucket", "cluster").agg(F.count("*").alias("held")).groupBy("bucket")
    mixed = held.agg(F.max(F.struct("held", "cluster")).alias("most"), F.sum("held").alias("size"), F.count("*").alias("clusters"))
    mixed = mixed.where("clusters > 1").select("bucket", "size", "most")
    whole = F.col("size") <= BLOCK
    own = F.when(whole, 0).otherwise(F.ceil(F.col("most.held") / BLOCK))
    others = F.when(whole, 1).otherwise(F.ceil((F.col("size") - F.col("most.held")) / BLOCK))
    inside = ~whole & (F.col("cluster") == F.col("most.cluster"))
    laid = (
        rows.join(mixed, "bucket")
        .withColumn("own", own)
        .withColumn("others", others)
        .withColumn(
            "block",
            F.when(inside, dealt("mark", "bucket", F.greatest("own", F.lit(1)))).otherwise(
                F.col("own").cast("int") + dealt("mark", "bucket", F.col("others"))
            ),
        )
        .withColumn("first", F.when(inside, F.col("own")).otherwise(0))
    )
    groups = pairs_of_blocks(laid, F.col("first"), F.col("own") + F.col("others") - 1)
    return groups.select(F.col("bucket").alias("key"), "i", "j", "block", "mark", "cluster")


def exact_groups(members: DataFrame) -> DataFrame:
    """Each cluster as pairs of blocks, bounded by members and by shingles. `members` has mark, cluster, copies, n."""
    sizes = members.groupBy("cluster").agg(F.count("*").alias("size"), F.sum("n").alias("volume"))
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("volume") / BLOCK_TOKENS))
    laid = members.join(sizes, "cluster").withColumn("blocks", blocks).withColumn("block", dealt("mark", "cluster", F.col("blocks")))
    groups = pairs_of_blocks(laid, F.lit(0), F.col("blocks") - 1)
    return groups.select(F.col("cluster").alias("key"), "i", "j", "block", "mark", "copies")


def grouped(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[list[tuple]]:
    """Rows of equal key, i and j, which come first and follow each other, without these three columns."""
    current, key = [], None
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            keys = zip(*[part.column(name).to_pylist() for name in ("key", "i", "j")])
            for own, row in zip(keys, zip(*[part.column(name).to_pylist() for name in names])):
                if own != key and current:
                    yield current
                    current = []
                key = own
                current.append(row)
    if current:
        yield current


def two_sides(group: list[tuple], block: int, mark: int) -> tuple[list[tuple], list[tuple]]:
    """The members of a group's two blocks in the order of their marks, each once; twice the same where there is one block."""
    members = sorted({row[mark]: row for row in group}.values(), key=lambda row: row[mark])
    first = min(row[block] for row in members)
    left, right = [row for row in members if row[block] == first], [row for row in members if row[block] != first]
    return left, right or left


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of a set on the left and one on the right, by matrix products over shared tokens."""
    own = [np.concatenate(sets) for sets in (left, right)]
    shared = np.intersect1d(*own)
    total = np.zeros((len(left), len(right)), dtype=np.float32)
    cells = []
    for sets, tokens in zip((left, right), own):
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        column = np.searchsorted(shared, tokens)
        found = np.flatnonzero(shared[np.minimum(column, len(shared) - 1)] == tokens) if len(shared) else column[:0]
        found = found[np.argsort(column[found], kind="stable")]
        cells.append((owner[found], column[found], len(sets)))
    width = max(1, min(len(shared), MATRIX_CELLS // max(len(left), len(right))))
    for start in range(0, len(shared), width):
        parts = []
        for owner, column, size in cells:
            a, b = np.searchsorted(column, (start, start + width))
            part = np.zeros((size, width), dtype=np.float32)
            part[owner[a:b], column[a:b] - start] = 1.0
            parts.append(part)
        total += parts[0] @ parts[1].T
    return total


def joined(linked: np.ndarray, left: np.ndarray, right: np.ndarray, size: int) -> np.ndarray:
    """For each of `size` nodes the smallest node connected to it; `left` and `right` are the nodes of the rows and columns."""
    roots = np.arange(size, dtype=np.int32)
    while True:
        of_left, of_right = roots[left], roots[right]
        new = roots.copy()
        np.minimum.at(new, left, np.where(linked, of_right[None, :], np.int32(size)).min(axis=1))
        np.minimum.at(new, right, np.where(linked, of_left[:, None], np.int32(size)).min(axis=0))
        # Where a root has found a smaller one, everything below it follows.
        np.minimum.at(new, roots, new)
        new = new[new]
        if (new == roots).all():
            return roots
        roots = new


def size_fits(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.minimum(left[:, None], right[None, :]) >= SIMILARITY * np.maximum(left[:, None], right[None, :]) - 1e-9


LINK = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def likely_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between clusters whose members look similar in a group, from each to the smallest one."""
    links: list[tuple[bytes, bytes]] = []
    for group in grouped(batches, ["block", "mark", "cluster", "n", "bottom"]):
        left, right = two_sides(group, 0, 1)
        names = sorted({row[2] for row in left} | {row[2] for row in right})
        if len(names) > 1:
            number = {name: at for at, name in enumerate(names)}
            sides = [[np.frombuffer(row[4], "<u4") for row in side] for side in (left, right)]
            lengths = [np.array([len(x) for x in side]) for side in sides]
            sizes = [np.array([row[3] for row in side], dtype=np.float64) for side in (left, right)]
            nodes = [np.array([number[row[2]] for row in side]) for side in (left, right)]
            distinct = [[np.unique(x) for x in side] for side in sides]
            alike = common_counts(*distinct) >= 0.5 * np.minimum(lengths[0][:, None], lengths[1][None, :])
            roots = joined(alike & size_fits(*sizes), *nodes, len(names))
            links += [(names[at], names[root]) for at, root in enumerate(roots.tolist()) if root != at]
        if len(links) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(x, type=pa.binary()) for x in zip(*links)], schema=LINK)
            links = []
    if links:
        yield pa.RecordBatch.from_arrays([pa.array(x, type=pa.binary()) for x in zip(*links)], schema=LINK)


EXACT = pa.schema([("mark", pa.binary()), ("links", pa.int64()), ("root", pa.binary())])


def exact_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each class of a group, the documents linked to it within the group's pair of blocks and the smallest class that
    it is connected to."""
    rows: list[tuple] = []
    for group in grouped(batches, ["block", "mark", "copies", "tokens"]):
        left, right = two_sides(group, 0, 1)
        sets = [[np.frombuffer(row[3], "<u8") for row in side] for side in (left, right)]
        sizes = [np.array([len(tokens) for tokens in side], dtype=np.float32) for side in sets]
        copies = [np.array([row[2] for row in side], dtype=np.int64) for side in (left, right)]
        least = np.add.outer(*(size.astype(np.float64) * SIMILARITY / (1 + SIMILARITY) for size in sizes)) - 1e-6
        linked = common_counts(*sets) >= least
        members = left if left is right else left + right
        nodes = np.arange(len(members))
        if left is right:
            np.fill_diagonal(linked, False)
            roots, links = joined(linked, nodes, nodes, len(members)), linked @ copies[1]
        else:
            # Roots are named by the smallest mark of the group, so nodes are numbered in the order of marks.
            order = sorted(range(len(members)), key=lambda at: members[at][1])
            members = [members[at] for at in order]
            place = np.empty(len(order), dtype=np.int64)
            place[order] = nodes
            roots = joined(linked, place[: len(left)], place[len(left) :], len(members))
            links = np.concatenate((linked @ copies[1], copies[0] @ linked))[order]
        rows += [(row[1], int(links[at]), members[roots[at]][1]) for at, row in enumerate(members)]
        if len(rows) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip(zip(*rows), EXACT)], schema=EXACT)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip(zip(*rows), EXACT)], schema=EXACT)


def by_group(rows: DataFrame, run: Callable, schema: str) -> DataFrame:
    return map_batches(rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j"), run, schema)


def shingle_sets(docs: DataFrame) -> DataFrame:
    """mark and tokens of `docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler()
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                sets = [shingle(text.as_py()) for text in batch.column("text").slice(start, 128)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([mark_of(tokens) for tokens in sets], type=pa.binary()),
                        pa.array([tokens.tobytes() for tokens in sets], type=pa.binary()),
                    ],
                    names=["mark", "tokens"],
                )

    return map_batches(docs.select("text"), run, "mark binary, tokens binary")


def likely_clusters(buckets: DataFrame, info: DataFrame) -> DataFrame:
    """mark and cluster of every class that looks similar to another one."""
    buckets = checkpointed(buckets)
    sketches = checkpointed(info.where("mark IS NOT NULL").select("mark", "n", "bottom").dropDuplicates(["mark"]))

    def linked(groups: DataFrame) -> DataFrame:
        found = checkpointed(by_group(groups.join(sketches, "mark"), likely_links, "a binary, b binary"))
        return components(found)

    first = linked(connecting_groups(buckets)).select(F.col("node").alias("mark"), F.col("root").alias("cluster"))
    second = linked(remaining_groups(buckets, first))
    # A cluster bears the name of one of its classes; a node that is none was a class by itself until now.
    named = first.unionByName(second.select(F.col("node").alias("mark"), F.col("node").alias("cluster"))).distinct()
    return named.join(second.withColumnRenamed("node", "cluster"), "cluster", "left").select(
        "mark", F.coalesce("root", "cluster").alias("cluster")
    )


def similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", target_recall: float = TARGET_RECALL) -> DataFrame:
    """doc_id, text_key, class_id, n_links, copies: one row per document.

    `n_links` counts the other documents that are linked to it, copies included; `class_id` names everything connected by
    links; `copies` counts the documents with the same set of shingles, itself included.
    """
    texts = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_key"), F.col(text).cast("string").alias("text")
    )
    info = checkpointed(document_info(texts, runs_for(target_recall)))
    classes = checkpointed(
        info.where("mark IS NOT NULL")
        .groupBy("mark")
        .agg(
            F.count("*").alias("copies"),
            F.min("doc_id").alias("least"),
            F.min(F.struct("doc_id", "text_key")).alias("shown"),
            F.max("n").alias("n"),
        )
    )

    clusters = likely_clusters(memberships(info), info)
    members = checkpointed(clusters.join(classes, "mark").select("mark", "cluster", "copies", "n", "shown"))
    shown = broadcast_if_small(members.select(F.col("shown").alias("key")).distinct())
    wanted = texts.withColumn("key", F.struct("doc_id", "text_key")).join(shown, "key", "left_semi")
    sets = shingle_sets(wanted).dropDuplicates(["mark"])
    groups = exact_groups(members.select("mark", "cluster", "copies", "n"))
    exact = checkpointed(by_group(groups.join(sets, "mark"), exact_links, "mark binary, links long, root binary"))

    roots = components(exact.where("mark != root").select(F.col("mark").alias("a"), F.col("root").alias("b")))
    found = exact.groupBy("mark").agg(F.sum("links").alias("links"))
    named = (
        classes.join(roots.withColumnRenamed("node", "mark"), "mark", "left")
        .join(found, "mark", "left")
        .select("mark", "copies", "least", F.coalesce("root", "mark").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    )
    class_ids = named.groupBy("root").agg(F.min("least").alias("class_id"))
    named = named.join(class_ids, "root").select("mark", "copies", "links", "class_id")
    return info.select("doc_id", "text_key", "mark").join(named, "mark", "left").select(
        "doc_id",
        "text_key",
        F.when(F.col("mark").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("copies"),
    )


def leaders(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class: the one with the class id, columns unchanged.

    Rows that share their id with another row are told apart by a hash of the whole row; of rows that are equal in every
    column one stays. Documents without words are classes of their own and stay, and so do rows without an id that link to
    nothing.
    """
    rows = docs.select(
        F.struct(F.col(doc_id).alias("id"), F.xxhash64(*docs.columns).alias("hash")).alias("key"),
        F.col(text).alias("text"),
        F.struct(*docs.columns).alias("row"),
    )
    found = checkpointed(similar(rows, "key", "text").select("doc_id", "class_id"))
    # The id of a class is its smallest (id, hash), so exactly the rows that are their own class id lead.
    lost = found.where(F.col("doc_id") != F.col("class_id")).select(F.col("doc_id").alias("key")).distinct()
    kept = rows.drop("text").join(broadcast_if_small(lost), "key", "left_anti")
    repeated = checkpointed(found.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("key")))
    if not repeated.isEmpty():
        single = kept.join(repeated, "key", "left_anti")
        kept = single.unionByName(kept.join(repeated, "key", "left_semi").dropDuplicates(["key"]))
    return kept.select("row.*")
