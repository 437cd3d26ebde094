"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact weighted verification.

A benchmark item is cut, word by word, into windows of the largest window size of a fixed ladder that still lets one of a
document's windows fall wholly inside a copy of the item; the document's windows start at every `stride(size)`-th word. So an
unchanged copy, wherever it starts, has a window whose fingerprint equals one of the item's. Each window has a 64-bit SimHash of
its words. For changed copies, fingerprints within `RADIUS` bits are searched: of the `PARTS` parts of two such fingerprints at
least one differs by no more than RADIUS // PARTS = 1 bit, and the index holds each part with all its neighbours at that
distance, so looking up every part finds all of them. A candidate names an item and the
place where its copy would start. There, the five-word shingles of the item are looked up in the document around that
place, and the item counts as found if those present hold at least `LEAST_SIMILARITY` of the weight of all. A shingle weighs
ln(1 + items / items that hold it), so wording that many items share proves less. Shingles are looked up as 64-bit hashes; what
passes is confirmed by the words themselves.

The benchmark is written once as a table of blocks of about `BLOCK_CHARS` characters; Spark counts and joins the weights.
One block at a time is fetched and made into flat numpy arrays, which are broadcast; the documents are read once for each
block, in batches, without a shuffle, and are fixed in the shared folder between two blocks, so only one index is held at a
time. A document's windows start at its own first word whatever stands before it in a batch.

Defined results: words are lower-cased and stripped of punctuation at their ends before they are compared; a null or empty
text is clean; an item without words is never found, one of fewer than five words is one shingle; equal items are each
reported; rows that repeat give equal results; texts are scanned whole, in memory proportional to a batch; empty tables give
no rows or no findings. Only id and text are read, other columns can't clash.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator, Mapping
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from postlake.llm.words import map_batches, portions, split_words
from postlake.operators.maintenance import drop_folder
from postlake.session import checkpointed, shared_folder

BITS = 64
RADIUS = 7
PARTS = 4  # RADIUS // PARTS is 1
PART_BITS = BITS // PARTS
PAIRS = 1 << 18  # of fingerprints compared at a time
SHINGLE = 5
LEAST_SIMILARITY = 0.8
STEP = 4  # words between the starts of the smallest windows
LADDER = (4, 8, 12, 16, 24, 32, 48, 64, 96)  # window sizes in words, multiples of STEP; sums fit a signed byte
BLOCK_CHARS = 500_000
PORTION_CHARS = 200_000  # of text that a task works on at a time
CACHED_WORDS = 150_000

EDGES = re.compile(r"^\W+|\W+$")
PLAIN_EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^`{|}~"  # what EDGES strips of ASCII, and faster


def stride(size: int) -> int:
    return STEP if size < 32 else 2 * STEP


def window_size(n_words: int) -> int | None:
    """The size of an item's windows; None for items so short that every place is looked at by words alone."""
    fitting = [size for size in LADDER if size + stride(size) - 1 <= n_words]
    return fitting[-1] if fitting else None


def comparable(word: str) -> str:
    return stripped(word.lower())


def stripped(lower: str) -> str:
    """A word in lower case without punctuation at its ends, unless it is nothing else."""
    plain = lower.strip(PLAIN_EDGES)
    return plain if plain.isalnum() else EDGES.sub("", lower) or lower


def shingles(words: list[str]) -> list[tuple[str, ...]]:
    if len(words) < SHINGLE:
        return [tuple(words)] if words else []
    return [tuple(words[at : at + SHINGLE]) for at in range(len(words) - SHINGLE + 1)]


def word_hashes(words: list[str]) -> np.ndarray:
    """64-bit hashes of words as they are compared."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype="<u8", count=len(words))


def shingle_hashes(hashes: np.ndarray) -> np.ndarray:
    """Hashes of the shingles that start at each word; one for all words if they are fewer than a shingle."""
    length = min(SHINGLE, len(hashes))
    rolled = np.full(len(hashes) - length + 1 if length else 0, length, dtype=np.uint64)
    for at in range(length):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[at : at + len(rolled)]
    rolled = (rolled ^ (rolled >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return rolled ^ (rolled >> np.uint64(32))


class Words:
    """Numbers of lower-case words, and for each number its hash and the hash's 64 signs; number 0 stands for no word."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.signs = np.zeros((1024, BITS), dtype=np.int8)
        self.hashes = np.zeros(1024, dtype=np.uint64)

    def __call__(self, words: list[str]) -> np.ndarray:
        known = self.numbers
        new = list(set(words).difference(known))
        if new:
            hashes = word_hashes(list(map(stripped, new)))
            first, last = len(known) + 1, len(known) + 1 + len(new)
            while last > len(self.signs):
                self.signs = np.concatenate((self.signs, np.zeros_like(self.signs)))
                self.hashes = np.concatenate((self.hashes, np.zeros_like(self.hashes)))
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).view(np.int8)
            self.signs[first:last] = 2 * bits - 1
            self.hashes[first:last] = hashes
            known.update(zip(new, range(first, last)))
        return np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))


def fingerprints(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1).view("<u8").ravel()


def sums_of(made: dict[int, np.ndarray], units: int) -> np.ndarray:
    """Sums over `units` steps from each step on, from those of its halves; `made` keeps what has been worked out."""
    if units not in made:
        half = units // 2
        left, right = sums_of(made, units - half), sums_of(made, half)
        n = max(len(made[1]) - units + 1, 0)
        made[units] = left[:n] + right[units - half : units - half + n]
    return made[units]


def ladder_sums(steps: np.ndarray, sizes: Iterable[int]) -> dict[int, np.ndarray]:
    """Sums of signs of the windows of the given sizes, by the step that they start at; built from smaller windows."""
    made = {1: steps}
    return {size: sums_of(made, size // STEP) for size in sizes}


def part_of(marks: np.ndarray, part: int) -> np.ndarray:
    return ((marks >> np.uint64(part * PART_BITS)) & np.uint64((1 << PART_BITS) - 1)).astype(np.int64)


WINDOWS = np.dtype([("mark", "<u8"), ("item", "<i4"), ("start", "<i4")])


class Index:
    """Fingerprints of a block of the benchmark, by window size and block of bits, and what verification needs, in flat arrays."""

    def __init__(self, items: list[tuple], weights: Mapping[int, float]):
        """`weights` gives the weight of a shingle by its hash."""
        words = Words()
        self.item_ids, self.texts, self.short = [], [], defaultdict(list)
        windows: dict[int, list[np.ndarray]] = defaultdict(list)
        owned = []
        for item_id, text in items:
            raw = split_words(text.lower())
            plain = [stripped(word) for word in raw]
            if not plain:
                continue
            at = len(self.item_ids)
            self.item_ids.append(item_id)
            self.texts.append(" ".join(plain))  # no word holds a space
            owned.append(np.unique(shingle_hashes(word_hashes(plain))))
            size = window_size(len(plain))
            if size is None:
                self.short[plain[0]].append((at, tuple(plain)))
                continue
            numbers = words(raw)
            signs = words.signs[numbers]
            total = np.concatenate((np.zeros((1, BITS), dtype=np.int32), np.cumsum(signs, axis=0, dtype=np.int32)))
            marks = fingerprints(total[size:] - total[:-size])
            own = np.zeros(len(marks), dtype=WINDOWS)
            own["mark"], own["item"], own["start"] = marks, at, np.arange(len(marks))
            windows[size].append(own)
        self.lengths = np.array([text.count(" ") + 1 for text in self.texts], dtype=np.int64)
        self.ends = np.cumsum([0, *map(len, owned)])
        self.shingles = np.concatenate([np.zeros(0, dtype=np.uint64), *owned])
        self.weights = np.array([weights[shingle] for shingle in self.shingles.tolist()], dtype=np.float64)
        self.windows = {size: np.concatenate(parts) for size, parts in windows.items()}
        self.tables = {}
        flips = np.array([0, *(1 << bit for bit in range(PART_BITS))], dtype=np.int64)
        for size, own in self.windows.items():
            marks = np.ascontiguousarray(own["mark"])
            lookups = []
            for part in range(PARTS):
                keys = (part_of(marks, part)[:, None] ^ flips[None, :]).ravel()
                number = (np.argsort(keys, kind="stable") // len(flips)).astype(np.int32)
                ends = np.cumsum(np.bincount(keys, minlength=1 << PART_BITS))
                lookups.append((number, np.concatenate(([0], ends)).astype(np.int32)))
            self.tables[size] = (marks, lookups)

    def near(self, size: int, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs (position in `marks`, number of an item's window) within the radius."""
        own, lookups = self.tables[size]
        places, numbers = [], []
        for part, (number_at, ends) in enumerate(lookups):
            keys = part_of(marks, part)
            first = ends[keys]
            counts = ends[keys + 1] - first
            some = np.flatnonzero(counts)
            totals = np.cumsum(counts[some], dtype=np.int64)
            begin = 0
            while begin < len(some):
                done = totals[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(totals, done + PAIRS, side="right")))
                at, count = some[begin:end], counts[some[begin:end]]
                inside = np.arange(totals[end - 1] - done) - np.repeat(totals[begin:end] - count - done, count)
                place = np.repeat(at, count)
                number = number_at[first[place] + inside]
                close = np.bitwise_count(marks[place] ^ own[number]) <= RADIUS
                places.append(place[close])
                numbers.append(number[close])
                begin = end
        if not places:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        return np.concatenate(places), np.concatenate(numbers)

    def similarity(self, item: int, there: np.ndarray, words: list[str]) -> float:
        """Share of the item's weight whose shingles are among `there`, hashes of a stretch of text; a share that counts is
        confirmed by the words of the stretch."""
        part = slice(self.ends[item], self.ends[item + 1])
        own, weights = self.shingles[part], self.weights[part]
        total = weights.sum()
        place = np.minimum(np.searchsorted(own, there), len(own) - 1)
        held = np.zeros(len(own), dtype=bool)
        held[place[own[place] == there]] = True
        share = weights[held].sum() / total
        if share < LEAST_SIMILARITY:
            return float(share)
        plain = self.texts[item].split(" ")
        weight_of = dict(zip(shingles(plain), weights[np.searchsorted(own, shingle_hashes(word_hashes(plain)))]))
        shown = set(shingles([stripped(word) for word in words]))
        return float(sum(weight for shingle, weight in weight_of.items() if shingle in shown) / total)


def find(index: Index, words: Words, texts: list[list[str]]) -> list[dict[int, float]]:
    """For each text, given as its words in lower case, the items found and their similarity."""
    found: list[dict[int, float]] = [{} for _ in texts]
    sizes = np.array([len(own) for own in texts], dtype=np.int64)
    # Every text starts on the coarser grid, so its windows are its own; 0 fills up the rest.
    steps_of = -(-sizes // (2 * STEP)) * 2
    first_of = np.cumsum(steps_of) - steps_of
    if not steps_of.sum():
        return found
    owner_of = np.repeat(np.arange(len(texts)), steps_of)
    number_of = np.zeros(int(steps_of.sum()) * STEP, dtype=np.int64)
    inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    number_of[np.repeat(first_of * STEP, sizes) + inside] = words(list(chain.from_iterable(texts)))
    steps = words.signs[number_of].reshape(-1, STEP, BITS).sum(axis=1, dtype=np.int8)
    sums = ladder_sums(steps, index.tables)
    rolled = None
    for size in index.tables:
        every = stride(size) // STEP
        marks = fingerprints(sums[size][::every]) if len(sums[size]) else np.zeros(0, dtype=np.uint64)
        if not len(marks):
            continue
        place, number = index.near(size, marks)
        begin = place * every
        at, window = owner_of[begin], index.windows[size][number]
        inside = owner_of[begin + size // STEP - 1] == at
        starts = (begin - first_of[at]) * STEP - window["start"]
        candidates = np.unique(np.stack((at, window["item"], starts), axis=1)[inside], axis=0)
        if len(candidates) and rolled is None:
            rolled = shingle_hashes(words.hashes[number_of])
        for at, item, start in candidates.tolist():
            if found[at].get(item, 0.0) < 1.0:
                n_words = int(index.lengths[item])
                slack = max(2, n_words // 8)
                low, high = max(0, start - slack), min(len(texts[at]), start + n_words + slack)
                base = int(first_of[at]) * STEP
                share = index.similarity(item, rolled[base + low : base + max(low, high - SHINGLE + 1)], texts[at][low:high])
                if share >= LEAST_SIMILARITY:
                    found[at][item] = max(share, found[at].get(item, 0.0))
    if index.short:
        for at, own in enumerate(texts):
            own = [stripped(word) for word in own]
            for place, word in enumerate(own):
                for item, whole in index.short.get(word, ()):
                    if tuple(own[place : place + len(whole)]) == whole:
                        found[at][item] = 1.0
    return found


def weighted_blocks(benchmark: DataFrame, item_id: str, text: str, folder: str) -> tuple[DataFrame, int, int]:
    """The benchmark as a table with the blocks as folders: item_id, text, and each shingle with the items that hold it;
    the number of blocks and of items."""
    spark = benchmark.sparkSession
    rows = checkpointed(
        benchmark.select(
            F.col(item_id).alias("item_id"),
            F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
            F.monotonically_increasing_id().alias("item"),
        )
    )
    size = rows.agg(F.count("*").alias("items"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).collect()[0]
    blocks = max(math.ceil(size["chars"] / BLOCK_CHARS), min(size["items"], 1))

    def exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, value in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                hashes = np.unique(shingle_hashes(word_hashes([comparable(word) for word in split_words(value)])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(hashes), type=pa.int64()), pa.array(hashes.view(np.int64))], names=["item", "shingle"]
                )

    held = checkpointed(map_batches(rows.select("item", "text"), exploded, "item long, shingle long"))
    counts = held.groupBy("shingle").agg(F.count("*").alias("items"))
    weighed = held.join(counts, "shingle").groupBy("item").agg(F.collect_list(F.struct("shingle", "items")).alias("weighed"))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1))).cast("int")
    table = rows.join(weighed, "item", "left").withColumn("block", block).repartition("block")
    table.write.partitionBy("block").parquet(folder)
    return spark.read.schema(table.schema).parquet(folder), blocks, size["items"]


def index_of(block: DataFrame, items: int) -> Index:
    rows = sorted(block.select("item", "item_id", "text", "weighed.shingle", "weighed.items").collect(), key=lambda row: row["item"])
    weights = {
        shingle & (1 << 64) - 1: math.log(1 + items / times)
        for row in rows
        for shingle, times in zip(row["shingle"] or (), row["items"] or ())
    }
    return Index([(row["item_id"], row["text"]) for row in rows], weights)


class Searcher:
    """Runs over Arrow batches of documents; the words seen are kept between batches, in bounded number."""

    def __init__(self, index: Index):
        self.index, self.words = index, Words()

    def __call__(self, column: pa.Array) -> Iterator[dict[int, float]]:
        """The findings of every text, in order; texts are taken together up to PORTION_CHARS characters."""
        for texts in portions(column, PORTION_CHARS):
            if len(self.words.numbers) > CACHED_WORDS:
                self.words.clear()
            yield from find(self.index, self.words, [split_words((text or "").lower()) for text in texts])


def block_by_block(
    rows: DataFrame, benchmark: DataFrame, item_id: str, item_text: str, search: Callable[[Index], Callable]
) -> DataFrame:
    """`rows` after a step for each block of the benchmark; between two blocks the rows are fixed and the index is dropped."""
    spark, folder = rows.sparkSession, shared_folder(rows.sparkSession, "benchmark")
    table, blocks, items = weighted_blocks(benchmark, item_id, item_text, folder)
    for block in range(blocks):
        shared = spark.sparkContext.broadcast(index_of(table.where(F.col("block") == block), items))
        rows = map_batches(rows, search(shared), rows.schema)
        if block < blocks - 1:
            rows = checkpointed(rows)
            shared.unpersist()
    drop_folder(spark, folder)
    return rows


def leaks(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, contaminated, item_ids (sorted) and the largest similarity (0 if none)."""
    item_type = benchmark.schema[item_id].dataType
    list_type = to_arrow_type(T.ArrayType(item_type))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        F.array().cast(T.ArrayType(item_type)).alias("item_ids"),
        F.lit(0.0).alias("similarity"),
    )

    def search(shared) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            searcher = Searcher(shared.value)
            for batch in batches:
                ids, best = batch.column("item_ids").to_pylist(), batch.column("similarity").to_pylist()
                for at, hits in enumerate(searcher(batch.column("text"))):
                    ids[at] = sorted([*ids[at], *(searcher.index.item_ids[item] for item in hits)], key=lambda x: (x is None, x))
                    best[at] = max(best[at], *hits.values()) if hits else best[at]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:2], pa.array(ids, type=list_type), pa.array(best, type=pa.float64())],
                    names=["doc_id", "text", "item_ids", "similarity"],
                )

        return run

    rows = block_by_block(rows, benchmark, item_id, item_text, search)
    return rows.select("doc_id", (F.size("item_ids") > 0).alias("contaminated"), "item_ids", "similarity")


def clean_rows(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The rows of `docs` without any item of the benchmark, columns unchanged."""
    place = docs.columns.index(text)

    def drop(shared) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            searcher = Searcher(shared.value)
            for batch in batches:
                keep = [not hits for hits in searcher(batch.column(place))]
                yield batch.filter(pa.array(keep, type=pa.bool_()))

        return run

    return block_by_block(docs, benchmark, item_id, item_text, drop)
