"""Source divergence audit: how the vocabulary of each source differs from that of the other sources of its language.

Groups (language and source) and terms are 64-bit digests while they are counted. A task adds up its own counts, in memory of
a fixed size, and writes for each group and digest the occurrences and documents, and beside them each term once. What is
aggregated and joined after that reads and shuffles digests only. Terms come back late: of each kept digest the smallest and
the largest term are compared. Where they differ, several terms share the digest; the texts are then read again for the rows
of such digests with their terms, which are split and counted anew under the digest and a number for each term. At the end the
text is joined to the few terms that are returned. Groups get another seed until no two of them share a digest.

Divergence is worked out in blocks of kept terms, `BLOCK_CELLS` cells of sources by terms, in integers throughout. A block
returns the partial sum of each pair of sources, and of each source its highest terms, ties included; sums and ranks are then
made over all blocks. So neither a language nor a source nor a term is ever gathered in one task.

Defined results: null text, language and source are read as empty strings; a text without terms adds nothing, but its language
and source are a group; repeated rows count each; with no kept term all pairs have the value 0; ties in value are ordered by
the bytes of the item; an empty table gives no rows; texts are counted whole. Counts are exact while a language has fewer than
9e15 occurrences. Only text, language and source are read, so other columns can't clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.llm.sizes import MOST_ROWS, broadcast_if_small
from postlake.llm.words import map_batches, portions
from postlake.operators.maintenance import drop_folder
from postlake.session import checkpointed, shared_folder

# Fixed value: terms are runs of ASCII letters and of anything beyond ASCII; bytes of UTF-8 give the same runs as code points.
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LEAST_DOCUMENTS = 10
MOST_RANKS = 10
SMOOTHING = 2
UNIT_STEP, UNIT_STEPS = 1000, 3  # shares are counted in units of 1000 ** 3
DIGEST_BITS = 64
PORTION_BYTES = 2_000_000
CACHED_TERMS = 300_000
PENDING_ROWS = 1_000_000  # of group and term that a task adds up at a time
ROWS_PER_BATCH = 100_000
BLOCK_CELLS = 1 << 16
LEAST_WIDTH = 32  # sources that a block is laid out for at least
KEY = ["lang", "digest", "split"]
# Counts have no term; rows with a term spell a digest; where counts are asked for by term, they have all columns.
COUNTED = "group long, digest long, n long, docs long, term binary"
LOW = np.int64((1 << 32) - 1)


class Tally:
    """Occurrences and documents by group and term, added up until there are PENDING_ROWS of them or too many terms."""

    def __init__(self, bits: int, wanted: set[int] | None = None):
        self.mask, self.wanted = (1 << bits) - 1, wanted
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.digests: list[int] = []
        self.groups: dict[int, int] = {}
        self.pending: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.rows = 0

    def add(self, groups: list[int], texts: list[bytes]) -> None:
        split = [TERM.findall(text.lower()) for text in texts]  # bytes.lower changes A-Z only
        terms = list(chain.from_iterable(split))
        for term in set(terms).difference(self.numbers):
            self.numbers[term] = len(self.digests)
            self.digests.append((xxhash.xxh3_64_intdigest(term) & self.mask) - (1 << 63))
        numbers = np.fromiter(map(self.numbers.__getitem__, terms), dtype=np.int64, count=len(terms))
        owner = np.repeat(np.arange(len(texts)), [len(own) for own in split])
        if self.wanted is not None:
            here = np.array([digest in self.wanted for digest in self.digests], dtype=bool)[numbers]
            numbers, owner = numbers[here], owner[here]
        # One row per document and term, then one per group and term.
        keys, times = np.unique(owner << 32 | numbers, return_counts=True)
        group = np.array([self.groups.setdefault(g, len(self.groups)) for g in groups], dtype=np.int64)
        self.hold(group[keys >> 32] << 32 | keys & LOW, times, np.ones(len(keys), dtype=np.int64))
        if self.rows > PENDING_ROWS:
            self.hold(*map(np.concatenate, zip(*self.pending)), afresh=True)

    def hold(self, keys: np.ndarray, n: np.ndarray, docs: np.ndarray, afresh: bool = False) -> None:
        if afresh:
            self.pending, self.rows = [], 0
        keys, at = np.unique(keys, return_inverse=True)
        sums = [np.bincount(at, weights=x, minlength=len(keys)).astype(np.int64) for x in (n, docs)]
        self.pending.append((keys, *sums))
        self.rows += len(keys)

    def full(self) -> bool:
        return self.rows > PENDING_ROWS // 2 and len(self.pending) == 1 or len(self.digests) > CACHED_TERMS

    def flush(self, with_terms: bool) -> Iterator[pa.RecordBatch]:
        if self.pending:
            self.hold(*map(np.concatenate, zip(*self.pending)), afresh=True)
            (keys, n, docs), digests = self.pending[0], np.array(self.digests, dtype=np.int64)
            terms, groups = list(self.numbers), np.array(list(self.groups), dtype=np.int64)
            for start in range(0, len(keys), ROWS_PER_BATCH):
                part = slice(start, start + ROWS_PER_BATCH)
                number = keys[part] & LOW
                spelled = [terms[x] for x in number.tolist()] if with_terms else [None] * len(number)
                columns = groups[keys[part] >> 32], digests[number], n[part], docs[part]
                yield batch_of(*[pa.array(x) for x in columns], pa.array(spelled, type=pa.binary()))
            if not with_terms:
                empty = pa.nulls(len(terms), pa.int64())
                yield batch_of(empty, pa.array(digests), empty, empty, pa.array(terms, type=pa.binary()))
        self.clear()


def batch_of(*columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), names=["group", "digest", "n", "docs", "term"])


def counted_terms(rows: DataFrame, bits: int = DIGEST_BITS, with_terms: bool = False, wanted: set[int] | None = None) -> DataFrame:
    """Rows of COUNTED from `rows` with group and text (binary); `wanted` restricts them to some digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(bits, wanted)
        for batch in batches:
            groups, first = batch.column("group").to_pylist(), 0
            for texts in portions(batch.column("text"), PORTION_BYTES):
                tally.add(groups[first : first + len(texts)], texts)
                first += len(texts)
                if tally.full():
                    yield from tally.flush(with_terms)
        yield from tally.flush(with_terms)

    return map_batches(rows, run, COUNTED)


def with_group_digests(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`rows` with `group`, and the groups: group, lang, source."""
    named = rows.select("lang", "source").distinct()
    for seed in count():
        group = F.xxhash64(F.lit(seed), "lang", "source")
        groups = checkpointed(named.withColumn("group", group))
        if groups.groupBy("group").count().where("count > 1").isEmpty():
            return rows.withColumn("group", group), groups


def shares(counts: np.ndarray, total: int | np.ndarray, kept: int) -> np.ndarray:
    """1 + floor(10**9 * (count + 2) / (total + 2 * kept)), by long division, so that nothing overflows."""
    below = np.asarray(total + SMOOTHING * kept, dtype=np.int64)
    rest = np.asarray(counts, dtype=np.int64) + SMOOTHING
    out = np.zeros(np.broadcast_shapes(rest.shape, below.shape), dtype=np.int64)
    for _ in range(UNIT_STEPS):
        rest = rest * UNIT_STEP
        out = out * UNIT_STEP + rest // below
        rest = rest % below
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    apart = p - q
    return apart * apart // (p + q)


FOUND = pa.schema(
    [("lang", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("digest", pa.int64()), ("split", pa.int64()), ("value", pa.int64())]
)


def compared(key: tuple, terms: pa.Table, sources: pa.Table) -> pa.Table:
    """Of a block: partial sums of pairs of sources (a < b), and the highest terms of each source (b is null)."""
    size = sources.num_rows
    order = np.argsort(sources.column("no").to_numpy())
    total = sources.column("total").to_numpy()[order]
    lang_total, kept = sources.column("lang_total")[0].as_py(), sources.column("kept")[0].as_py()
    no, digest, split, n, lang_n = (terms.column(c).to_numpy() for c in ("no", "digest", "split", "n", "lang_n"))
    by_term = np.lexsort((split, digest))
    no, digest, split, n, lang_n = (x[by_term] for x in (no, digest, split, n, lang_n))
    first = np.ones(len(no), dtype=bool)
    first[1:] = (digest[1:] != digest[:-1]) | (split[1:] != split[:-1])
    term, starts = np.cumsum(first) - 1, np.flatnonzero(first)

    held = np.zeros((size, len(starts)), dtype=np.int64)
    held[no, term] = n
    own = shares(held, total[:, None], kept)
    pairs_a, pairs_b, sums = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a in range(size - 1):
        pairs_a.append(np.full(size - 1 - a, a))
        pairs_b.append(np.arange(a + 1, size))
        sums.append(divergence(own[a], own[a + 1 :]).sum(axis=1))

    p, q = own[no, term], shares(lang_n, lang_total, kept)
    above = np.flatnonzero(p > q)
    above = above[np.lexsort((-divergence(p[above], q[above]), no[above]))]
    value, owner = divergence(p[above], q[above]), no[above]
    if len(above):
        begin = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        group = np.cumsum(np.concatenate(([True], owner[1:] != owner[:-1]))) - 1
        last = np.minimum(begin + MOST_RANKS, np.append(begin[1:], len(owner))) - 1
        high = value >= value[last][group]
        above, value, owner = above[high], value[high], owner[high]

    a, b, sums = np.concatenate(pairs_a), np.concatenate(pairs_b), np.concatenate(sums)
    rows = len(a) + len(above)
    return pa.table(
        [
            pa.array([key[0].as_py()] * rows, type=pa.string()),
            pa.array(np.concatenate((a, owner)), type=pa.int64()),
            pa.concat_arrays([pa.array(b, type=pa.int64()), pa.nulls(len(above), pa.int64())]),
            pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(digest[above], type=pa.int64())]),
            pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(split[above], type=pa.int64())]),
            pa.array(np.concatenate((sums, value)), type=pa.int64()),
        ],
        schema=FOUND,
    )


def kept_counts(counts: DataFrame, groups: DataFrame, least: int) -> DataFrame:
    """`counts` of the terms in at least so many documents of their language, with the language's occurrences."""
    same = Window.partitionBy(*KEY)
    langs = broadcast_if_small(groups.select("group", "lang"))
    whole = counts.join(langs, "group").withColumn("lang_n", F.sum("n").over(same)).withColumn("lang_docs", F.sum("docs").over(same))
    return whole.where(F.col("lang_docs") >= least).drop("docs", "lang_docs")


def split_collisions(
    rows: DataFrame, counts: DataFrame, spellings: DataFrame, bits: int
) -> tuple[DataFrame, DataFrame]:
    """`counts` and `spellings` with a number for each term wherever terms share a digest."""
    shared = checkpointed(spellings.where("least != most").select("digest"))
    few = shared.limit(MOST_ROWS + 1).count() <= MOST_ROWS
    wanted = {row["digest"] for row in shared.collect()} if few else None
    mixed = checkpointed(counted_terms(rows, bits, True, wanted).join(shared, "digest", "left_semi"))
    numbered = Window.partitionBy("digest").orderBy("term")
    variants = checkpointed(
        mixed.groupBy("digest", "term")
        .agg(F.count("*").alias("rows"))
        .select("digest", "term", F.row_number().over(numbered).cast("long").alias("split"))
    )
    apart = (
        mixed.join(broadcast_if_small(variants), ["digest", "term"])
        .groupBy("group", "digest", "split")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    single = spellings.where("least = most").select("digest", F.col("least").alias("term"), F.lit(0).cast("long").alias("split"))
    return counts.join(shared, "digest", "left_anti").unionByName(apart), single.unionByName(variants)


def audit(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_documents: int = LEAST_DOCUMENTS,
    bits: int = DIGEST_BITS,
) -> DataFrame:
    """lang, source, part, item, value, rank: part `pair` for each other source, part `term` for the highest terms."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "terms")

    def stored(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{folder}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{folder}/{name}")

    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    rows = docs.select(plain(lang).alias("lang"), plain(source).alias("source"), plain(text).cast("binary").alias("text"))
    rows, groups = with_group_digests(rows)
    rows = rows.select("group", "text")
    written = stored(counted_terms(rows, bits), "written")
    counts = written.where("term IS NULL").groupBy("group", "digest").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = stored(counts.withColumn("split", F.lit(0).cast("long")), "counts")
    kept = stored(kept_counts(counts, groups, least_documents), "kept")
    spellings = (
        written.where("term IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("term").alias("least"), F.max("term").alias("most"))
        .join(kept.select("digest").distinct(), "digest", "left_semi")
    )
    spellings = stored(spellings, "spellings")
    drop_folder(spark, f"{folder}/written")
    if spellings.where("least != most").isEmpty():
        spelled = spellings.select("digest", F.lit(0).cast("long").alias("split"), F.col("least").alias("term"))
    else:
        counts, spelled = split_collisions(rows, counts, spellings, bits)
        kept = stored(kept_counts(counts, groups, least_documents), "kept-apart")
    drop_folder(spark, f"{folder}/counts")

    result = checkpointed(ranked(compared_blocks(groups, kept), spelled))
    drop_folder(spark, folder)
    return result


def compared_blocks(groups: DataFrame, kept: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The groups with their numbers, and what the blocks return."""
    per_lang = kept.groupBy(*KEY).agg(F.max("lang_n").alias("n")).groupBy("lang")
    langs = per_lang.agg(F.count("*").alias("kept"), F.sum("n").alias("lang_total"))
    totals = kept.groupBy("group").agg(F.sum("n").alias("total"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    numbered = groups.withColumn("no", place.cast("long"))
    widths = numbered.groupBy("lang").agg(F.count("*").alias("width"))
    blocks = F.ceil(F.col("kept") * F.greatest("width", F.lit(LEAST_WIDTH)) / BLOCK_CELLS).cast("int")
    sized = (
        widths.join(langs, "lang", "left")
        .select("lang", F.coalesce("kept", F.lit(0)).alias("kept"), F.coalesce("lang_total", F.lit(0)).alias("lang_total"), "width")
        .withColumn("blocks", F.greatest(blocks, F.lit(1)))
    )
    described = checkpointed(
        numbered.join(sized, "lang").join(totals, "group", "left").withColumn("total", F.coalesce("total", F.lit(0)))
    )
    sources = described.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    places = broadcast_if_small(described.select("group", F.col("no").alias("own"), F.col("blocks").alias("parts")))
    block = F.pmod(F.xxhash64("digest", "split"), F.col("parts")).cast("int").alias("block")
    terms = kept.join(places, "group").select("lang", block, F.col("own").alias("no"), *KEY[1:], "n", "lang_n")
    found = (
        terms.groupBy("lang", "block")
        .cogroup(sources.select("lang", "block", "no", "total", "lang_total", "kept").groupBy("lang", "block"))
        .applyInArrow(compared, "lang string, a long, b long, digest long, split long, value long")
    )
    return described.select("lang", "source", "no"), checkpointed(found)


def ranked(blocks: tuple[DataFrame, DataFrame], spelled: DataFrame) -> DataFrame:
    groups, found = blocks
    names = broadcast_if_small(groups)
    own = names.withColumnRenamed("no", "a")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    columns = ["lang", "source", "part", "item", "value", F.row_number().over(by_value).alias("rank")]

    sums = found.where("b IS NOT NULL").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = sums.unionByName(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    others = names.select("lang", F.col("no").alias("b"), F.col("source").alias("item"))
    pairs = both.join(own, ["lang", "a"]).join(others, ["lang", "b"]).withColumn("part", F.lit("pair")).select(*columns)

    order = Window.partitionBy("lang", "a").orderBy(F.desc("value"))
    high = found.where("b IS NULL").withColumn("place", F.rank().over(order)).where(F.col("place") <= MOST_RANKS)
    terms = (
        high.join(spelled, ["digest", "split"])
        .join(own, ["lang", "a"])
        .withColumn("part", F.lit("term"))
        .withColumn("item", F.col("term").cast("string"))
        .select(*columns)
        .where(F.col("rank") <= MOST_RANKS)
    )
    return pairs.unionByName(terms)


ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
  FROM documents
), words AS (
  SELECT id, lang, source,
         translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM docs
), kept AS (
  SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 10
), langs AS (
  SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), held AS (
  SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept k USING (lang, term) GROUP BY ALL
), totals AS (
  SELECT lang, source, sum(n) AS total FROM held GROUP BY ALL
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n,
         CAST(1 + (1000000000::HUGEINT * (coalesce(h.n, 0) + 2)) // (coalesce(t.total, 0) + 2 * l.v) AS BIGINT) AS p,
         CAST(1 + (1000000000::HUGEINT * (k.n + 2)) // (l.total + 2 * l.v) AS BIGINT) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
  LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN held h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value
  FROM shares WHERE n > 0 AND p > q
)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
UNION ALL
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM terms
QUALIFY row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) <= 10
"""
