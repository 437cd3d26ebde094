"""A search index over titles and authors: posting lists of character trigrams.

For every post the distinct trigrams of the lower-cased texts are written, in folders by a hash of the trigram and sorted by it,
so a search reads a few row groups of a few files. A search term is found only in posts that have all its trigrams. The
rarest lists are intersected, and the posts that remain are verified with the search's own condition, so the result is the same
as that of a scan. Up to MOST_KEYS keys become ranges that prune the scan of the posts, which pays where posts lie in the order of
their keys; more keys are joined. Where no trigram is rare, or the term is shorter than a trigram, the posts are scanned.

The index grows by entries: each batch of new or changed posts writes lists and counts of its own under a name, which a replay
overwrites. Posts that are gone or have changed since need no upkeep, as what the lists name is verified; `compact_index`
makes one entry of all. Counts may then count a post more than once, which only decides what is looked up.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.functions.columns import matches_search
from postlake.operators.kept_counts import ENTRY
from postlake.session import checkpointed

GRAM = 3
BUCKETS = 64
MOST_LISTS = 3  # the rarest lists that are intersected
RARE_SHARE = 0.2  # of the posts that a rarest list may hold; beyond it a scan reads less
MOST_KEYS = 1000  # that are looked up by ranges instead of a join
RANGES = 32
TASK_ROWS = 500_000  # of lists that one task sorts and writes
SEARCHED = ("title", "author")
WHOLE = ""  # the count of this gram is the number of posts


def grams(text: Column) -> Column:
    """The trigrams of a text in lower case, repeats included; none if it is null or shorter."""
    lower = F.lower(text)
    starts = F.sequence(F.lit(1), F.length(lower) - (GRAM - 1))
    return F.when(F.length(lower) >= GRAM, F.transform(starts, lambda at: lower.substr(at, F.lit(GRAM)))).otherwise(
        F.array().cast("array<string>")
    )


def bucket_of(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def build_index(posts: DataFrame, path: str, key: str, columns: Sequence[str] = SEARCHED, entry: str = "built") -> None:
    """Write the lists of `posts`, in which `key` is unique where it is set, as one entry of the index; an entry of that name is overwritten.

    Lists are spread by ranges of trigram and key, so a trigram that nearly every post has is written by many tasks. A post
    can be found once its entry is whole.
    """
    all_grams = F.array_distinct(F.flatten(F.array(*[grams(F.col(name)) for name in columns])))
    held = posts.agg(F.count(F.lit(1)).alias("posts"), F.sum(F.size(all_grams)).alias("rows")).collect()[0]
    rows = posts.select(F.col(key).alias("key"), F.explode(all_grams).alias("gram")).withColumn("bucket", bucket_of(F.col("gram")))
    whole = posts.sparkSession.range(1).select(F.lit(held["posts"]).cast("long").alias("posts"))
    write_entry(in_ranges(rows, held["rows"] or 0), whole, path, entry)


def in_ranges(lists: DataFrame, rows: int) -> DataFrame:
    """Ranges of bucket, trigram and key, as many as `rows` need: sorted lists shrink so much that their bytes tell little of their memory."""
    return lists.repartitionByRange(max(1, math.ceil(rows / TASK_ROWS)), "bucket", "gram", "key")


def write_entry(lists: DataFrame, whole: DataFrame, path: str, entry: str) -> None:
    """Lists that lie in ranges of bucket, trigram and key, their lengths and the number of posts."""
    spark, held_by = lists.sparkSession, f"{ENTRY}={entry}"
    ordered = lists.sortWithinPartitions("bucket", "gram", "key")
    ordered.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/lists/{held_by}")
    written = spark.read.schema("gram string").parquet(f"{path}/lists/{held_by}")
    held = written.groupBy("gram").agg(F.count(F.lit(1)).alias("posts"))
    counts = held.unionByName(whole.withColumn("gram", F.lit(WHOLE)))
    ordered_counts = counts.repartitionByRange("gram").sortWithinPartitions("gram")
    ordered_counts.write.mode("overwrite").parquet(f"{path}/counts/{held_by}")


def compact_index(spark: SparkSession, path: str, target: str, entry: str = "compacted") -> None:
    """All entries as a single one in a new folder, each post once per list."""
    lists = spark.read.parquet(f"{path}/lists").select("bucket", "gram", "key")
    whole = spark.read.parquet(f"{path}/counts").filter(F.col("gram") == WHOLE).agg(F.sum("posts").alias("posts"))
    write_entry(in_ranges(lists, lists.count()).distinct(), whole, target, entry)


def rarest_lists(spark: SparkSession, path: str, term: str) -> list[str] | None:
    """The trigrams to look up; none if a trigram occurs nowhere, None if a scan is better."""
    own = spark.range(1).select(F.array_distinct(grams(F.lit(term))).alias("grams")).collect()[0]["grams"]
    if not own:
        return None
    held = spark.read.parquet(f"{path}/counts").filter(F.col("gram").isin([*own, WHOLE]))
    rows = held.groupBy("gram").agg(F.sum("posts").alias("posts")).collect()  # one per trigram of the term
    counts = {row["gram"]: row["posts"] for row in rows}
    if any(gram not in counts for gram in own):
        return []
    by_rarity = sorted(own, key=lambda gram: (counts[gram], gram))
    return by_rarity[:MOST_LISTS] if counts[by_rarity[0]] <= RARE_SHARE * counts[WHOLE] else None


def listed_keys(spark: SparkSession, path: str, chosen: Sequence[str]) -> DataFrame:
    """The keys that stand in every one of the lists."""
    # Constants, which Spark folds before it lists the folders.
    buckets = [bucket_of(F.lit(gram)) for gram in chosen]
    lists = spark.read.parquet(f"{path}/lists").filter(F.col("bucket").isin(buckets) & F.col("gram").isin(chosen))
    # A post may stand in a list more than once, so lists are marked, not counted.
    mark = F.coalesce(*[F.when(F.col("gram") == gram, F.lit(1 << at)) for at, gram in enumerate(chosen)])
    found = lists.filter("key IS NOT NULL").groupBy("key").agg(F.bit_or(mark).alias("marks")).filter(F.col("marks") == (1 << len(chosen)) - 1)
    return found.select("key")


def key_ranges(keys: Sequence, kind: T.DataType, most: int = RANGES) -> list[tuple]:
    """First and last key of at most `most` ranges that hold all keys: whole numbers are cut at the widest gaps, others evenly."""
    ordered = sorted(keys)
    places = range(1, len(ordered))
    if isinstance(kind, T.IntegralType):
        cuts = sorted(sorted(places, key=lambda at: ordered[at - 1] - ordered[at])[: most - 1])
    else:
        cuts = list(places)[-(-len(ordered) // most) - 1 :: -(-len(ordered) // most)]
    return [(ordered[a], ordered[b - 1]) for a, b in zip([0, *cuts], [*cuts, len(ordered)])]


def among(column: Column, keys: Sequence, kind: T.DataType) -> Column:
    """`column` is one of `keys`, with ranges that the scan can be pruned by."""
    within = F.lit(False)
    for first, last in key_ranges(keys, kind) if keys else []:
        within = within | column.between(F.lit(first).cast(kind), F.lit(last).cast(kind))
    return within & column.isin([F.lit(value).cast(kind) for value in keys])


def search_indexed(
    posts: DataFrame, path: str, term: str, key: str, columns: Sequence[str] = SEARCHED
) -> DataFrame:
    """The rows of `posts` whose title or author contains `term`, by the index at `path`. Rows without a key are scanned for."""
    spark = posts.sparkSession
    verified = matches_search(term, *columns)
    chosen = rarest_lists(spark, path, term)
    if chosen is None:
        return posts.filter(verified)
    if not chosen:
        return posts.filter(F.lit(False))
    wanted = checkpointed(listed_keys(spark, path, chosen).withColumnRenamed("key", key))
    few = [row[0] for row in wanted.limit(MOST_KEYS + 1).collect()]
    if len(few) <= MOST_KEYS:
        return posts.filter((F.col(key).isNull() | among(F.col(key), few, posts.schema[key].dataType)) & verified)
    named = posts.join(wanted, key, "left_semi").select(*posts.columns)
    return named.unionAll(posts.filter(F.col(key).isNull())).filter(verified)
