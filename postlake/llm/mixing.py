"""Mixing sources to target weights by capped water-filling and seeded repetitions.

Every source gets a weight and so a share of all words. No source may give more than `max_epochs` times what it has: such
a source is clamped there and its excess goes to the others by weight, until nothing exceeds its clamp. With `level` as
the water level, the target is the smaller of clamp and weight times level.

A target of 2.4 times the size of a source means two whole repetitions of every document and a seeded selection that
holds 0.4 of its words. The selection is a prefix of the source's documents in the order of a hash of seed, id and text;
its end (the cut) is found from two histograms over the hash and the rows of one last bin, so no task ever sorts a source.

Defined results: a null text has no words; a null source is a source of its own, last in order; documents without words
have target and take like others, but add nothing; rows repeated with id and text are taken together; an empty table gives
an empty mix. Columns of the input never clash, since only id, text and source are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.llm.sizes import MOST_ROWS, fixed_and_counted
from postlake.llm.words import count_words
from postlake.session import checkpointed

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
SEED = "mix-1"
HASH_BITS = 60
SALTS = 256
BIN_BITS = (12, 24)  # bits of the hash that the first and the second histogram look at


def seeded_hash(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """60 bits of a hash that DuckDB can repeat."""
    parts = F.concat(
        F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")))
    )
    return F.conv(F.substring(F.md5(parts), 1, HASH_BITS // 4), 16, 10).cast("long")


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: str = SEED) -> DataFrame:
    """One narrow row per document, fixed in the shared folder: the texts are read once for all that follows."""
    return checkpointed(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            count_words(F.col(text)).alias("size"),
            seeded_hash(F.col(doc_id), F.col(text), seed).alias("at"),
        )
    )


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, target, whole (full repetitions) and rest (words to select beside them).

    The windows without a key run over one row per source, after the documents are summed.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    cycle = F.array(*[F.lit(float(weight)) for weight in weights])
    rows = totals.select(
        "source",
        "source_size",
        F.element_at(cycle, (place % len(weights) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * max_epochs).cast("double").alias("clamp"),
    )
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy(F.col("clamp") / F.col("weight"), "source").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("clamp").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    # While the sources that fill up first are clamped the level rises; past the last clamped one it falls.
    target = F.least("clamp", F.col("weight") * F.max("level").over(everything))
    whole = F.when(F.col("target") >= F.col("clamp"), F.lit(max_epochs)).otherwise(
        F.floor(F.col("target") / F.col("source_size"))
    )
    return (
        rows.withColumn("level", level)
        .select("source", "source_size", target.alias("target"), "clamp")
        .withColumn("whole", whole.cast("long"))
        .select(
            "source",
            "source_size",
            "target",
            "whole",
            F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0)).alias("rest"),
        )
    )


def in_open_bins(sizes: DataFrame, open_bins: DataFrame, shift: int) -> DataFrame:
    """The rows that lie in their source's open bin; a source is spread over SALTS keys by its hash."""
    salts = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    salted = open_bins.withColumn("salt", F.explode(salts))
    rows = sizes.withColumn("salt", F.pmod("at", F.lit(SALTS)))
    return rows.join(salted, ["source_key", "salt"]).where(F.shiftright("at", shift) == F.col("bin"))


def narrowed(sizes: DataFrame, open_bins: DataFrame, shift_before: int, shift: int) -> DataFrame:
    """Of each source's open bin, the finer bin in which the running sum of sizes passes `rest`."""
    fine = (
        in_open_bins(sizes, open_bins, shift_before)
        .groupBy("source_key", "rest", "before", F.shiftright("at", shift).alias("fine"))
        .agg(F.sum("size").alias("held"))
    )
    order = Window.partitionBy("source_key").orderBy("fine")
    start = F.col("before") + F.coalesce(F.sum("held").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (
        fine.withColumn("start", start)
        .where(F.col("start") + F.col("held") > F.col("rest"))
        .groupBy("source_key", "rest")
        .agg(F.min(F.struct("fine", "start")).alias("first"))
        .select("source_key", "rest", F.col("first.fine").alias("bin"), F.col("first.start").alias("before"))
    )


def with_cuts(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """`targets` with `cut`: documents whose hash is below it are taken once more than `whole` times."""
    keyed = sizes.select(F.struct("source").alias("source_key"), "size", "at")
    wanted = targets.withColumn("source_key", F.struct("source"))
    open_bins = wanted.select("source_key", "rest", F.lit(0).cast("long").alias("bin"), F.lit(0).cast("long").alias("before"))
    shift = HASH_BITS
    for bits in BIN_BITS:
        open_bins = narrowed(keyed, open_bins, shift, HASH_BITS - bits)
        shift = HASH_BITS - bits
    open_bins = checkpointed(open_bins)
    last = (
        in_open_bins(keyed, open_bins, shift)
        .groupBy("source_key", "rest", "before", "at")
        .agg(F.sum("size").alias("held"))
    )
    order = Window.partitionBy("source_key").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("held").over(order), F.lit(0))
    passing = (
        last.withColumn("start", start)
        .where(F.col("start") + F.col("held") / 2 > F.col("rest"))
        .groupBy("source_key")
        .agg(F.min("at").alias("at"))
    )
    bin_end = F.shiftleft(F.col("bin") + 1, shift)
    ends = open_bins.join(passing, "source_key", "left").select("source_key", F.coalesce("at", bin_end).alias("end"))
    everything = F.lit(1 << HASH_BITS).cast("long")
    return (
        wanted.join(ends, "source_key", "left")
        .withColumn("cut", F.when(F.col("rest") > 0, F.coalesce("end", everything)).otherwise(F.lit(0).cast("long")))
        .drop("source_key", "end")
    )


def plan(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source, source_size, target, whole, rest, cut."""
    return checkpointed(with_cuts(sizes, checkpointed(source_targets(sizes, weights, max_epochs))))


def repetitions(at: Column) -> Column:
    return F.col("whole") + F.when(at < F.col("cut"), 1).otherwise(0)


def with_plan(rows: DataFrame, by_source: DataFrame) -> DataFrame:
    """`rows`, which have `mix_source` and `mix_at`, with the columns of their source's plan.

    The plan, one row per source, is broadcast if it is small, so the rows stay where they are; else each source is spread
    over SALTS keys by the hash.
    """
    planned = by_source.withColumn("mix_key", F.struct("source")).drop("source")
    keyed = rows.withColumn("mix_key", F.struct(F.col("mix_source").alias("source")))
    small, n = fixed_and_counted(planned)
    if n <= MOST_ROWS:
        return keyed.join(F.broadcast(small), "mix_key")
    salted = small.withColumn("mix_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return keyed.withColumn("mix_salt", F.pmod("mix_at", F.lit(SALTS))).join(salted, ["mix_key", "mix_salt"])


def mix_counts(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED, **names: str
) -> DataFrame:
    """doc_id, size, source_size, target, taken: how many words of each document the mix takes, repeats counted."""
    sizes = sized(docs, seed=seed, **names)
    rows = sizes.select("doc_id", "size", F.col("source").alias("mix_source"), F.col("at").alias("mix_at"))
    return with_plan(rows, plan(sizes, weights, max_epochs)).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * repetitions(F.col("mix_at"))).alias("taken"),
    )


def mix_rows(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED,
    doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """The mix itself: each row of `docs` as often as the plan takes it, columns unchanged."""
    sizes = sized(docs, doc_id, text, source, seed)
    own = docs.select(
        F.struct(*docs.columns).alias("mix_row"),
        F.col(source).alias("mix_source"),
        seeded_hash(F.col(doc_id), F.col(text), seed).alias("mix_at"),
    )
    times = repetitions(F.col("mix_at")).cast("int")
    return (
        with_plan(own, plan(sizes, weights, max_epochs))
        .select("mix_row", F.explode(F.array_repeat(F.lit(0), times)).alias("mix_copy"))
        .select("mix_row.*")
    )


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST(('0x' || md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, '')))[1:15]) AS BIGINT) AS at
  FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM sized GROUP BY source
), leveled AS (
  SELECT *, (sum(source_size) OVER ()
             - coalesce(sum(3.0::DOUBLE * source_size) OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
          / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM totals
), planned AS (
  SELECT source, source_size, least(3.0::DOUBLE * source_size, weight * max(level) OVER ()) AS target FROM leveled
), parts AS (
  SELECT *, CASE WHEN target >= 3.0::DOUBLE * source_size THEN 3 ELSE CAST(floor(target / source_size) AS BIGINT) END AS whole
  FROM planned
), ordered AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS rest,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.at
                      RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
         + sum(s.size) OVER (PARTITION BY s.source, s.at) / 2.0 AS middle
  FROM sized s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN rest > 0 AND middle <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM ordered
"""
