"""Secret scans: three pattern kinds and a randomness test battery. DataFrame functions only.

The base kinds are found by pattern. The method adds spans of kind `random`: tokens of at least 20 characters whose
characters behave like a random string in the token's inferred encoding: the narrowest alphabet of ENCODINGS that holds them
all. Random strings over other alphabets (codes cut up by hyphens, say) pass as long as they are short, and fail when long.

Two questions are put to each token. First the battery: is it what a uniform random string would be? Chi-squared of the
character counts, a runs test on the change of character classes and the lag-1 serial correlation of the symbol values; a
token that fails one of them (Bonferroni over the three) is not random. Then: could ordinary text be that even? The
index of coincidence and the number of class changes are held against what written words, names and numbers show, which
gives a p-value that falls with the length of the token. These p-values, of all tokens of the corpus, go through
Benjamini-Hochberg within classes of length, so short tokens, which prove little, do not ride on the long ones and the
share of false discoveries is held in each class. The procedure needs only counts per class and step of log p, so the
corpus is aggregated to a table of fixed size.

Defined results: null and empty texts hold nothing; offsets count code points and ends are exclusive; equal rows give
equal spans; an empty table gives an empty result. Input columns never clash: only id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.session import checkpointed

# The pattern kinds, in the order in which equal starts are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{12,}+"
HEX = "[0-9a-f]{32,}+"
TOKEN = "[A-Za-z0-9+/_-]{20,}+={0,2}"
ASSIGN_VALUE = 8
KINDS = ("assign", "access", "hex", "random")

# A character that no pattern matches frames the matches; where a text has it, a neighbour stands in.
FRAME, STAND_IN = "\ue000", "\ue001"

DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()

# Alphabets of the inferred encodings, of which the first that fits is taken, narrow ones first; for ordinary
# tokens written in them, the sum of squared and of cubed character shares and the share of neighbours of different class.
ENCODINGS = (
    ("hex", "^[0-9a-f]+$", "0123456789abcdef", 0.13, 0.022, 0.15),
    ("HEX", "^[0-9A-F]+$", "0123456789ABCDEF", 0.13, 0.022, 0.15),
    ("base32", "^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 0.066, 0.0058, 0.10),
    ("base32 lower", "^[a-z2-7]+$", LOWER + "234567", 0.066, 0.0058, 0.10),
    ("alnum", "^[0-9a-z]+$", "0123456789abcdefghijklmnopqrstuvwxyz", 0.066, 0.0058, 0.10),
    ("ALNUM", "^[0-9A-Z]+$", DIGITS + UPPER, 0.066, 0.0058, 0.10),
    ("letters", "^[A-Za-z]+$", UPPER + LOWER, 0.060, 0.0052, 0.12),
    ("base58", "^[1-9A-HJ-NP-Za-km-z]+$", "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz", 0.060, 0.0052, 0.12),
    ("base62", "^[0-9A-Za-z]+$", DIGITS + UPPER + LOWER, 0.060, 0.0052, 0.12),
    ("base64 plain", "^[A-Za-z0-9+/]+$", UPPER + LOWER + DIGITS + "+/", 0.060, 0.0052, 0.12),
    ("base64 url", "^[A-Za-z0-9_-]+$", UPPER + LOWER + DIGITS + "-_", 0.060, 0.0052, 0.12),
    ("base64", "", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_", 0.060, 0.0052, 0.12),
)
LENGTH_CLASSES = (20, 28, 40, 64, 128)
BATTERY_ALPHA = 0.001
FALSE_DISCOVERIES = 0.01
STEPS = 10  # per unit of -ln p
MOST_STEPS = 7000

SPAN = "struct<start:bigint,end:bigint,found:string>"
PLACED = "struct<start:bigint,kind:int,end:bigint>"
RANDOM = 3  # the kind of what the battery finds, as in KINDS
BLOCK = 256  # an even number


def bound(value: Column, use) -> Column:
    """`use` of a value that is worked out once, however often `use` mentions it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def in_blocks(values: Column, zero: Column, after, run) -> Column:
    """A running computation over a long array, in time linear in its length.

    Appending to an array copies it, so the array is cut into blocks of BLOCK values: `after(state, block)` is the state
    behind a block, and `run(state, block)` the results of a block whose state in front is known.
    """

    def cut(whole: Column) -> Column:
        places = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(whole) / BLOCK).cast("int") - 1, F.lit(0)))
        return F.transform(places, lambda at: F.slice(whole, at * BLOCK + 1, F.lit(BLOCK)))

    def joined(blocks: Column) -> Column:
        states = F.aggregate(
            blocks, F.array(zero), lambda seen, block: F.array_append(seen, after(F.element_at(seen, -1), block))
        )
        return F.flatten(F.zip_with(blocks, F.slice(states, F.lit(1), F.size(blocks)), lambda block, state: run(state, block)))

    return bound(bound(values, cut), joined)


def framed_matches(text: Column, pattern: str) -> Column:
    """Start, end (code points) and text of every leftmost, non-overlapping match."""
    clean = F.translate(text, FRAME, STAND_IN)
    parts = F.split(F.regexp_replace(clean, f"(?:{pattern})", f"{FRAME}$0{FRAME}"), FRAME, -1)

    def after(at: Column, block: Column) -> Column:
        return F.aggregate(block, at, lambda total, part: total + F.length(part))

    def run(at: Column, block: Column) -> Column:
        # Every second part is a match; blocks hold an even number of parts.
        first = F.struct(at.alias("at"), F.lit(False).alias("inside"), F.array().cast(f"array<{SPAN}>").alias("spans"))

        def step(state: Column, part: Column) -> Column:
            end = state["at"] + F.length(part)
            span = F.struct(state["at"].alias("start"), end.alias("end"), part.alias("found"))
            spans = F.when(state["inside"], F.array_append(state["spans"], span)).otherwise(state["spans"])
            return F.struct(end.alias("at"), (~state["inside"]).alias("inside"), spans.alias("spans"))

        return F.aggregate(block, first, step, lambda state: state["spans"])

    found = in_blocks(parts, F.lit(0).cast("long"), after, run)
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(f"array<{SPAN}>"))


def uncovered(spans: Column) -> Column:
    """Of `spans` (start, kind, end), in their order, all base spans and those random ones that no base span holds.

    In order of start, base spans first, a random one is held by a base span if the farthest end so far is not before its own.
    """

    def farther(end: Column, span: Column) -> Column:
        return F.when(span["kind"] < RANDOM, F.greatest(end, span["end"])).otherwise(end)

    def after(end: Column, block: Column) -> Column:
        return F.aggregate(block, end, farther)

    def run(end: Column, block: Column) -> Column:
        first = F.struct(end.alias("end"), F.array().cast(f"array<{PLACED}>").alias("kept"))

        def step(state: Column, span: Column) -> Column:
            keep = (span["kind"] < RANDOM) | (state["end"] < span["end"])
            kept = F.when(keep, F.array_append(state["kept"], span)).otherwise(state["kept"])
            return F.struct(farther(state["end"], span).alias("end"), kept.alias("kept"))

        return F.aggregate(block, first, step, lambda state: state["kept"])

    return in_blocks(spans, F.lit(-1).cast("long"), after, run)


def upper_tail(z: Column) -> Column:
    """Of the standard normal distribution; Zelen and Severo's approximation, accurate relative to the tail as well."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = 0.3989422804014327 * F.exp(-z * z / 2) * series
    return F.greatest(F.when(z >= 0, tail).otherwise(1 - tail), F.lit(1e-300))


def two_tails(z: Column) -> Column:
    return F.least(2 * upper_tail(F.abs(z)), F.lit(1.0))


def char_class(char: Column) -> Column:
    return (
        F.when(char.between("0", "9"), 0).when(char.between("a", "z"), 1).when(char.between("A", "Z"), 2).otherwise(3)
    )


def by_encoding(encoding: Column, pick) -> Column:
    *named, (*last,) = ENCODINGS
    chosen = F.lit(pick(last))
    for entry in reversed(named):
        chosen = F.when(encoding == entry[0], F.lit(pick(entry))).otherwise(chosen)
    return chosen


def class_sizes(alphabet: str) -> list[int]:
    digits = sum(c.isdigit() for c in alphabet)
    lower = sum(c.islower() for c in alphabet)
    upper = sum(c.isupper() for c in alphabet)
    return [digits, lower, upper, len(alphabet) - digits - lower - upper]


def change_share(alphabet: str) -> float:
    """Share of neighbours of different class in a uniform random string."""
    return 1 - sum((size / len(alphabet)) ** 2 for size in class_sizes(alphabet))


def inferred(token: Column) -> Column:
    name = F.lit(ENCODINGS[-1][0])
    for entry in reversed(ENCODINGS[:-1]):
        name = F.when(token.rlike(entry[1]), entry[0]).otherwise(name)
    return name


def measured(span: Column) -> Column:
    """Raw counts of one token."""
    token = F.rtrim(span["found"], F.lit("="))
    return F.struct(
        span["start"].alias("start"),
        span["end"].alias("end"),
        token.alias("token"),
        F.length(token).cast("double").alias("n"),
        inferred(token).alias("encoding"),
        F.split(token, "").alias("chars"),
    )


def counted(part: Column) -> Column:
    squares = F.aggregate(
        F.array_distinct(part["chars"]),
        F.lit(0.0),
        lambda total, char: total + F.pow(part["n"] - F.length(F.replace(part["token"], char, F.lit(""))), F.lit(2.0)),
    )
    classes = F.transform(part["chars"], char_class)
    later = F.slice(classes, F.lit(2), F.size(classes))
    changes = F.aggregate(
        F.zip_with(classes, later, lambda a, b: F.when(a != b, 1.0).otherwise(0.0)), F.lit(0.0), lambda total, x: total + x
    )
    alphabet = by_encoding(part["encoding"], lambda entry: entry[2])
    values = F.transform(part["chars"], lambda char: F.instr(alphabet, char).cast("double"))
    kinds = F.size(F.array_distinct(classes))
    return F.struct(
        part["start"].alias("start"), part["end"].alias("end"), part["n"].alias("n"), part["encoding"].alias("encoding"),
        squares.alias("squares"), changes.alias("changes"), values.alias("values"), kinds.alias("kinds"),
    )


def correlated(part: Column) -> Column:
    later = F.slice(part["values"], F.lit(2), F.size(part["values"]))
    names = ("start", "end", "n", "encoding", "squares", "changes", "kinds")

    def around(mean: Column) -> Column:
        spread = F.aggregate(part["values"], F.lit(0.0), lambda total, x: total + (x - mean) * (x - mean))
        products = F.zip_with(part["values"], later, lambda a, b: F.coalesce((a - mean) * (b - mean), F.lit(0.0)))
        together = F.aggregate(products, F.lit(0.0), lambda total, x: total + x)
        serial = F.when(spread > 0, together / spread).otherwise(F.lit(1.0))
        return F.struct(*[part[name].alias(name) for name in names], serial.alias("serial"))

    # Bound, or the mean would be worked out anew for every character.
    return bound(F.aggregate(part["values"], F.lit(0.0), lambda total, x: total + x) / part["n"], around)


def judged(part: Column) -> Column:
    """Whether the battery accepts the token as random, and -ln p against ordinary text in steps."""
    n, k = part["n"], by_encoding(part["encoding"], lambda entry: float(len(entry[2])))
    chi = part["squares"] * k / n - n
    p_counts = upper_tail((chi - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n))
    uniform = by_encoding(part["encoding"], lambda entry: change_share(entry[2]))
    p_runs = two_tails((part["changes"] - (n - 1) * uniform) / F.sqrt((n - 1) * uniform * (1 - uniform)))
    p_serial = two_tails((part["serial"] + 1 / n) * F.sqrt(n))
    passes = (3 * F.least(p_counts, p_runs, p_serial) >= BATTERY_ALPHA) & (part["kinds"] >= 2)

    two, three = (by_encoding(part["encoding"], lambda entry, at=at: entry[at]) for at in (3, 4))
    coincidence = (part["squares"] - n) / (n * (n - 1))
    spread = F.sqrt((2 * two * (1 - two) + 4 * (n - 2) * (three - two * two)) / (n * (n - 1)))
    ln_even = F.ln(upper_tail((two - coincidence) / spread))
    text_share = by_encoding(part["encoding"], lambda entry: entry[5])
    ln_changes = F.ln(upper_tail((part["changes"] - (n - 1) * text_share) / F.sqrt((n - 1) * text_share * (1 - text_share))))
    both = -(ln_even + ln_changes)  # Fisher: p = exp(-both) * (1 + both)
    evidence = F.greatest(both - F.ln(1 + both), F.lit(0.0))
    length_class = F.lit(0)
    for least in LENGTH_CLASSES:
        length_class = F.when(n >= least, least).otherwise(length_class)
    return F.struct(
        part["start"].alias("start"), part["end"].alias("end"), passes.alias("passes"), length_class.alias("length_class"),
        F.least(F.floor(evidence * STEPS), F.lit(MOST_STEPS)).cast("int").alias("step"),
    )


def randomness(tokens: Column) -> Column:
    long_enough = F.filter(F.transform(tokens, measured), lambda part: part["n"] >= LENGTH_CLASSES[0])
    for step in (counted, correlated, judged):
        long_enough = F.transform(long_enough, step)
    return long_enough


def scanned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One narrow row per document, fixed in the shared folder: base spans by kind and the judged tokens."""
    body = F.coalesce(F.col(text), F.lit(""))
    assigns = F.filter(
        framed_matches(body, ASSIGN),
        lambda span: F.length(F.regexp_extract(span["found"], ASSIGN, 2)) >= ASSIGN_VALUE,
    )
    spans = {"assign": assigns, "access": framed_matches(body, ACCESS), "hex": framed_matches(body, HEX)}

    def bare(found: Column) -> Column:
        return F.transform(found, lambda span: F.struct(span["start"].alias("start"), span["end"].alias("end")))

    return checkpointed(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            *[bare(found).alias(kind) for kind, found in spans.items()],
            randomness(framed_matches(body, TOKEN)).alias("tokens"),
        )
    )


def discovery_steps(rows: DataFrame) -> dict[int, int]:
    """For each length class, the least step of evidence that Benjamini-Hochberg accepts. At most one row per class."""
    counts = (
        rows.select(F.inline("tokens")).groupBy("length_class", "step").agg(F.count("*").alias("tokens"))
    )
    by_class = Window.partitionBy("length_class")
    rank = F.sum("tokens").over(by_class.orderBy(F.desc("step")))
    total = F.sum("tokens").over(by_class)
    accepted = (
        counts.select("length_class", "step", rank.alias("rank"), total.alias("total"))
        .where(F.exp(-F.col("step") / STEPS) <= F.lit(FALSE_DISCOVERIES) * F.col("rank") / F.col("total"))
        .groupBy("length_class")
        .agg(F.min("step").alias("step"))
    )
    return {row["length_class"]: row["step"] for row in accepted.collect()}


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and spans: array of (start, kind, end) in order of start, then kind; `kind` counts from 0 as in KINDS."""
    rows = scanned(docs, doc_id, text)
    steps = discovery_steps(rows)
    needed = F.lit(MOST_STEPS + 1)

    def least_step(length_class: Column) -> Column:
        chosen = needed
        for least, step in steps.items():
            chosen = F.when(length_class == least, step).otherwise(chosen)
        return chosen

    def numbered(spans: Column, kind: int) -> Column:
        return F.transform(
            spans, lambda span: F.struct(span["start"].alias("start"), F.lit(kind).alias("kind"), span["end"].alias("end"))
        )

    base = F.concat(*[numbered(F.col(kind), at) for at, kind in enumerate(KINDS[:3])])
    found = F.filter("tokens", lambda t: t["passes"] & (t["step"] >= least_step(t["length_class"])))

    placed = F.array_sort(F.concat("base", "found"))
    return rows.withColumns({"base": base, "found": numbered(found, RANDOM)}).select("doc_id", uncovered(placed).alias("spans"))


def listed(spans: Column) -> Column:
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


def digests(found: DataFrame) -> DataFrame:
    def number(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[number(at).alias(f"n_{kind}") for at, kind in enumerate(KINDS[:3])],
        F.sha2(listed(F.filter("spans", lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        number(3).alias("n_random"),
    )
