r"""Quality rules on repetition: how much of a text lies in repeated n-grams and lines.

Words get numbers inside their document, and hashes of the windows of several lengths are rolled from one length to the
next in numpy. Windows with equal hashes are compared word by word before they count as repeated. Every occurrence of a
repeated window counts, the first one included; coverage is measured in code points of the covered words.

A document fails the base rules with fewer than 10 words or with more than 20 % of its words in repeated 5-word windows.
Beyond that it is dropped if repeated lines, or repeated windows of one of the lengths, cover more than their share of its
word characters, or if one 2-, 3- or 4-gram that occurs three times or more does so alone.

Defined results: a null or empty text has no words and fails; texts are read whole, one at a time, so memory follows the
longest single text; the result of a row depends on its text alone, so repeated rows agree; an empty table gives an empty
result. Only id and text are read, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.llm.words import map_batches, split_words

MIN_WORDS = 10
BASE_LENGTH = 5
BASE_PERCENT = 20
SYMBOLS = "#*$%&|<>"

# The largest share of word characters in repeated lines, in repeated windows by length, and in the most frequent window
# if it occurs more than twice. Limits on windows are twice the usual ones, since first occurrences count here as well.
MOST_IN_LINES = 0.30
MOST_IN_WINDOWS = {5: 0.30, 6: 0.28, 7: 0.26, 8: 0.24, 9: 0.22, 10: 0.20}
MOST_IN_TOP = {2: 0.20, 3: 0.18, 4: 0.16}
TOP_COUNT = 3

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mixed(numbers: np.ndarray) -> np.ndarray:
    """Spread small numbers over 64 bits."""
    x = (numbers.astype(np.uint64) + np.uint64(1)) * MULTIPLIER
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolled(numbers: np.ndarray, lengths: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """Hashes of all windows of each length, each length rolled on from the one before."""
    single = mixed(numbers)
    hashes = single
    for length in range(1, max(lengths) + 1):
        if length > 1:
            hashes = hashes[:-1] * MULTIPLIER + single[length - 1 :] if len(single) >= length else single[:0]
        if length in lengths:
            yield length, hashes


def repeated_windows(numbers: np.ndarray, hashes: np.ndarray, length: int) -> tuple[np.ndarray, int, int]:
    """Which windows occur twice or more, and start and count of the most frequent one."""
    repeated = np.zeros(len(hashes), dtype=bool)
    if len(hashes) < 2:
        return repeated, 0, min(len(hashes), 1)
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    at = np.flatnonzero(ranked[1:] == ranked[:-1])
    if not len(at):
        return repeated, 0, 1
    left, right = order[at], order[at + 1]
    same = np.ones(len(at), dtype=bool)
    for shift in range(length):
        same &= numbers[left + shift] == numbers[right + shift]
    at = at[same]
    if not len(at):
        return repeated, 0, 1
    repeated[order[at]] = True
    repeated[order[at + 1]] = True
    breaks = np.flatnonzero(np.diff(at) != 1)
    starts = np.concatenate(([0], breaks + 1))
    counts = np.diff(np.concatenate((starts, [len(at)]))) + 1
    best = int(np.argmax(counts))
    return repeated, int(order[at[starts[best]]]), int(counts[best])


def covered(repeated: np.ndarray, length: int, n_words: int) -> np.ndarray:
    """Words inside repeated windows."""
    steps = np.zeros(n_words + 1, dtype=np.int64)
    at = np.flatnonzero(repeated)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + length, -1)
    return np.cumsum(steps[:-1]) > 0


def measure(text: str | None) -> dict:
    """All figures and the verdict for one text."""
    text = text or ""
    words = split_words(text)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    word_chars = int(sizes.sum())
    known: dict[str, int] = {}
    numbers = np.fromiter((known.setdefault(word, len(known)) for word in words), dtype=np.int64, count=len(words))

    n_dup_lines, line_chars, seen = 0, 0, set()
    for line in text.split("\n"):
        if line in seen:
            n_dup_lines += 1
            line_chars += sum(map(len, split_words(line)))
        elif split_words(line):
            seen.add(line)

    n_repeat_words, shares, kept = 0, {}, True
    lengths = sorted({BASE_LENGTH, *MOST_IN_WINDOWS, *MOST_IN_TOP})
    for length, hashes in rolled(numbers, lengths):
        repeated, top, count = repeated_windows(numbers, hashes, length)
        if length in MOST_IN_TOP:
            share = count * int(sizes[top : top + length].sum()) / max(word_chars, 1) if count >= TOP_COUNT else 0.0
            kept &= share <= MOST_IN_TOP[length]
        if length == BASE_LENGTH or length in MOST_IN_WINDOWS:
            inside = covered(repeated, length, len(words))
            share = int(sizes[inside].sum()) / max(word_chars, 1)
            if length == BASE_LENGTH:
                n_repeat_words = int(inside.sum())
            kept &= share <= MOST_IN_WINDOWS.get(length, 1.0)
            shares[length] = share
    line_share = line_chars / max(word_chars, 1)
    failed = len(words) < MIN_WORDS or 100 * n_repeat_words > BASE_PERCENT * len(words)
    return {
        "n_words": len(words),
        "word_chars": word_chars,
        "n_symbols": sum(text.count(symbol) for symbol in SYMBOLS),
        "n_dup_lines": n_dup_lines,
        "n_repeat_words": n_repeat_words,
        "base_failed": failed,
        "line_share": line_share,
        "window_share": max(shares.values(), default=0.0),
        "kept": not failed and kept and line_share <= MOST_IN_LINES,
    }


MEASURES = T.StructType(
    [T.StructField(name, T.LongType()) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("line_share", T.DoubleType()),
        T.StructField("window_share", T.DoubleType()),
        T.StructField("kept", T.BooleanType()),
    ]
)
ARROW = pa.schema(
    [(name, pa.int64()) for name in MEASURES.names[:5]]
    + [("base_failed", pa.bool_()), ("line_share", pa.float64()), ("window_share", pa.float64()), ("kept", pa.bool_())]
)


def measured_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        figures = pa.Table.from_pylist([measure(value.as_py()) for value in batch.column("text")], schema=ARROW)
        columns = [batch.column("doc_id"), *[figures.column(name).combine_chunks() for name in ARROW.names]]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *ARROW.names])


def repetition(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the base figures, the shares and the verdict, one row per document."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([rows.schema["doc_id"], *MEASURES.fields])
    return map_batches(rows, measured_batches, schema)
