"""Toxicity scores: bags of subword embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its character n-grams (3 to 5, with marks at both ends) and of the word itself, hashed
into one table; so a misspelling shares most vectors with the word it comes from. A window of three words is the mean of its
words, a linear softmax turns it into the log-odds of being toxic, and a document is as toxic as its most toxic window. Every
place starts a window, so a phrase counts the same wherever it stands; training cuts the documents at another place in each
step. In training, too, a document counts by its most toxic windows, first by many of them, at last by one; embeddings and
softmax are trained together by Adam, which lets entries with small slopes move little.

The softmax of a mean is the mean of the softmax inputs, so a fitted model is one number for each n-gram, and scoring needs
no embeddings. The model has a fixed size and is broadcast. Scoring runs over Arrow batches, without a shuffle.

The labelled sample is bounded: PER_CLASS documents of each label, of SAMPLE_CHARS code points or fewer. Every document is
scored over its whole text.

Defined results: null and empty texts have no window and get the log-odds of the bias alone; upper and lower case are not
distinguished; equal texts get equal scores; without examples of both labels nothing is learned, and every text gets the score
of `unlearned`, 0 if no example is toxic; an empty table gives no scores. Only id and text are read, so other columns can't
clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.llm.sampling import labelled_sample
from postlake.llm.words import fold_of, map_batches, portions, split_words

PER_CLASS = 700
SAMPLE_CHARS = 5000
BUCKETS = 1 << 16
DIMENSIONS = 8
NGRAMS = (3, 4, 5)
WINDOW = 3
STEPS = 80
RATE = 0.2
FLOOR = 3e-4  # entries whose slope is far below this hardly move
SUPPORT = 20  # an n-gram is learned if at least so many pairs of a training document and one of its words have it
CACHED_WORDS = 150_000
SEED = 7

BASE = np.uint64(0x9E3779B97F4A7C15)


def finish(hashes: np.ndarray) -> np.ndarray:
    x = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(32))) % np.uint64(BUCKETS)).astype(np.int64)


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (word, bucket): the hashed n-grams of every word and the word itself."""
    marked = [f"<{word.lower()}>" for word in words]
    sizes = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64) + np.uint64(1)
    owner = np.repeat(np.arange(len(words)), sizes)
    ends = np.cumsum(sizes)
    left = np.repeat(ends, sizes) - np.arange(len(codes))  # characters from here to the end of the word
    owners, buckets = [], []
    rolled = codes
    for n in range(2, max(NGRAMS) + 1):
        rolled = rolled[:-1] * BASE + codes[n - 1 :] if len(codes) >= n else rolled[:0]
        if n in NGRAMS:
            at = np.flatnonzero(left[: len(rolled)] >= n)
            owners.append(owner[at])
            buckets.append(finish(rolled[at] + np.uint64(n)))
    if len(words):
        powers = np.cumprod(np.full(int(sizes.max()), BASE, dtype=np.uint64))
        whole = np.add.reduceat(codes * powers[left - 1], ends - sizes)
        owners.append(np.arange(len(words)))
        buckets.append(finish(whole))
    if not owners:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(owners), np.concatenate(buckets)


def window_means(values: np.ndarray) -> np.ndarray:
    """Means of WINDOW values from each place on; of fewer values there is one mean."""
    if len(values) < WINDOW:
        return values.mean(keepdims=True)
    total = values[: len(values) - WINDOW + 1].copy()
    for at in range(1, WINDOW):
        total += values[at : at + len(total)]
    return total / WINDOW


@dataclass
class Model:
    """The log-odds that an n-gram brings, the bias, and the cut that scores are centred on."""

    odds: np.ndarray
    bias: float
    cut: float

    def word_odds(self, words: list[str]) -> np.ndarray:
        owner, bucket = subwords(words)
        totals = np.bincount(owner, weights=self.odds[bucket], minlength=len(words))
        return totals / np.bincount(owner, minlength=len(words))

    def margin(self, odds: np.ndarray) -> float:
        most = float(window_means(odds).max()) if len(odds) else 0.0
        return most + self.bias - self.cut


class Adam:
    def __init__(self, *values: np.ndarray):
        self.values = values
        self.first = [np.zeros_like(value) for value in values]
        self.second = [np.zeros_like(value) for value in values]
        self.steps = 0

    def step(self, slopes: list[np.ndarray], rate: float) -> None:
        self.steps += 1
        for value, slope, first, second in zip(self.values, slopes, self.first, self.second):
            first += 0.1 * (slope - first)
            second += 0.01 * (slope * slope - second)
            scale = np.sqrt(second / (1 - 0.99**self.steps)) + FLOOR
            value -= (rate * (first / (1 - 0.9**self.steps)) / scale).astype(value.dtype)


@dataclass
class Vocabulary:
    """The words of the sample and the table entries that each of them has, ordered by word and by entry."""

    words: int
    sizes: np.ndarray  # entries of a word, learned or not
    owner: np.ndarray
    bucket: np.ndarray

    def __post_init__(self):
        self.learned, self.word_starts = np.unique(self.owner, return_index=True)
        self.by_bucket = np.argsort(self.bucket, kind="stable")
        self.used, self.bucket_starts = np.unique(self.bucket[self.by_bucket], return_index=True)

    def vectors(self, table: np.ndarray) -> np.ndarray:
        """One row per word, the mean of its entries, and a row of zeros that stands for padding."""
        out = np.zeros((self.words + 1, table.shape[1]), dtype=table.dtype)
        if len(self.learned):
            sums = np.add.reduceat(table[self.bucket], self.word_starts, axis=0)
            out[self.learned] = sums / self.sizes[self.learned, None]
        return out

    def to_table(self, to_vectors: np.ndarray, entries: int) -> np.ndarray:
        """The slope of the table, from that of the vectors."""
        out = np.zeros((entries, to_vectors.shape[1]), dtype=to_vectors.dtype)
        if len(self.used):
            to_pair = to_vectors[:-1] / self.sizes[:, None]
            out[self.used] = np.add.reduceat(to_pair[self.owner[self.by_bucket]], self.bucket_starts, axis=0)
        return out


@dataclass
class Layout:
    """Training documents cut into windows from an offset on: a row of word numbers each, padded at both ends."""

    windows: np.ndarray
    filled: np.ndarray
    label: np.ndarray
    groups: list[np.ndarray]  # the windows of each document


def lay_out(documents: list[tuple[np.ndarray, int]], padding: int, offset: int) -> Layout:
    windows, label, groups, rows = [], [], [], 0
    for numbers, y in documents:
        size = -(-(len(numbers) + offset) // WINDOW) * WINDOW
        padded = np.full(size, padding)
        padded[offset : offset + len(numbers)] = numbers
        windows.append(padded.reshape(-1, WINDOW))
        groups.append(np.arange(rows, rows + len(windows[-1])))
        rows += len(windows[-1])
        label += [y] * len(windows[-1])
    whole = np.concatenate(windows)
    return Layout(whole, (whole != padding).sum(axis=1), np.array(label), groups)


def loss_and_slopes(
    table: np.ndarray, weights: np.ndarray, bias: np.ndarray, words: Vocabulary, windows: np.ndarray, filled: np.ndarray,
    label: np.ndarray, weight: np.ndarray,
) -> tuple[float, list[np.ndarray]]:
    """Weighted softmax cross-entropy of some windows, and its slopes in table, weights and bias."""
    vectors = words.vectors(table)
    means = vectors[windows].sum(axis=1) / filled[:, None].astype(table.dtype)
    logits = means @ weights + bias
    odds = np.clip(logits[:, 1] - logits[:, 0], -30, 30)
    loss = float((weight * np.logaddexp(0, np.where(label == 1, -odds, odds))).sum())
    # For two classes the slope in the logits is (p - y) in one column and its negative in the other.
    miss = ((1 / (1 + np.exp(-odds)) - label) * weight).astype(table.dtype)
    slope = np.stack((-miss, miss), axis=1)
    to_mean = (slope @ weights.T) / filled[:, None].astype(table.dtype)
    to_vectors = np.empty_like(vectors)
    flat = windows.ravel()
    for d in range(table.shape[1]):
        to_vectors[:, d] = np.bincount(flat, weights=np.repeat(to_mean[:, d], WINDOW), minlength=len(vectors))
    return loss, [words.to_table(to_vectors, len(table)), means.T @ slope, slope.sum(axis=0)]


def unlearned(sample: list[tuple[str, int]]) -> float:
    """The score where both labels were not seen: the share of label 1, with one example of label 0 more."""
    return sum(label for _, label in sample) / (len(sample) + 1)


def log_odds(share: float) -> float:
    return float(np.log(max(share, 1e-13) / max(1 - share, 1e-13)))


def fit(sample: list[tuple[str, int]], steps: int = STEPS) -> Model:
    """Train on whole documents; every fifth one is kept for the cut."""
    if {label for _, label in sample} != {0, 1}:
        return Model(np.zeros(BUCKETS, dtype=np.float32), log_odds(unlearned(sample)), 0.0)
    known: dict[str, int] = {}
    documents = [(np.array([known.setdefault(w.lower(), len(known)) for w in split_words(text)]), y) for text, y in sample]
    documents = [(numbers, label) for numbers, label in documents if len(numbers)]
    trained = [document for at, document in enumerate(documents) if at % 5] or documents
    held = [document for at, document in enumerate(documents) if at % 5 == 0]
    if {label for _, label in trained} != {0, 1}:
        return Model(np.zeros(BUCKETS, dtype=np.float32), log_odds(unlearned(sample)), 0.0)

    owner, bucket = subwords(list(known))
    order = np.argsort(owner, kind="stable")
    owner, bucket = owner[order], bucket[order]
    sizes = np.bincount(owner, minlength=len(known)).astype(np.float32)
    spread = np.bincount(np.concatenate([np.unique(numbers) for numbers, _ in trained]), minlength=len(known))
    supported = np.bincount(bucket, weights=spread[owner], minlength=BUCKETS) >= SUPPORT
    words = Vocabulary(len(known), sizes, owner[supported[bucket]], bucket[supported[bucket]])
    layouts = [lay_out(trained, len(known), offset) for offset in range(WINDOW)]
    per_label = np.bincount([label for _, label in trained], minlength=2)

    draw = np.random.default_rng(SEED)
    table = draw.normal(0, 0.01, (BUCKETS, DIMENSIONS)).astype(np.float32) * supported[:, None]
    weights = draw.normal(0, 0.5, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.zeros(2, dtype=np.float32)
    descent = Adam(table, weights, bias)

    for step in range(steps):
        laid = layouts[step % WINDOW]
        vectors = words.vectors(table)
        logits = (vectors @ weights)[laid.windows].sum(axis=1) / laid.filled[:, None]
        odds = logits[:, 1] - logits[:, 0]
        # A document is judged by its most toxic windows, of either label: a share of them that shrinks to a single one.
        share = max(0.0, 0.5 - step / (steps / 2))
        chosen = [group[np.argsort(-odds[group])[: max(1, int(share * len(group)))]] for group in laid.groups]
        rows = np.concatenate(chosen)
        weight = np.concatenate([np.full(len(x), 1 / (2 * per_label[laid.label[x[0]]] * len(x))) for x in chosen])
        _, slopes = loss_and_slopes(
            table, weights, bias, words, laid.windows[rows], laid.filled[rows], laid.label[rows], weight.astype(np.float32)
        )
        descent.step(slopes, RATE * (1 - step / steps))

    model = Model((table @ (weights[:, 1] - weights[:, 0])).astype(np.float32), float(bias[1] - bias[0]), 0.0)
    every = model.word_odds(list(known))
    margins = np.array([model.margin(every[numbers]) for numbers, _ in held])
    truth = np.array([y for _, y in held])
    model.cut = best_cut(margins, truth)
    return model


def best_cut(margins: np.ndarray, truth: np.ndarray) -> float:
    """The middle of the widest gap among the cuts with the highest F1."""
    order = np.argsort(-margins)
    ranked, hits = margins[order], np.cumsum(truth[order])
    f1 = 2 * hits / (np.arange(1, len(ranked) + 1) + truth.sum())
    gaps = ranked - np.append(ranked[1:], ranked[-1] - 1.0)
    best = np.flatnonzero(f1 >= f1.max() - 1e-9)
    at = best[np.argmax(gaps[best])]
    return float(ranked[at] - gaps[at] / 2)


class Scorer:
    """Scores texts with a bounded cache of words."""

    def __init__(self, model: Model):
        self.model, self.cache = model, {}

    def __call__(self, texts: list[str | None]) -> list[float]:
        split = [split_words(text) for text in texts]
        new = list(dict.fromkeys(word for words in split for word in words if word not in self.cache))
        if new:
            if len(self.cache) + len(new) > CACHED_WORDS:
                self.cache.clear()
                new = list(dict.fromkeys(word for words in split for word in words))
            self.cache.update(zip(new, self.model.word_odds(new).tolist()))
        look_up = self.cache.__getitem__
        margins = [self.model.margin(np.fromiter(map(look_up, words), dtype=np.float64, count=len(words))) for words in split]
        return (1 / (1 + np.exp(-np.clip(margins, -30, 30)))).tolist()


PORTION_CHARS = 400_000  # of text that a task works on at a time


def score_all(scorer: Callable, column: pa.Array) -> list[float]:
    return [score for portion in portions(column, PORTION_CHARS) for score in scorer(portion)]


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    return fit(labelled_sample(docs, labels, label, PER_CLASS, SAMPLE_CHARS, doc_id, text))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted: one row per document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            scores = pa.array(score_all(scorer, batch.column("text")), type=pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], names=["doc_id", "score"])

    scored = map_batches(rows, run, T.StructType([rows.schema["doc_id"], T.StructField("score", T.DoubleType())]))
    return scored.select(
        "doc_id",
        (fold_of(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def clean_rows(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of `docs` that are not predicted toxic, columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            keep = [value < 0.5 for value in score_all(scorer, batch.column(place))]
            yield batch.filter(pa.array(keep, type=pa.bool_()))

    return map_batches(docs, run, docs.schema)
