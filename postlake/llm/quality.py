"""Quality scores: a byte-level convolutional network in numpy.

The UTF-8 bytes of a text are cut into overlapping chunks that cover all of it. Learned filters of eight bytes run over every
chunk; each filter's largest response in a chunk is kept (max pooling over places). A document has, for each filter, the
largest and the mean response over its chunks; a small softmax-like layer turns these into one probability. Byte vectors,
filters and the last layer are trained together by Adam; through the maxima only the winning places get a slope.

A filter is a sum over its eight bytes of (byte vector . filter slice). For a fitted model these products are tables of 256
rows, so scoring a place is eight lookups and additions, over blocks of bytes that stay in the cache.

The labelled sample is bounded: PER_CLASS documents of each label, of SAMPLE_CHARS code points or fewer. Every document is
scored over its whole text. Training weighs both labels by their share among the labelled rows, so a score is the
probability that the document is good, not a balanced one.

Defined results: a null or empty text is one chunk of padding and is scored like any other; equal texts get equal scores;
long texts are scored chunk by chunk; without examples of both labels nothing is learned, and every text gets the score of
`unlearned`, 0 if no example is good; an empty table gives no scores. Only id and text are read, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.llm.sampling import labelled_sample
from postlake.llm.toxicity import Adam, log_odds, score_all, unlearned
from postlake.llm.words import fold_of, map_batches

PER_CLASS = 1100
SAMPLE_CHARS = 4000
PREDICT = 0.3
CHUNK = 512
OVERLAP = 64
WIDTH = 8
VECTOR = 8
FILTERS = 16
EPOCHS = 16
BATCH = 50
RATE = 0.01
DECAY = 1e-4
PAD = 0
BLOCK_CHUNKS = 16
SEED = 11


def chunks(data: bytes) -> np.ndarray:
    """Rows of CHUNK + WIDTH - 1 bytes, each starting CHUNK - OVERLAP after the one before; the last ones are padded."""
    step = CHUNK - OVERLAP
    rows = max(1, -(-max(len(data) - OVERLAP, 0) // step))
    size = CHUNK + WIDTH - 1
    padded = np.full((rows - 1) * step + size, PAD, dtype=np.uint8)
    padded[: min(len(data), len(padded))] = np.frombuffer(data, dtype=np.uint8)[: len(padded)]
    return np.lib.stride_tricks.sliding_window_view(padded, size)[::step]


@dataclass
class Model:
    """`tables[k, byte, filter]` is what a byte at place k of a window adds to a filter."""

    tables: np.ndarray
    filter_bias: np.ndarray
    weights: np.ndarray
    bias: float

    def pooled(self, rows: np.ndarray) -> np.ndarray:
        """Largest response of each filter in each chunk."""
        best = np.empty((len(rows), FILTERS), dtype=np.float32)
        for start in range(0, len(rows), BLOCK_CHUNKS):
            best[start : start + BLOCK_CHUNKS] = responses(self.tables, rows[start : start + BLOCK_CHUNKS]).max(axis=1)
        return np.maximum(best + self.filter_bias, 0)

    def margin(self, text: str | None) -> float:
        best = self.pooled(chunks((text or "").encode("utf-8", "surrogatepass")))
        return float(np.concatenate((best.max(axis=0), best.mean(axis=0))) @ self.weights + self.bias)

    def __call__(self, texts: list[str | None]) -> list[float]:
        return [1 / (1 + float(np.exp(-np.clip(self.margin(text), -30, 30)))) for text in texts]


def responses(tables: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Filter responses at every place of every chunk."""
    total = tables[0][rows[:, :CHUNK]]
    for k in range(1, WIDTH):
        total += tables[k][rows[:, k : k + CHUNK]]
    return total


def loss_and_slopes(
    vectors: np.ndarray, filters: np.ndarray, filter_bias: np.ndarray, weights: np.ndarray, bias: np.ndarray,
    rows: np.ndarray, sizes: np.ndarray, labels: np.ndarray, importance: np.ndarray,
) -> tuple[float, list[np.ndarray]]:
    """Weighted cross-entropy of a batch of documents with `sizes` chunks each, and its slopes in the first five arguments."""
    kind = vectors.dtype
    owner = np.repeat(np.arange(len(sizes)), sizes)
    firsts = np.cumsum(sizes) - sizes
    tables = np.einsum("bv,kvf->kbf", vectors, filters)
    n_filters = filters.shape[2]

    best = np.empty((len(rows), n_filters), dtype=kind)
    place = np.empty((len(rows), n_filters), dtype=np.int64)
    for at in range(0, len(rows), BLOCK_CHUNKS):
        found = responses(tables, rows[at : at + BLOCK_CHUNKS])
        place[at : at + BLOCK_CHUNKS] = found.argmax(axis=1)
        best[at : at + BLOCK_CHUNKS] = found.max(axis=1)
    open_ = best + filter_bias > 0
    best = np.maximum(best + filter_bias, 0)
    most = np.maximum.reduceat(best, firsts, axis=0)
    mean = np.add.reduceat(best, firsts, axis=0) / sizes[:, None].astype(kind)
    seen = np.concatenate((most, mean), axis=1)
    margin = np.clip(seen @ weights + bias, -30, 30)
    weight = importance / len(sizes)
    loss = float((weight * np.logaddexp(0, np.where(labels == 1, -margin, margin))).sum())
    miss = ((1 / (1 + np.exp(-margin)) - labels) * weight).astype(kind)

    to_seen = miss[:, None] * weights
    to_best = to_seen[owner, n_filters:] / sizes[owner, None].astype(kind)
    winners = best == most[owner]  # chunks of a document that share its maximum share the slope
    to_best += to_seen[owner, :n_filters] * winners / np.add.reduceat(winners.astype(kind), firsts, axis=0)[owner]
    to_best *= open_
    # Windows that won: (chunk, filter) pairs, their bytes by place in the window.
    chunk, which = np.nonzero(to_best)
    slope = to_best[chunk, which]
    bytes_of = rows[chunk[:, None], place[chunk, which][:, None] + np.arange(WIDTH)]
    to_tables = np.zeros((WIDTH, 256 * n_filters), dtype=kind)
    for k in range(WIDTH):
        to_tables[k] = np.bincount(bytes_of[:, k].astype(np.int64) * n_filters + which, weights=slope, minlength=256 * n_filters)
    to_tables = to_tables.reshape(WIDTH, 256, n_filters)
    to_vectors = np.einsum("kbf,kvf->bv", to_tables, filters)
    to_filters = np.einsum("kbf,bv->kvf", to_tables, vectors)
    return loss, [to_vectors, to_filters, to_best.sum(axis=0), seen.T @ miss, miss.sum(keepdims=True)]


def fit(sample: list[tuple[str, int]], good_share: float, epochs: int = EPOCHS) -> Model:
    """`good_share`: share of label 1 among all labelled rows that may be learned from."""
    labels = np.array([label for _, label in sample], dtype=np.int64)
    draw = np.random.default_rng(SEED)
    vectors = draw.normal(0, 0.5, (256, VECTOR)).astype(np.float32)
    filters = draw.normal(0, 0.3, (WIDTH, VECTOR, FILTERS)).astype(np.float32)
    filter_bias = np.zeros(FILTERS, dtype=np.float32)
    weights = draw.normal(0, 0.1, 2 * FILTERS).astype(np.float32)
    if set(labels.tolist()) != {0, 1}:
        return Model(np.zeros((WIDTH, 256, FILTERS), dtype=np.float32), filter_bias, 0 * weights, log_odds(unlearned(sample)))
    pieces = [chunks(text.encode("utf-8", "surrogatepass")) for text, _ in sample]
    counts = np.bincount(labels)
    importance = np.where(labels == 1, good_share / counts[1], (1 - good_share) / counts[0]) * len(sample)
    bias = np.array([np.log(good_share / (1 - good_share))], dtype=np.float32)
    adam = Adam(vectors, filters, filter_bias, weights, bias)

    for epoch in range(epochs):
        order = draw.permutation(len(sample))
        for start in range(0, len(order), BATCH):
            batch = order[start : start + BATCH]
            rows = np.concatenate([pieces[at] for at in batch])
            sizes = np.array([len(pieces[at]) for at in batch])
            _, slopes = loss_and_slopes(
                vectors, filters, filter_bias, weights, bias, rows, sizes, labels[batch], importance[batch]
            )
            decay = [DECAY * vectors, DECAY * filters, 0, DECAY * weights, 0]
            adam.step([slope + more for slope, more in zip(slopes, decay)], RATE * (1 - 0.9 * epoch / epochs))
    return Model(np.ascontiguousarray(np.einsum("bv,kvf->kbf", vectors, filters)), filter_bias, weights, float(bias[0]))


def good_share(labels: DataFrame, doc_id: str = "doc_id", label: str = "quality") -> float:
    """Share of label 1 among all labelled rows outside the held-out fold."""
    learned = labels.where((fold_of(F.col(doc_id)) != 0) & F.col(label).isin(0, 1))
    share = learned.agg(F.avg(label).alias("share")).collect()[0]["share"]
    return min(max(share if share is not None else 0.5, 0.01), 0.99)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    return fit(labelled_sample(docs, labels, label, PER_CLASS, SAMPLE_CHARS, doc_id, text), good_share(labels, doc_id, label))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted: one row per document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(score_all(shared.value, batch.column("text")), type=pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], names=["doc_id", "score"])

    scored = map_batches(rows, run, T.StructType([rows.schema["doc_id"], T.StructField("score", T.DoubleType())]))
    return scored.select(
        "doc_id",
        (fold_of(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= PREDICT).cast("int").alias("predicted"),
    )
