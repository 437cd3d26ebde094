"""Token ids in fixed-length rows: best-fit-decreasing packing with a segment tree over free capacities.

Each task encodes its documents and packs them in windows of bounded size, so there is no shuffle and no group: a task
holds one window of tokens, one batch of texts and the vocabulary. A window is packed by falling length; the segment tree
gives the fullest row that still has room in a logarithmic number of steps. A document longer than a row is cut into
pieces without losing a token; whole pieces fill rows of their own, the remainder is packed like a short document.

One output row holds `ids` (a row of the id matrix: little-endian, 2 bytes an id if the vocabulary allows, else 4, padded
with the end mark), `n_tokens`, `cu_seqlens` (0 and the end of each segment), `position_resets` (where position ids start
at 0 again), and for each segment `doc_ids` and `piece_starts` (the token of the document that the segment starts with).

Defined results: a document ends with the end mark, so a null or empty text is one token; repeated rows are packed again;
ties in length keep the order of the rows; every token of every row is written once; an empty table gives no rows. Rows
depend on how the input is split into tasks, their content does not. Only id and text are read, other columns can't clash.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.llm.words import map_batches

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how this vocabulary cuts a text before it merges bytes.
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MOST_VOCABULARY_BYTES = 32 << 20
ROW_TOKENS = 2048
WINDOW_TOKENS = 1 << 21
CACHED_WORDS = 150_000
ROWS_PER_BATCH = 256


class Encoder:
    """Byte-pair encoding with a bounded cache of words.

    A space followed by something else always starts a new pretoken, so texts can be cut there and words encoded alone;
    texts with runs of white space that contain a space are encoded whole.
    """

    def __init__(self, vocabulary: bytes):
        import tiktoken

        pairs = (line.split() for line in vocabulary.splitlines() if line)
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.end = max(ranks.values()) + 1
        self.dtype = np.dtype("<u2" if self.end < 1 << 16 else "<u4")
        self.encoding = tiktoken.Encoding("own", pat_str=PRETOKENS, mergeable_ranks=ranks, special_tokens={})
        self.cache: dict[str, bytes] = {}

    def plain(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), dtype=self.dtype).tobytes()

    def encode(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        if not all(rest) or any(word[0].isspace() for word in rest):
            return self.plain(text)
        cache, parts = self.cache, [self.plain(first)]
        for word in rest:
            ids = cache.get(word)
            if ids is None:
                if len(cache) >= CACHED_WORDS:
                    cache.clear()
                ids = cache[word] = self.plain(" " + word)
            parts.append(ids)
        return b"".join(parts)


class Capacities:
    """Open rows by free capacity; a segment tree counts them, so the smallest sufficient capacity is found by descent."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def change(self, capacity: int, by: int) -> None:
        node = capacity + self.leaves
        while node:
            self.counts[node] += by
            node >>= 1

    def put(self, capacity: int, row: int) -> None:
        if capacity:
            self.rows[capacity].append(row)
            self.change(capacity, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """The fullest row with room for `least`, and its capacity."""
        node = least + self.leaves
        if not self.counts[node]:
            while node > 1 and (node & 1 or not self.counts[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                if not self.counts[node]:
                    node += 1
        capacity = node - self.leaves
        self.change(capacity, -1)
        return self.rows[capacity].pop(), capacity


def best_fit(lengths: list[int], most: int) -> list[list[int]]:
    """Rows as lists of positions in `lengths`; each at most `most` long."""
    free, rows = Capacities(most), []
    for at in sorted(range(len(lengths)), key=lambda at: -lengths[at]):
        found = free.take(lengths[at])
        if found:
            row, capacity = found
            rows[row].append(at)
        else:
            row, capacity = len(rows), most
            rows.append([at])
        free.put(capacity - lengths[at], row)
    return rows


def schema_for(id_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("doc_ids", T.ArrayType(id_type)),
            T.StructField("piece_starts", T.ArrayType(T.LongType())),
            T.StructField("cu_seqlens", T.ArrayType(T.IntegerType())),
            T.StructField("position_resets", T.ArrayType(T.IntegerType())),
            T.StructField("n_tokens", T.IntegerType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )


class Packer:
    """Fills windows and turns them into Arrow batches."""

    def __init__(self, id_type: pa.DataType, dtype: np.dtype, end: int, row_tokens: int):
        self.dtype, self.end, self.row_tokens = dtype, end, row_tokens
        self.schema = pa.schema(
            [
                ("doc_ids", pa.list_(id_type)),
                ("piece_starts", pa.list_(pa.int64())),
                ("cu_seqlens", pa.list_(pa.int32())),
                ("position_resets", pa.list_(pa.int32())),
                ("n_tokens", pa.int32()),
                ("ids", pa.binary()),
            ]
        )
        self.pieces: list[tuple] = []  # document, first token, ids
        self.tokens = 0
        self.done: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        whole = len(ids) // self.row_tokens * self.row_tokens
        for start in range(0, whole, self.row_tokens):
            self.finish([(doc_id, start, ids[start : start + self.row_tokens])])
        if whole < len(ids):
            self.pieces.append((doc_id, whole, ids[whole:]))
            self.tokens += len(ids) - whole

    def finish(self, pieces: list[tuple]) -> None:
        row = np.full(self.row_tokens, self.end, dtype=self.dtype)
        ends = np.cumsum([0] + [len(ids) for _, _, ids in pieces]).tolist()
        for (_, _, ids), start, end in zip(pieces, ends, ends[1:]):
            row[start:end] = ids
        self.done.append(([p[0] for p in pieces], [p[1] for p in pieces], ends, ends[:-1], ends[-1], row.tobytes()))

    def close_window(self) -> None:
        for row in best_fit([len(piece[2]) for piece in self.pieces], self.row_tokens):
            self.finish([self.pieces[at] for at in row])
        self.pieces, self.tokens = [], 0

    def batches(self, least: int) -> Iterator[pa.RecordBatch]:
        while len(self.done) >= least and self.done:
            rows, self.done = self.done[:ROWS_PER_BATCH], self.done[ROWS_PER_BATCH:]
            columns = [pa.array(column, type=field.type) for column, field in zip(zip(*rows), self.schema)]
            yield pa.RecordBatch.from_arrays(columns, schema=self.schema)


ENCODERS: dict[int, Encoder] = {}  # one per vocabulary, kept while the Python worker lives


def encoder_for(vocabulary: bytes) -> Encoder:
    key = hash(vocabulary)
    if key not in ENCODERS:
        ENCODERS.clear()
        ENCODERS[key] = Encoder(vocabulary)
    return ENCODERS[key]


def pack(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, row_tokens: int = ROW_TOKENS,
    window_tokens: int = WINDOW_TOKENS,
) -> DataFrame:
    """Packed rows of `docs`; `vocabulary` is a file of base64 tokens and ranks that the driver can read."""
    if os.path.getsize(vocabulary) > MOST_VOCABULARY_BYTES:
        raise ValueError(f"{vocabulary} is larger than {MOST_VOCABULARY_BYTES} bytes")
    with open(vocabulary, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(shared.value)
        last = np.array([encoder.end], dtype=encoder.dtype).tobytes()
        packer = None
        for batch in batches:
            packer = packer or Packer(batch.schema.field("doc_id").type, encoder.dtype, encoder.end, row_tokens)
            for own_id, value in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                packer.add(own_id, np.frombuffer(encoder.encode(value.as_py() or "") + last, dtype=encoder.dtype))
                if packer.tokens >= window_tokens:
                    packer.close_window()
                yield from packer.batches(ROWS_PER_BATCH)
        if packer:
            packer.close_window()
            yield from packer.batches(1)

    return map_batches(rows, packed, schema_for(rows.schema["doc_id"].dataType))


def row_ids(ids: bytes, row_tokens: int = ROW_TOKENS) -> np.ndarray:
    """A row of the id matrix."""
    return np.frombuffer(ids, dtype=f"<u{len(ids) // row_tokens}")


def position_ids(position_resets: list[int], row_tokens: int = ROW_TOKENS) -> np.ndarray:
    """Positions that count up from 0 at every reset."""
    starts = np.zeros(row_tokens, dtype=np.int64)
    starts[position_resets] = position_resets
    return np.arange(row_tokens) - np.maximum.accumulate(starts)
