"""Token counts of whole texts: Arrow batches are encoded by the library, and only lengths leave the task.

The texts of a batch are taken together up to `PORTION_BYTES` bytes, so that a call to the library holds about as much
whatever the texts' lengths are. A text of more than `PIECE_CHARS` characters is first cut into pieces at safe boundaries:
between two characters that stand side by side in no piece of the vocabulary, so no merge can ever cross the cut and the
counts of the pieces add up to that of the text. Pieces after the first are encoded behind a line feed, which takes the mark
that the library puts before a text and merges with nothing; its own tokens are subtracted. Cuts are made only for models
for which this holds (byte-pair merges, byte fallback, identity normaliser, no user-defined symbols, no piece with a line
feed); texts of other models are encoded whole, and so is a stretch without any safe boundary.

Defined results: a null text counts as empty, with 0 bytes and 0 tokens; repeated rows are counted each; an empty table gives
no rows. Only id and text are read, so other columns can't clash. Special strings inside a text are ordinary text, which is
the library's default.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.llm.words import map_batches

VOCABULARY = "piece_bpe_32k.model"
MOST_MODEL_BYTES = 32 << 20
LIMIT_TOKENS = 4096
PIECE_CHARS = 65_536
PORTION_BYTES = 1 << 20
SPACE = "▁"  # how the library writes a space
BREAK = "\n"


@dataclass(frozen=True)
class Model:
    """The file of a model and the pairs of characters that one of its pieces holds; no pairs where cuts are not safe."""

    file: bytes
    joined: frozenset[str] | None


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def load(path: str) -> Model:
    with open(path, "rb") as stream:
        file = stream.read()
    if len(file) > MOST_MODEL_BYTES:
        raise ValueError(f"{path}: a model of more than {MOST_MODEL_BYTES} bytes is not broadcast")
    return Model(file, joined_pairs(file))


def joined_pairs(file: bytes) -> frozenset[str] | None:
    from sentencepiece import sentencepiece_model_pb2 as messages

    model = messages.ModelProto()
    model.ParseFromString(file)
    spec, trained = model.normalizer_spec, model.trainer_spec
    kind = messages.ModelProto.SentencePiece
    pieces = [piece.piece for piece in model.pieces if piece.type in (kind.NORMAL, kind.UNUSED)]
    safe = (
        trained.model_type == messages.TrainerSpec.BPE
        and trained.byte_fallback
        and spec.name == "identity"
        and not spec.precompiled_charsmap
        and not spec.remove_extra_whitespaces
        and not trained.treat_whitespace_as_suffix
        and not any(piece.type == kind.USER_DEFINED for piece in model.pieces)
        and not any(BREAK in piece for piece in pieces)
    )
    return frozenset(a + b for piece in pieces for a, b in zip(piece, piece[1:])) if safe else None


def cut(text: str, joined: frozenset[str] | None, most: int = PIECE_CHARS) -> list[str]:
    """`text` in pieces of about `most` characters at most, cut at safe boundaries only."""
    if joined is None or len(text) <= most:
        return [text]
    plain = text.replace(" ", SPACE)
    pieces, start = [], 0
    while len(text) - start > most:
        end = start + most
        while end > start and plain[end - 1 : end + 1] in joined:
            end -= 1
        if end == start:
            end = start + most + 1
            while end < len(text) and plain[end - 1 : end + 1] in joined:
                end += 1
        pieces.append(text[start:end])
        start = end
    return [*pieces, text[start:]] if start < len(text) else pieces


class TokenCounter:
    def __init__(self, model: Model, piece_chars: int = PIECE_CHARS, portion_bytes: int = PORTION_BYTES):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model.file)
        self.joined, self.piece_chars, self.portion_bytes = model.joined, piece_chars, portion_bytes
        self.break_tokens = len(self.library.encode(BREAK))

    def __call__(self, column: pa.Array) -> list[int]:
        """The number of tokens of each text."""
        counts = [0] * len(column)
        owners, pieces, held = [], [], 0
        for at, value in enumerate(column):
            text = value.as_py() or ""
            for number, piece in enumerate(cut(text, self.joined, self.piece_chars)):
                owners.append((at, number > 0))
                pieces.append(BREAK + piece if number else piece)
                held += len(piece.encode("utf-8", "surrogatepass"))
                if held >= self.portion_bytes:
                    self.add(counts, owners, pieces)
                    owners, pieces, held = [], [], 0
        self.add(counts, owners, pieces)
        return counts

    def add(self, counts: list[int], owners: list[tuple[int, bool]], pieces: list[str]) -> None:
        if pieces:
            for (at, follows), ids in zip(owners, self.library.encode(pieces, num_threads=1)):
                counts[at] += len(ids) - self.break_tokens * follows


def token_counts(
    docs: DataFrame, model: Model | None = None, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT_TOKENS
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row per document."""
    shared = docs.sparkSession.sparkContext.broadcast(model or load(default_path()))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(shared.value)
        for batch in batches:
            column = batch.column("text")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pc.binary_length(column).cast(pa.int64()),
                    pa.array(counter(column), type=pa.int64()),
                ],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    schema = T.StructType(
        [rows.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    )
    return map_batches(rows, run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
