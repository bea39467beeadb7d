"""Byte-level BPE encoding and decoding (operator 3).

The rank file becomes a sentencepiece BPE model without any training: every byte is mapped to one
printable character, every vocabulary entry is a piece scored by its negative rank, and the
normaliser is the identity. Pre-tokens are split in the JVM, encoded once per distinct value of a
batch, and decoded by the inverse map. There is no shuffle: a lost executor only repeats its splits.

Defined cases: a null text counts as empty; an empty text has no ids and decodes to nothing; other
columns of the input are ignored; repeated rows give repeated results; a null id stays null.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyspark.llm.common import gather, offsets, pre_tokens, small_batches

#: Byte b is written as the character with code point BYTE_BASE + b.
BYTE_BASE = 0x100
#: Distinct pre-tokens a worker remembers before it starts afresh.
REMEMBERED = 200_000


def read_ranks(path: str) -> list[bytes]:
    """Vocabulary bytes in rank order; ranks must run from 0 without gaps."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    ranks = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must run from 0 without gaps")
    return [ranks[k] for k in range(len(ranks))]


def mapped(data: bytes) -> str:
    return data.decode("latin-1").translate(_TO_MAPPED)


_TO_MAPPED = {b: chr(BYTE_BASE + b) for b in range(256)}


def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    return bytes([*out, value])


def _field(number: int, payload: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(payload)) + payload


def _number(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """A serialised sentencepiece BPE model; piece ids are ranks, the unknown piece comes last."""
    normal, unknown, bpe = 1, 2, 2
    out = []
    for rank, token in enumerate(tokens):
        score = b"\x15" + np.float32(-rank).tobytes()
        out.append(_field(1, _field(1, mapped(token).encode()) + score + _number(3, normal)))
    out.append(_field(1, _field(1, b"<unk>") + b"\x15" + np.float32(0).tobytes() + _number(3, unknown)))
    trainer = _number(3, bpe) + _number(40, len(tokens))
    identity = _field(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join([*out, _field(2, trainer), _field(3, identity)])


class Encoder:
    """Ids of pre-tokens. A pre-token that is itself an entry is that entry, as rank files mean it."""

    def __init__(self, model: bytes, tokens: list[bytes]):
        import sentencepiece

        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.whole = {mapped(t): (k,) for k, t in enumerate(tokens)}
        self.known: dict[str, tuple[int, ...]] = {}

    def ids(self, distinct: list[str]) -> list[tuple[int, ...]]:
        if len(self.known) > REMEMBERED:
            self.known = {}
        fresh = [p for p in distinct if p not in self.known]
        left = []
        for text, chars in zip(fresh, (mapped(p.encode()) for p in fresh)):
            if chars in self.whole:
                self.known[text] = self.whole[chars]
            else:
                left.append((text, chars))
        if left:
            found = self.pieces.encode([chars for _, chars in left], num_threads=1)
            self.known.update((text, tuple(ids)) for (text, _), ids in zip(left, found))
        return [self.known[p] for p in distinct]


def encode(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``ids`` array<int>: the ids of every whole text."""
    small_batches(docs.sparkSession)
    tokens = read_ranks(ranks_path)
    shared = docs.sparkSession.sparkContext.broadcast((sentencepiece_model(tokens), tokens))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*shared.value)
        for batch in batches:
            pieces = batch.column(1)
            coded = pieces.flatten().dictionary_encode()
            distinct = encoder.ids(coded.dictionary.to_pylist())
            sizes = np.fromiter(map(len, distinct), np.int64, len(distinct))
            flat = np.fromiter((i for ids in distinct for i in ids), np.int32, int(sizes.sum()))
            codes = coded.indices.to_numpy(zero_copy_only=False)
            lengths = sizes[codes]
            ids = gather(flat, offsets(sizes)[:-1][codes], lengths)
            bounds = offsets(lengths)[pieces.offsets.to_numpy() - pieces.offsets[0].as_py()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))],
                [id_col, "ids"])

    rows = docs.select(F.col(id_col), pre_tokens(F.coalesce(text_col, F.lit(""))).alias("pieces"))
    return rows.mapInArrow(run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id") -> DataFrame:
    """``id_col``, ``ids``, ``decoded`` binary: the bytes the ids stand for. Null ids count as none."""
    small_batches(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value
        table = np.frombuffer(b"".join(tokens), np.uint8)
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        starts = offsets(sizes)[:-1]
        for batch in batches:
            column = batch.column(1)
            ids = column.flatten().to_numpy(zero_copy_only=False)
            lengths = sizes[ids]
            data = gather(table, starts[ids], lengths)
            bounds = offsets(lengths)[column.offsets.to_numpy() - column.offsets[0].as_py()]
            binary = pa.Array.from_buffers(pa.binary(), len(column), [
                None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([batch.column(0), column, binary], [id_col, "ids", "decoded"])

    rows = encoded.select(id_col, F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    kind = encoded.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, decoded binary")
