"""Byte-level BPE by a sentencepiece model that is serialised straight from a rank file.

Every byte stands for one character (``chr(256 + byte)``), so that a vocabulary entry becomes a
piece of such characters.  Piece i has score -i: sentencepiece merges the pair whose union scores
best, leftmost first, which is the merge order of the ranks.  The model has identity normalisation
and no white-space rules; nothing is trained.  Decoding maps the pieces' characters back to bytes.
"""

from __future__ import annotations

import base64
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame, functions as F, types as T

from .common import map_batches, text_of

#: First of the 256 characters that stand for bytes.
BYTE_BASE = 256
#: Pre-tokens that a task remembers; beyond it the memory is emptied, which only costs time.
REMEMBERED = 300_000
_BPE, _NORMAL, _UNKNOWN = 2, 1, 2  # enumerators of the public sentencepiece_model.proto
_TO_CHARS = {b: chr(BYTE_BASE + b) for b in range(256)}


def read_ranks(path: str) -> list[bytes]:
    """Entries of a rank file, ordered by rank; ranks must run from 0 without gaps."""
    entries: dict[int, bytes] = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                entries[int(rank)] = base64.b64decode(token)
    if sorted(entries) != list(range(len(entries))):
        raise ValueError("ranks must be 0, 1, 2, ...")
    return [entries[i] for i in range(len(entries))]


def to_chars(raw: bytes) -> str:
    return raw.decode("latin-1").translate(_TO_CHARS)


def to_bytes(chars: str) -> bytes:
    return bytes(ord(c) - BYTE_BASE for c in chars)


def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    return bytes([*out, value])


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _block(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def serialise(vocabulary: list[bytes]) -> bytes:
    """The ModelProto: piece i is vocabulary entry i; the unknown piece comes last."""

    def piece(text: str, score: float, kind: int) -> bytes:
        return _block(1, _block(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind))

    trainer = _number(3, _BPE) + _number(4, len(vocabulary) + 1) + _number(40, len(vocabulary))
    trainer += b"".join(_number(field, 2**64 - 1) for field in (41, 42, 43))  # no begin, end and padding pieces
    normaliser = _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    pieces = [piece(to_chars(entry), -float(rank), _NORMAL) for rank, entry in enumerate(vocabulary)]
    return b"".join([*pieces, piece("<unk>", 0.0, _UNKNOWN), _block(2, trainer), _block(3, normaliser)])


@lru_cache(maxsize=4)
def _processor(model: bytes) -> tuple[sentencepiece.SentencePieceProcessor, dict[str, bytes]]:
    return sentencepiece.SentencePieceProcessor(model_proto=model), {}


@lru_cache(maxsize=4)
def _inverse(model: bytes) -> list[bytes]:
    """Bytes of each id, from the model's own pieces."""
    processor = _processor(model)[0]
    return [b"" if processor.is_unknown(i) else to_bytes(processor.id_to_piece(i)) for i in range(processor.get_piece_size())]


def encode_texts(texts: list[str], model: bytes, pattern: str) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit integers."""
    processor, known = _processor(model)
    split = [regex.findall(pattern, text) for text in texts]
    fresh = list(set().union(*split).difference(known))
    if len(known) + len(fresh) > REMEMBERED:
        known.clear()
        fresh = list(set().union(*split))
    for token, ids in zip(fresh, processor.encode([to_chars(t.encode()) for t in fresh], num_threads=1)):
        known[token] = struct.pack(f"<{len(ids)}I", *ids)
    return [b"".join([known[t] for t in tokens]) for tokens in split]


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text (binary: little-endian unsigned 32-bit).

    A null or empty text has no ids.  Rows are independent: repeated rows, null ids and further
    columns pass through, and an empty table stays empty.  ``pattern`` must cover every character;
    each of its matches is encoded by itself.  The model (about the size of the rank file) is
    sent to the tasks with the function.
    """
    model_at = docs.sparkSession.sparkContext.broadcast(serialise(read_ranks(ranks_path)))  # bounded by the vocabulary file
    schema = T.StructType([T.StructField("_row", docs.drop(ids).select(F.struct("*")).schema[0].dataType), T.StructField(ids, T.BinaryType())])

    def work(batch):
        coded = encode_texts(batch.column("_text").to_pylist(), model_at.value, pattern)
        yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(coded, pa.binary())], ["_row", ids])

    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != ids]).alias("_row"), text_of(text).alias("_text"))
    return map_batches(given, schema, work).select("_row.*", ids)


def decode(docs: DataFrame, ranks_path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` with the bytes that ``ids`` stand for; null ids give no bytes."""
    model_at = docs.sparkSession.sparkContext.broadcast(serialise(read_ranks(ranks_path)))
    others = docs.drop(decoded).columns
    schema = T.StructType([*docs.select(*[F.col(f"`{c}`") for c in others]).schema, T.StructField(decoded, T.BinaryType())])

    def work(batch):
        pieces = _inverse(model_at.value)
        out = [b"".join([pieces[i] for i in np.frombuffer(x or b"", "<u4").tolist()]) for x in batch.column(ids).to_pylist()]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], pa.array(out, pa.binary())], [*others, decoded])

    return map_batches(docs, schema, work)


def digests(docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of the encoding and its decoding."""
    coded = decode(encode(docs.select(doc_id, F.col(text).alias("text")), ranks_path, pattern).drop("text"), ranks_path)
    return coded.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
