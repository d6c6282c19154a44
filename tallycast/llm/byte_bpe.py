"""Byte-level BPE through a sentencepiece model made from a rank file.

The vocabulary is not trained: each token of the rank file becomes a piece of
a BPE model, its bytes mapped to printable characters and its score the
negative rank, so that the model merges in rank order.  The model is written
in its serialised form here, with identity normalisation.  Texts are split by
the pre-token pattern; a pre-token that is itself a token stands for itself,
all others go through the model.  Decoding maps pieces back to bytes.

Null and empty texts have no tokens and decode to no bytes.  Any text decodes
to its UTF-8 bytes, since every single byte must be a token.  Rows are
independent: nothing is shuffled, other columns pass through, and a lost
executor costs its own tasks.  The driver reads the rank file once and ships
the model (about 1 MB) with the tasks; each task keeps a cache of pre-tokens
that is emptied when it reaches ``CACHE_ENTRIES``, which changes no result.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallycast.llm.words import row_slices

CACHE_ENTRIES = 50_000
SLICE_BYTES = 1 << 20
DECODE_BLOCK = 1 << 18
UNKNOWN = "⁇"


def read_ranks(path: str) -> list[bytes]:
    """Tokens in rank order; ranks must be 0, 1, 2 and so on, and hold every byte."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = dict(sorted((int(rank), base64.b64decode(token)) for token, rank in pairs))
    if list(tokens) != list(range(len(tokens))):
        raise ValueError("ranks have gaps")
    if len({token for token in tokens.values() if len(token) == 1}) != 256:
        raise ValueError("not every byte is a token")
    return list(tokens.values())


def byte_characters() -> list[str]:
    """The printable character of each byte: itself if printable in Latin-1, else
    the next character from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in set(shown)]
    table = {byte: chr(byte) for byte in shown} | {byte: chr(256 + n) for n, byte in enumerate(others)}
    return [table[byte] for byte in range(256)]


def _number(value: int) -> bytes:
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    return bytes([*out, value])


def _field(place: int, value: bytes | int | float) -> bytes:
    """One field of a serialised message: bytes, float or integer."""
    if isinstance(value, bytes):
        return _number(place << 3 | 2) + _number(len(value)) + value
    if isinstance(value, float):
        return _number(place << 3 | 5) + struct.pack("<f", value)
    return _number(place << 3) + _number(value)


def serialised_model(tokens: list[bytes]) -> bytes:
    """A BPE model whose piece ids are the ranks; the last piece is the unknown one."""
    shown = byte_characters()
    out = bytearray()
    for rank, token in enumerate(tokens):
        piece = "".join(shown[byte] for byte in token).encode()
        out += _field(1, _field(1, piece) + _field(2, float(-rank)) + _field(3, 1))
    out += _field(1, _field(1, UNKNOWN.encode()) + _field(2, float(-len(tokens))) + _field(3, 2))
    bpe = _field(3, 2) + _field(4, len(tokens) + 1)
    identity = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return bytes(out + _field(2, bpe) + _field(3, identity))


class Encoder:
    """Encodes texts one slice at a time, with a bounded cache of pre-tokens."""

    def __init__(self, tokens: list[bytes], model: bytes, pattern: str) -> None:
        import regex
        import sentencepiece

        self.find = regex.compile(pattern).findall
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.shown = {byte: character for byte, character in enumerate(byte_characters())}
        self.rank = {token: rank for rank, token in enumerate(tokens)}
        self.cache: dict[str, bytes] = {}

    def _learn(self, pieces: list[str]) -> None:
        rest, mapped = [], []
        for piece in pieces:
            raw = piece.encode()
            rank = self.rank.get(raw)
            if rank is not None:
                self.cache[piece] = struct.pack("<I", rank)
            else:
                rest.append(piece)
                mapped.append(raw.decode("latin-1").translate(self.shown))
        if rest:
            for piece, ids in zip(rest, self.model.encode(mapped, out_type=int, num_threads=1)):
                self.cache[piece] = struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        out = []
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()
        for text in texts:
            pieces = self.find(text) if text else []
            known = self.cache
            new = [piece for piece in dict.fromkeys(pieces) if piece not in known]
            if new:
                self._learn(new)
            out.append(b"".join([known[piece] for piece in pieces]))
        return out


Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _encoding(tokens: list[bytes], pattern: str, text: str, names: list[str], kept: list[int]) -> Batches:
    """Batches as slices: the columns at the places ``kept``, then the ids of the texts,
    under ``names``."""
    model = serialised_model(tokens)

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokens, model, pattern)
        for batch in rows:
            for part in row_slices(batch, text, SLICE_BYTES):
                found = pa.array(encoder.encode(part.column(text).to_pylist()), type=pa.binary())
                yield pa.RecordBatch.from_arrays([*map(part.column, kept), found], names=names)

    return batches


def encode(docs: DataFrame, ranks_path: str, pattern: str, *, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text as a column of little-endian 32-bit
    numbers, which replaces one of that name."""
    docs = docs.drop(ids)
    schema = T.StructType([*docs.schema.fields, T.StructField(ids, T.BinaryType())])
    kept = list(range(len(schema) - 1))
    return docs.mapInArrow(_encoding(read_ranks(ranks_path), pattern, text, schema.names, kept), schema)


class Decoder:
    """Bytes of ids, through the inverse of the byte mapping."""

    def __init__(self, tokens: list[bytes]) -> None:
        shown = byte_characters()
        back = {character: byte for byte, character in enumerate(shown)}
        pieces = ["".join(shown[byte] for byte in token) for token in tokens]
        raw = [bytes(back[character] for character in piece) for piece in pieces]
        self.length = np.array([len(token) for token in raw], dtype=np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]])
        self.flat = np.frombuffer(b"".join(raw), dtype=np.uint8)

    def decode(self, ids: bytes) -> bytes:
        numbers, out = np.frombuffer(ids, dtype="<u4"), []
        for at in range(0, len(numbers), DECODE_BLOCK):
            block = numbers[at:at + DECODE_BLOCK]
            length = self.length[block]
            end = np.cumsum(length)
            place = np.arange(end[-1]) + np.repeat(self.start[block] - end + length, length)
            out.append(self.flat[place].tobytes())
        return b"".join(out)


def _decoding(tokens: list[bytes], ids: str, names: list[str]) -> Batches:
    """Batches as slices: their columns, then the bytes that the ids stand for, under ``names``."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(tokens)
        for batch in parts:
            for part in row_slices(batch, ids, SLICE_BYTES):
                found = [decoder.decode(one or b"") for one in part.column(ids).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, type=pa.binary())], names=names)

    return batches


def decode(rows: DataFrame, ranks_path: str, *, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``rows`` with the bytes that the ids stand for, in place of a column of that
    name; null ids give no bytes."""
    rows = rows.drop(decoded)
    schema = T.StructType([*rows.schema.fields, T.StructField(decoded, T.BinaryType())])
    return rows.mapInArrow(_decoding(read_ranks(ranks_path), ids, schema.names), schema)


def round_trip(
    docs: DataFrame, ranks_path: str, pattern: str, *, text: str = "text", ids: str = "ids", decoded: str = "decoded",
) -> DataFrame:
    """``encode``, then ``decode`` of what it gave, one after the other in the same
    Python worker: a task needs one instead of two, and texts do not come back.
    Columns are those of ``docs`` without the text, the ids and the decoded bytes."""
    docs = docs.drop(ids, decoded)
    tokens = read_ranks(ranks_path)
    kept = [place for place, name in enumerate(docs.columns) if name != text]
    binary = [T.StructField(name, T.BinaryType()) for name in (ids, decoded)]
    schema = T.StructType([*[docs.schema[place] for place in kept], *binary])
    there, back = _encoding(tokens, pattern, text, schema.names[:-1], kept), _decoding(tokens, ids, schema.names)
    return docs.mapInArrow(lambda rows: back(there(rows)), schema)
