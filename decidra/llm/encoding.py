"""Problem 6: the whole corpus encoded with a public byte-level BPE tokenizer.

The vocabulary's byte strings become the pieces of a sentencepiece BPE model
that is serialised here, without training: each byte is mapped to a printable
character, a piece's score is its negative rank, and the normaliser is the
identity, so sentencepiece merges exactly the pairs that the ranks name.  Texts
are cut into pre-tokens by the tokenizer's pattern and these are encoded; the
inverse mapping decodes.

Defined results: null and empty texts have the empty list; every row stays, also
repeated ones; the ids of a row depend on its text only, whole and however long.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZERS = "/opt/tokenizers"
#: Fixed value: the pre-token pattern of the byte_bpe_50k vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pre-tokens remembered by a worker, and the length up to which they are.
MEMO, MEMO_LENGTH = 400_000, 48
ROWS = 1000


def byte_characters() -> list[str]:
    """A printable character for each byte: Latin-1's own where it is visible, else the next one from U+0100."""
    out, spare = [], 0x100
    for b in range(256):
        visible = 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF
        out.append(chr(b) if visible else chr(spare))
        spare += not visible
    return out


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file in the order of their ranks."""
    ranks = {}
    for line in Path(path).read_bytes().splitlines():
        if line:
            token, rank = line.split()
            ranks[int(rank)] = base64.b64decode(token)
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"{path}: ranks are not consecutive")
    return [ranks[i] for i in range(len(ranks))]


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int | float) -> bytes:
    """A protobuf field: bytes by length, an int as a varint, a float in four bytes."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def serialised_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece model whose piece i is token i; the unknown piece comes last and never occurs."""
    chars = byte_characters()
    model = bytearray()
    for rank, token in enumerate(tokens):
        model += _field(1, _field(1, "".join(chars[b] for b in token).encode()) + _field(2, float(-rank)) + _field(3, 1))
    model += _field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))
    bpe = 2
    model += _field(2, _field(3, bpe) + _field(4, len(tokens) + 1) + _field(40, len(tokens)) + _field(41, -1) + _field(42, -1) + _field(43, -1))
    model += _field(3, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0))
    return bytes(model)


class Encoder:
    """Encodes and decodes with a serialised model."""

    def __init__(self, model: bytes, pattern: str = PATTERN):
        import regex
        import sentencepiece

        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.cut = regex.compile(pattern).findall
        self.chars = byte_characters()
        self.from_latin = str.maketrans({chr(b): c for b, c in enumerate(self.chars) if chr(b) != c})
        self.to_byte = {c: b for b, c in enumerate(self.chars)}
        self.memo: dict[str, list[int]] = {}

    def mapped(self, token: str) -> str:
        return token.encode("utf-8", "replace").decode("latin-1").translate(self.from_latin)

    def encode_all(self, texts: list[str]) -> Iterator[list[int]]:
        """The ids of each text."""
        cut = [self.cut(t) if t else [] for t in texts]
        if len(self.memo) > MEMO:
            self.memo.clear()
        memo = self.memo
        new = list({t for ts in cut for t in ts if t not in memo})
        if new:
            memo.update(zip(new, self.pieces.encode([self.mapped(t) for t in new], num_threads=1)))
        for ts in cut:
            out: list[int] = []
            for t in ts:
                out += memo[t]
            yield out
        for t in new:
            if len(t) > MEMO_LENGTH:
                del memo[t]

    def decode(self, ids: list[int]) -> str:
        return bytes(self.to_byte[c] for c in "".join(self.pieces.id_to_piece(ids) if len(ids) else [])).decode("utf-8", "replace")


_encoders: dict[int, Encoder] = {}


def _encode(model: bytes, pattern: str):
    key = hash((model, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _encoders:
            _encoders.clear()
            _encoders[key] = Encoder(model, pattern)
        encoder = _encoders[key]
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                flat: list[np.ndarray] = []
                ends = [0]
                for ids in encoder.encode_all(batch.column(1).to_pylist()):
                    flat.append(np.array(ids, np.int32))
                    ends.append(ends[-1] + len(ids))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(flat) if flat else np.empty(0, np.int32)))], names=["doc_id", "ids"])

    return run


def encode_corpus(documents: DataFrame, tokenizer: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken", pattern: str = PATTERN) -> DataFrame:
    """(doc_id, ids) of every document. The model, of fixed size, goes to each task with the code."""
    model = serialised_model(read_ranks(tokenizer))
    return documents.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(_encode(model, pattern), "doc_id long, ids array<int>")


def _decode(model: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([encoder.decode(ids or []) for ids in batch.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    return run


def decode_corpus(encoded: DataFrame, tokenizer: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken") -> DataFrame:
    """(doc_id, text) of (doc_id, ids): the inverse; empty lists become empty texts."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode(serialised_model(read_ranks(tokenizer))), "doc_id long, text string")
