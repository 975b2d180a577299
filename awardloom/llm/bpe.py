"""Byte-level BPE through a sentencepiece model that is serialised from a rank file.

The model holds one piece a vocabulary entry, each byte written as one character of its own and each
piece scored by its negative rank, so that the best-scored merge is the one of lowest rank, leftmost
first; its normalisation is the identity. A pre-token that is an entry itself is that entry. Decoding
maps the pieces' characters back to bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import ids_and_texts, in_batches, prepare, worker_state
from .tokens import WordEncoder, packed, spoken

#: Byte b is written as the character FIRST + b: letters, none of them white space.
FIRST = 0x100
TO_PIECE = {b: FIRST + b for b in range(256)}
TO_BYTE = {FIRST + b: b for b in range(256)}
#: Field numbers and values of the public sentencepiece model format (fixed values).
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE, SCORE, TYPE, NORMAL, UNKNOWN = 1, 2, 3, 1, 2
MODEL_TYPE, BPE, VOCAB_SIZE, UNK_ID, BOS_ID, EOS_ID, PAD_ID = 3, 2, 4, 40, 41, 42, 43
NAME, DUMMY_PREFIX, EXTRA_SPACES, ESCAPE_SPACES = 1, 3, 4, 5


def read_ranks(path: str) -> list[bytes]:
    """Vocabulary entries in rank order from lines ``base64 rank``."""
    with open(path, "rb") as f:
        ranks = {int(b): base64.b64decode(a) for a, b in map(bytes.split, f)}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"{path}: ranks are not 0 to n - 1")
    return [ranks[i] for i in range(len(ranks))]


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _block(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def as_piece(entry: bytes) -> str:
    return entry.decode("latin-1").translate(TO_PIECE)


def as_bytes(piece: str) -> bytes:
    return piece.translate(TO_BYTE).encode("latin-1")


def serialise(entries: list[bytes]) -> bytes:
    """A sentencepiece BPE model: entry i has id i and score -i, the unknown piece comes last."""

    def piece(text: str, score: float, kind: int) -> bytes:
        number = _varint(SCORE << 3 | 5) + struct.pack("<f", score)
        return _block(PIECES, _block(PIECE, text.encode()) + number + _number(TYPE, kind))

    n = len(entries)
    trainer = _number(MODEL_TYPE, BPE) + _number(VOCAB_SIZE, n + 1) + _number(UNK_ID, n)
    trainer += b"".join(_number(f, -1) for f in (BOS_ID, EOS_ID, PAD_ID))
    normalizer = _block(NAME, b"identity") + b"".join(_number(f, 0) for f in (DUMMY_PREFIX, EXTRA_SPACES, ESCAPE_SPACES))
    body = b"".join(piece(as_piece(e), -float(i), NORMAL) for i, e in enumerate(entries))
    return body + piece("<unk>", 0.0, UNKNOWN) + _block(TRAINER, trainer) + _block(NORMALIZER, normalizer)


class Codec:
    """Encoding and decoding of texts; one a worker."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(read_ranks(path)))
        n = self.model.get_piece_size() - 1
        self.bytes_of = [as_bytes(p) for p in self.model.id_to_piece(list(range(n)))]
        self.whole = {b: packed([i]) for i, b in enumerate(self.bytes_of)}
        self.split = regex.compile(pattern).findall
        self.encode = WordEncoder(self._words, lambda t: self._words(["\n" + t])[0], b"", False)
        self.encode.line_feed = self._pre_tokens(["\n"])["\n"]

    def _words(self, words: list[str]) -> list[bytes]:
        cut = [self.split(spoken(w)) for w in words]
        known = self._pre_tokens(list(set().union(*cut)))
        return [b"".join(map(known.__getitem__, c)) for c in cut]

    def _pre_tokens(self, pre: list[str]) -> dict[str, bytes]:
        raw = {p: p.encode("utf-8") for p in pre}
        out = {p: self.whole[b] for p, b in raw.items() if b in self.whole}
        rest = [p for p in pre if p not in out]
        out.update(zip(rest, map(packed, self.model.encode([as_piece(raw[p]) for p in rest])) if rest else ()))
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def codec(path: str, pattern: str) -> Codec:
    return worker_state(("codec", path, pattern), lambda: Codec(path, pattern))


def encode(spark: SparkSession, docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (binary, little-endian 32-bit integers) of each row; a null text is an empty one.

    No row moves: every text is encoded where it is read. An empty table gives no rows, repeated rows repeat.
    """
    prepare(spark)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = codec(path, pattern).encode(batch.column(1).to_pylist())
        return pa.record_batch([batch.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return ids_and_texts(docs, id_col, text_col).mapInArrow(in_batches(run, keeps=True), "doc_id long, ids binary")


def decode(spark: SparkSession, encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, data (the bytes) of rows of ``encode``; null ids give null data."""
    prepare(spark)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        turn = codec(path, pattern).decode
        data = [None if ids is None else turn(ids) for ids in batch.column(1).to_pylist()]
        return pa.record_batch([batch.column(0), pa.array(data, pa.binary())], names=["doc_id", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(in_batches(run, keeps=True), "doc_id long, data binary")


def round_trip(spark: SparkSession, docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes each text, then decodes the ids, in one pass."""
    prepare(spark)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = codec(path, pattern)
        ids = c.encode(batch.column(1).to_pylist())
        return pa.record_batch(
            [
                batch.column(0),
                pa.array([len(b) // 4 for b in ids], pa.int64()),
                pa.array([hashlib.sha256(b).hexdigest() for b in ids]),
                pa.array([hashlib.sha256(c.decode(b)).hexdigest() for b in ids]),
            ],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return ids_and_texts(docs, id_col, text_col).mapInArrow(in_batches(run, keeps=True), schema)
