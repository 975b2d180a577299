"""Token-id files whose document boundaries are Elias-Fano sequences.

A shard file holds the ids of its documents one after the other (2 bytes each where the vocabulary
allows, else 4), then three structures and a trailer: the n + 1 document boundaries and the document
ids, both as Elias-Fano sequences. Such a sequence of n values below u takes about 2 + log2(u / n) bits
a value: the low bits stand packed, the high bits as a unary bit vector, and the position of every 64th
set bit is kept, so that one value is found without reading the others and no table of 64-bit offsets
exists. Documents stand in ascending id order in a shard and from shard to shard; null ids come first,
rows that share an id are ordered by their ids' bytes.
"""

from __future__ import annotations

import posixpath
import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Committed, prepare, crc, filesystem, ids_and_texts, in_batches
from .tokens import tokenizer_encoder

MAGIC = b"EFTOKEN1"
#: Set bits between two kept positions.
STEP = 64
#: Documents in a shard file, and files at most (beyond that, shards grow).
SHARD_DOCUMENTS = 8192
MOST_SHARDS = 100_000
#: Bytes that a reader takes at once.
READ_BYTES = 8 << 20

HEAD = struct.Struct("<QQQ")
TRAILER = struct.Struct("<QQQQBxxxxxxx8s")


class EliasFano:
    """A non-decreasing sequence of integers >= 0 in near-minimal space."""

    def __init__(self, n: int, universe: int, width: int, low: np.ndarray, high: np.ndarray, marks: np.ndarray):
        self.n, self.universe, self.width = n, universe, width
        self.low, self.high, self.marks = low, high, marks

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        universe = int(values[-1]) + 1 if n else 1
        width = max(0, (universe // max(n, 1)).bit_length() - 1)
        ones = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        bits = np.zeros((int(ones[-1]) + 1 if n else 0), dtype=np.uint8)
        bits[ones] = 1
        planes = np.zeros((n, width), dtype=np.uint8)
        for k in range(width):
            planes[:, k] = (values >> np.uint64(k)) & np.uint64(1)
        pack = lambda b: np.packbits(b, bitorder="little")
        return cls(n, universe, width, pack(planes.ravel()), pack(bits), ones[::STEP].astype("<u8"))

    def to_bytes(self) -> bytes:
        parts = [self.low.tobytes(), self.high.tobytes(), self._marks().tobytes()]
        return HEAD.pack(self.n, self.universe - 1, len(self.high)) + b"".join(parts)

    def _marks(self) -> np.ndarray:
        return self.marks.astype("<u4" if 8 * len(self.high) < 1 << 32 else "<u8")

    @classmethod
    def from_bytes(cls, raw: bytes) -> EliasFano:
        n, top, n_high = HEAD.unpack_from(raw)
        universe = top + 1
        width = max(0, (universe // max(n, 1)).bit_length() - 1)
        n_low = (n * width + 7) // 8
        low = np.frombuffer(raw, np.uint8, n_low, HEAD.size)
        high = np.frombuffer(raw, np.uint8, n_high, HEAD.size + n_low)
        kind = "<u4" if 8 * n_high < 1 << 32 else "<u8"
        return cls(n, universe, width, low, high, np.frombuffer(raw, kind, -1, HEAD.size + n_low + n_high))

    def select(self, i: int) -> int:
        """Value i: from the nearest kept position, step over set bits; then add the low bits."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.marks[i // STEP]), i % STEP
        byte = at // 8
        here = self.high[byte] >> (at % 8) << (at % 8)
        while (ones := int(here).bit_count()) <= left:
            left -= ones
            byte += 1
            here = self.high[byte]
        bit = np.flatnonzero(np.unpackbits(np.uint8(here), bitorder="little"))[left]
        low = 0
        for k in range(self.width):
            p = i * self.width + k
            low |= (int(self.low[p // 8]) >> (p % 8) & 1) << k
        return (8 * byte + int(bit) - i) << self.width | low

    def between(self, start: int, end: int) -> np.ndarray:
        """Values start to end (exclusive) as unsigned 64-bit integers."""
        if start >= end:
            return np.empty(0, dtype=np.uint64)
        first = int(self.marks[start // STEP]) // 8
        last = int(self.marks[(end - 1) // STEP + 1]) // 8 if (end - 1) // STEP + 1 < len(self.marks) else len(self.high) - 1
        ones = 8 * first + np.flatnonzero(np.unpackbits(self.high[first : last + 1], bitorder="little"))
        ones = ones[np.searchsorted(ones, int(self.marks[start // STEP])) + start % STEP :][: end - start]
        out = (ones - np.arange(start, end)).astype(np.uint64) << np.uint64(self.width)
        for k in range(self.width):
            p = np.arange(start, end) * self.width + k
            out |= ((self.low[p // 8] >> (p % 8).astype(np.uint8)) & np.uint8(1)).astype(np.uint64) << np.uint64(k)
        return out


class ShardWriter:
    """Appends documents to one shard file; ids are written as they come, the structures at the end."""

    def __init__(self, stream, width: int):
        self.stream, self.kind = stream, np.dtype("<u2" if width == 2 else "<u4")
        self.lengths: list[int] = []
        self.doc_ids: list[int] = []
        self.nulls = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.stream.write(ids)
        self.lengths.append(len(ids) // self.kind.itemsize)
        if doc_id is None:
            self.nulls += 1
        else:
            self.doc_ids.append(doc_id)

    def close(self) -> tuple[int, int]:
        bounds = np.concatenate([[0], np.cumsum(self.lengths, dtype=np.uint64)]).astype(np.uint64)
        base = self.doc_ids[0] if self.doc_ids else 0
        names = EliasFano.of(np.array([d - base for d in self.doc_ids], dtype=np.uint64)).to_bytes()
        starts = EliasFano.of(bounds).to_bytes()
        self.stream.write(starts)
        self.stream.write(names)
        self.stream.write(
            TRAILER.pack(len(starts), len(names), self.nulls, base & (1 << 64) - 1, self.kind.itemsize, MAGIC)
        )
        return len(self.lengths), int(bounds[-1])


class ShardReader:
    """Random access to a shard file: a document's ids without reading others'."""

    def __init__(self, path: str):
        fs, at = filesystem(path)
        self.file = fs.open_input_file(at)
        size = self.file.size()
        n_starts, n_names, self.nulls, base, width, magic = TRAILER.unpack(self._read(size - TRAILER.size, TRAILER.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is no token-id file")
        self.base = base - (1 << 64) if base >> 63 else base
        self.kind = np.dtype("<u2" if width == 2 else "<u4")
        end = size - TRAILER.size - n_names
        self.starts = EliasFano.from_bytes(self._read(end - n_starts, n_starts))
        self.names = EliasFano.from_bytes(self._read(end, n_names))
        self.n = self.starts.n - 1

    def _read(self, start: int, size: int) -> bytes:
        self.file.seek(start)
        return self.file.read(size)

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.base + self.names.select(i - self.nulls)

    def ids(self, i: int) -> np.ndarray:
        start, end = self.starts.select(i), self.starts.select(i + 1)
        return np.frombuffer(self._read(start * self.kind.itemsize, (end - start) * self.kind.itemsize), self.kind)

    def find(self, doc_id: int) -> int | None:
        """Position of the first document with this id: binary search over select."""
        low, high = 0, self.names.n
        while low < high:
            mid = (low + high) // 2
            low, high = (mid + 1, high) if self.base + self.names.select(mid) < doc_id else (low, mid)
        found = low < self.names.n and self.base + self.names.select(low) == doc_id
        return low + self.nulls if found else None

    def documents(self) -> Iterator[tuple[list[int | None], np.ndarray, list[np.ndarray]]]:
        """(document ids, starts, ids) of runs of documents that are read at once."""
        bounds = self.starts.between(0, self.n + 1).astype(np.int64)
        i = 0
        while i < self.n:
            j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + READ_BYTES // self.kind.itemsize, "right")) - 1)
            raw = self._read(int(bounds[i]) * self.kind.itemsize, int(bounds[j] - bounds[i]) * self.kind.itemsize)
            ids = np.split(np.frombuffer(raw, self.kind), bounds[i + 1 : j] - bounds[i])
            known = self.names.between(max(i - self.nulls, 0), max(j - self.nulls, 0)).tolist()
            yield [None] * max(0, min(j, self.nulls) - i) + [self.base + k for k in known], bounds[i:j], ids
            i = j


class TokenFiles(NamedTuple):
    """A written folder: per shard its file, documents, and the ids that stand before it."""

    folder: str
    shards: list[tuple[str, int, int]]


def write_token_files(
    spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int, folder: str, id_col: str = "doc_id",
    text_col: str = "text", shard_documents: int = SHARD_DOCUMENTS, vocabulary: int | None = None,
) -> TokenFiles:
    """Encode every document, append ``end_id`` and write shard files in ascending id order.

    Ids are dealt to shards by quantiles of the document ids, so one shuffle of packed ids is all that
    moves, and a shard is one task that streams its sorted documents to its file. A null text is an empty
    one; an empty table gives no file. The file of a repeated attempt replaces the earlier one whole.
    """
    prepare(spark)
    table = ids_and_texts(docs, id_col, text_col)
    count = table.count()
    shards = min(MOST_SHARDS, -(-count // shard_documents))
    if not count:
        return TokenFiles(folder, [])
    if vocabulary is None:
        from tokenizers import Tokenizer

        vocabulary = Tokenizer.from_file(tokenizer).get_vocab_size()
    width = 2 if max(vocabulary, end_id + 1) <= 1 << 16 else 4
    bounds: list[int] = []
    if shards > 1:
        cuts = [i / shards for i in range(1, shards)]
        bounds = table.agg(F.percentile_approx("doc_id", cuts, max(10_000, 10 * shards))).first()[0] or []
    ends = np.array(bounds, dtype=np.int64)
    kind = np.dtype("<u2" if width == 2 else "<u4")

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = tokenizer_encoder(tokenizer)
        end = np.array([end_id], kind).tobytes()
        ids = [np.frombuffer(b, "<u4").astype(kind).tobytes() + end for b in encoder(batch.column(1).to_pylist())]
        names = batch.column(0)
        shard = np.searchsorted(ends, names.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False), "left")
        return pa.record_batch(
            [pa.array(shard.astype(np.int32)), names, pa.array(ids, pa.binary())], names=["shard", "doc_id", "ids"]
        )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in _runs(batches):
            name = f"shard-{shard:06d}.ids"
            with Committed(folder, name) as stream:
                out = ShardWriter(stream, width)
                for doc_id, ids in rows:
                    out.add(doc_id, ids)
                n, tokens = out.close()
            yield pa.record_batch(
                [pa.array([shard], pa.int32()), pa.array([name]), pa.array([n], pa.int64()), pa.array([tokens], pa.int64())],
                names=["shard", "file", "documents", "tokens"],
            )

    done = (
        table.mapInArrow(in_batches(encode, keeps=True), "shard int, doc_id long, ids binary")
        .repartitionById(shards, "shard")
        .sortWithinPartitions("shard", F.asc_nulls_first("doc_id"), "ids")
        .mapInArrow(write, "shard int, file string, documents long, tokens long")
        .collect()
    )
    listed, before = [], 0
    for row in sorted(done):
        listed.append((row.file, row.documents, before))
        before += row.tokens
    return TokenFiles(folder, listed)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple[int | None, bytes]]]]:
    """(shard, its rows) of a task's sorted rows; the rows are streamed."""
    from itertools import groupby

    rows = (
        row for b in batches for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist())
    )
    for shard, group in groupby(rows, key=lambda r: r[0]):
        yield shard, ((doc_id, ids) for _, doc_id, ids in group)


def read_token_files(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """A row per document, from the files alone: doc_id, start, n_tokens, ids (little-endian, 32 bits)."""
    return _read(spark, files, "doc_id long, start long, n_tokens long, ids binary", lambda ids: ids)


def digest_token_files(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """As ``read_token_files``, with crc32 of the ids in place of the ids."""
    return _read(spark, files, "doc_id long, start long, n_tokens long, ids_crc32 long", crc)


def _read(spark: SparkSession, files: TokenFiles, schema: str, last) -> DataFrame:
    if not files.shards:
        return spark.createDataFrame([], schema)
    names = [part.split()[0] for part in schema.split(",")]
    kind = pa.binary() if names[-1] == "ids" else pa.int64()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                name, _, before = files.shards[shard]
                for doc_ids, starts, ids in ShardReader(posixpath.join(files.folder, name)).documents():
                    yield pa.record_batch(
                        [
                            pa.array(doc_ids, pa.int64()),
                            pa.array(starts + before, pa.int64()),
                            pa.array([len(x) for x in ids], pa.int64()),
                            pa.array([last(x.astype("<u4").tobytes()) for x in ids], kind),
                        ],
                        names=names,
                    )

    return spark.range(0, len(files.shards), 1, len(files.shards)).mapInArrow(read, schema)
