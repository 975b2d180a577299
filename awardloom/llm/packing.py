"""Vector bin packing of training examples into sequences by the dot-product heuristic.

An example is a vector: tokens, one segment, loss-bearing tokens. A sequence is a bin with a limit on
each. The bin being filled takes, of the examples at hand that still fit, the one whose vector has the
largest dot product with the bin's remaining room (both as shares of the limits): it favours examples
that are large where room is left. Every input task packs its own rows, so no row moves; a task holds at
most ``POOL`` examples at a time, and every example ends up in a sequence.

Texts are taken as instruction data: of each document's tokens a first share is its prompt, which bears no loss, and the
rest its answer, every token of which does. So pieces of one length differ in loss, and a sequence is filled by
answers up to its loss limit and by prompts beside them.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare, crc, ids_and_texts
from .tokens import tokenizer_encoder

#: Examples at hand of one task.
POOL = 512
#: Sequence numbers of a task start at its number times this.
TASK_STEP = 1 << 40


class Limits(NamedTuple):
    tokens: int
    segments: int
    loss: int


class Pool:
    """Examples at hand: the columns of their vectors (tokens, 1, loss), and the tokens before their first loss."""

    def __init__(self, limits: Limits, size: int = POOL):
        self.limits, self.size = limits, size
        self.tokens, self.loss, self.free_head = (np.zeros(size, dtype=np.int64) for _ in range(3))
        self.examples: list = [None] * size
        self.places = list(range(size - 1, -1, -1))
        self.used = np.zeros(size, dtype=bool)

    def add(self, tokens: int, loss: int, example, free_head: int = 0) -> None:
        i = self.places.pop()
        self.tokens[i], self.loss[i], self.free_head[i] = tokens, loss, free_head
        self.examples[i] = example
        self.used[i] = True

    def __len__(self) -> int:
        return self.size - len(self.places)

    def _best(self, can: np.ndarray, room: list[int]) -> int | None:
        """Of the examples that can, the one with the largest dot product with the room; ties go to the lowest place."""
        limits = self.limits
        # One segment each: that part of the product is the same for all.
        worth = self.tokens * (room[0] / max(limits.tokens, 1) ** 2) + self.loss * (room[2] / max(limits.loss, 1) ** 2)
        i = int(np.where(can, worth, -1.0).argmax())
        return i if can[i] else None

    def best(self, room: list[int]) -> int | None:
        """The best of those that fit the room (tokens, segments, loss)."""
        if room[1] < 1:
            return None
        return self._best(self.used & (self.tokens <= room[0]) & (self.loss <= room[2]), room)

    def best_to_cut(self, room: list[int]) -> int | None:
        """The best of those of which at least a token fits."""
        if room[0] < 1 or room[1] < 1:
            return None
        return self._best(self.used & (self.free_head > 0) if room[2] < 1 else self.used, room)

    def take(self, i: int):
        self.used[i] = False
        self.places.append(i)
        example, self.examples[i] = self.examples[i], None
        return (int(self.tokens[i]), 1, int(self.loss[i])), example

    def fill(self) -> list:
        """One bin: (vector, example) in order of placement."""
        room, placed = list(self.limits), []
        while (i := self.best(room)) is not None:
            vector, example = self.take(i)
            room = [r - x for r, x in zip(room, vector)]
            placed.append((vector, example))
        return placed


def pack(spark: SparkSession, items: DataFrame, limits: Limits, id_col: str, tokens_col: str, loss_col: str) -> DataFrame:
    """sequence_id, offset for whole examples: columns id, n_tokens, n_loss, sequence_id, offset, fits.

    Null or negative counts are 0. An example beyond a limit can't be placed: it comes back alone in a
    sequence of its own with fits = false. Repeated ids are separate examples; an empty table gives no rows.
    """
    prepare(spark)
    count = lambda c: F.greatest(F.coalesce(F.col(c).cast("long"), F.lit(0)), F.lit(0))
    table = items.select(F.col(id_col).cast("long").alias("id"), count(tokens_col).alias("n_tokens"), count(loss_col).alias("n_loss"))
    names = ["id", "n_tokens", "n_loss", "sequence_id", "offset", "fits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool, next_id = Pool(limits), TaskContext.get().partitionId() * TASK_STEP

        def rows(bins: list[list], fits: bool) -> pa.RecordBatch:
            nonlocal next_id
            out = []
            for placed in bins:
                offset = 0
                for (tokens, _, loss), name in placed:
                    out.append((name, tokens, loss, next_id, offset, fits))
                    offset += tokens
                next_id += 1
            kinds = [pa.int64()] * 5 + [pa.bool_()]
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

        for batch in batches:
            bins, alone = [], []
            for name, tokens, loss in zip(*(c.to_pylist() for c in batch.columns)):
                if tokens > limits.tokens or loss > limits.loss or limits.segments < 1:
                    alone.append([((tokens, 1, loss), name)])
                    continue
                if len(pool) == pool.size:
                    bins.append(pool.fill())
                pool.add(tokens, loss, name)
            for some, fits in ((bins, True), (alone, False)):
                if some:
                    yield rows(some, fits)
        while len(pool):
            yield rows([pool.fill()], True)

    return table.mapInArrow(run, "id long, n_tokens long, n_loss long, sequence_id long, offset long, fits boolean")


class Piece(NamedTuple):
    """Some of a document's ids, from ``start`` on; those before ``answer`` (counted from the document's start) bear no loss."""

    doc_id: int | None
    ids: np.ndarray
    start: int
    doc_tokens: int
    answer: int

    @property
    def free_head(self) -> int:
        return min(len(self.ids), max(0, self.answer - self.start))

    @property
    def loss(self) -> int:
        return len(self.ids) - self.free_head

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return self._replace(ids=self.ids[:n]), self._replace(ids=self.ids[n:], start=self.start + n)


def pack_texts(
    spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int, limits: Limits, id_col: str = "doc_id",
    text_col: str = "text", prompt_percent: int = 50,
) -> DataFrame:
    """Tokenise whole texts, cut them freely and pack the pieces; one row a piece.

    The first ``prompt_percent`` of a document's tokens (rounded down) are its prompt and bear no loss, the others do.
    Documents are cut into examples of half a sequence, which are packed by the heuristic; where nothing fits any more, the
    example with the largest dot product is cut to fill the rest. A sequence that ends before it is full, because of the limit on
    segments or on loss, or as nothing is left, is cut back to a power of two, which needs no padding: whatever the texts,
    there is none. Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, n_loss. A null text is an
    empty one (its end id alone); repeated rows are separate documents; an empty table gives no rows. All limits must be
    positive.
    """
    if min(limits) < 1:
        raise ValueError("all limits must be positive")
    prepare(spark)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "n_loss"]
    example = max(1, limits.tokens // 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = tokenizer_encoder(tokenizer), np.array([end_id], "<u4")
        pool, next_id = Pool(limits), TaskContext.get().partitionId() * TASK_STEP
        out: list[tuple] = []

        def put(p: Piece) -> None:
            pool.add(len(p.ids), p.loss, p, p.free_head)

        def fill(most: int) -> None:
            """One sequence of ``most`` tokens (a power of two or the limit), or of fewer, then a power of two."""
            nonlocal next_id
            room, pieces = [most, limits.segments, limits.loss], []
            while room[0] and room[1]:
                i = pool.best(room)
                if i is not None:
                    _, p = pool.take(i)
                elif (i := pool.best_to_cut(room)) is not None:
                    _, p = pool.take(i)
                    p, rest = p.cut(min(room[0], p.free_head + room[2]))
                    put(rest)
                else:
                    break
                room = [room[0] - len(p.ids), room[1] - 1, room[2] - p.loss]
                pieces.append(p)
            length = most - room[0]
            if room[0]:
                length = 1 << length.bit_length() - 1
            offset = 0
            for p in pieces:
                if offset >= length:
                    put(p)
                    continue
                if offset + len(p.ids) > length:
                    p, rest = p.cut(length - offset)
                    put(rest)
                out.append((p.doc_id, p.start, len(p.ids), crc(p.ids.tobytes()), p.doc_tokens, next_id, offset, p.loss))
                offset += len(p.ids)
            next_id += 1

        def rows() -> Iterator[pa.RecordBatch]:
            if out:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out)], names=names)
                out.clear()

        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), encoder(batch.column(1).to_pylist())):
                ids = np.concatenate([np.frombuffer(raw, "<u4"), end])
                p = Piece(doc_id, ids, 0, len(ids), len(ids) * prompt_percent // 100)
                while len(p.ids):
                    head, p = p.cut(example)
                    if len(pool) == pool.size:
                        fill(limits.tokens)
                    put(head if len(ids) <= example else head._replace(ids=head.ids.copy()))
            yield from rows()
        while left := int(pool.tokens[pool.used].sum()):
            fill(limits.tokens if left >= limits.tokens else 1 << left.bit_length() - 1)
        yield from rows()

    schema = ", ".join(f"{n} long" for n in names)
    return ids_and_texts(docs, id_col, text_col).mapInArrow(run, schema)
