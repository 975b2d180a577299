"""Hard negatives by an inverted multi-index over two half-space codebooks.

Vectors are cut into two halves, each with a codebook of its own; a pair of entries is a cell. The largest half score
that a query can have under an entry is its product with the entry plus its length times the entry's radius (the largest
distance of a half vector to the entry), the smallest is the product less that. A search visits a shard's cells by
falling sum of the two upper bounds (the multi-sequence walk over the two sorted lists), scores the rows of a cell
exactly, passes over cells whose lower bound is above the window, and stops once no later cell can hold a row of the
result: the window is then certified.

Rows are dealt to shards of bounded size along the cells, so a shard holds few cells and its anchors lie near to it. Each
anchor is first searched in its own shard. The scores found there are floors for the rest: a directory of the
shards' entries and radii drops every pair of anchor block and shard that no anchor's bound allows, and only the remaining
pairs travel. The codebooks are fitted on a bounded sample (``SAMPLE`` rows); every row is indexed and the
results are exact whatever the codebooks are.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .ballkmeans import assign, sound
from .common import in_batches, prepare, written

#: Rows that the codebooks are fitted on (about; at most twice as many), and the steps of the fit.
SAMPLE, STEPS = 16_384, 6
#: Rows of a shard, mean rows of a cell, entries of a codebook at most, shards of a piece of the directory.
SHARD, CELL, ENTRIES, CHUNK = 8_192, 64, 1_024, 1_024
EXACT = 1 << 53

Books = dict[int, tuple[np.ndarray, np.ndarray]]


class Shard(NamedTuple):
    """Rows in cell order. ``ua``, ``ub``: the entries present in either half, ``ra``, ``rb`` their radii."""

    rows: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    asks: np.ndarray
    vectors: np.ndarray
    cells: dict[tuple[int, int], tuple[int, int]]  # places in ua and ub -> first row and end
    ua: np.ndarray
    ra: np.ndarray
    ub: np.ndarray
    rb: np.ndarray


class Anchors(NamedTuple):
    """Anchors of one shard; ``floors``: scores that a further row must reach, by anchor and window; ``lows`` and ``highs``: the windows."""

    rows: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    lows: list[list[int]]
    highs: list[list[int]]
    floors: list[list[int]]


def fit(sample: np.ndarray, entries: int, seed: int = 7) -> np.ndarray:
    """A codebook by a few Lloyd steps from random different rows."""
    kinds = np.unique(sample, axis=0).astype(np.float64)
    book = kinds[np.random.default_rng(seed).choice(len(kinds), min(entries, len(kinds)), replace=False)]
    for _ in range(STEPS):
        own, _ = assign(sample, book)
        counts = np.bincount(own, minlength=len(book))
        sums = np.stack([np.bincount(own, sample[:, j], minlength=len(book)) for j in range(sample.shape[1])], axis=1) if sample.shape[1] else book
        book = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], book)
    return book


def build(rows, ids, labels, asks, vectors: np.ndarray, a: np.ndarray, b: np.ndarray, books: tuple[np.ndarray, np.ndarray]) -> Shard:
    """The index of some rows in the order of their entries (a, b)."""
    half = books[0].shape[1]
    ua, ia = np.unique(a, return_inverse=True)
    ub, ib = np.unique(b, return_inverse=True)
    v = vectors.astype(np.float64)
    away = [np.sqrt(((x - book[k]) ** 2).sum(axis=1)) for x, book, k in ((v[:, :half], books[0], a), (v[:, half:], books[1], b))]
    ra, rb = np.zeros(len(ua)), np.zeros(len(ub))
    np.maximum.at(ra, ia, away[0])
    np.maximum.at(rb, ib, away[1])
    _, first, count = np.unique(ia * len(ub) + ib, return_index=True, return_counts=True)
    cells = {(int(ia[f]), int(ib[f])): (int(f), int(f + c)) for f, c in zip(first, count)}
    most = int(np.abs(vectors).max(initial=0))
    kind = next(k for k in (np.int16, np.int32, np.int64) if most <= np.iinfo(k).max)
    return Shard(rows, ids, labels, asks, vectors.astype(kind), cells, ua, ra, ub, rb)


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))


class Queries:
    """Products of some anchors with both codebooks, and the lengths of their halves."""

    def __init__(self, vectors: np.ndarray, books: tuple[np.ndarray, np.ndarray]):
        v, half = vectors.astype(np.float64), books[0].shape[1]
        self.p, self.q = v[:, :half] @ books[0].T, v[:, half:] @ books[1].T
        self.m, self.n = _norms(v[:, :half]), _norms(v[:, half:])
        #: Above any rounding of the bounds.
        self.slack = 1e-9 * (1 + sum(np.abs(x).max(axis=1, initial=0) for x in (self.p, self.q)) + (self.m + self.n) * max([1, *_norms(books[0]), *_norms(books[1])]))

    def bounds(self, ua, ra, ub, rb) -> tuple[np.ndarray, np.ndarray]:
        """By anchor: the largest and the smallest score that a row under these entries can have."""
        p, q, m, n = self.p[:, ua], self.q[:, ub], self.m[:, None] * ra, self.n[:, None] * rb
        slack = self.slack * (1 + max(ra.max(), rb.max()))
        return (p + m).max(axis=1) + (q + n).max(axis=1) + slack, (p - m).min(axis=1) + (q - n).min(axis=1) - slack


def walk(shard: Shard, queries: Queries, i: int) -> Iterator[tuple[float, float, int, int]]:
    """(upper bound, lower bound, first row, end) of the shard's cells for anchor i, by falling upper bound."""
    slack = queries.slack[i] * (1 + max(shard.ra.max(), shard.rb.max()))
    p, m = queries.p[i, shard.ua], queries.m[i] * shard.ra
    q, n = queries.q[i, shard.ub], queries.n[i] * shard.rb
    one, two = np.argsort(-(p + m)), np.argsort(-(q + n))
    top, bottom = ((p + m)[one].tolist(), (q + n)[two].tolist()), ((p - m)[one].tolist(), (q - n)[two].tolist())
    one, two = one.tolist(), two.tolist()
    heap = [(-(top[0][0] + top[1][0]), 0, 0)]
    while heap:
        negated, x, y = heapq.heappop(heap)
        if (span := shard.cells.get((one[x], two[y]))) is not None:
            yield -negated + slack, bottom[0][x] + bottom[1][y] - slack, *span
        if y + 1 < len(two):
            heapq.heappush(heap, (-(top[0][x] + top[1][y + 1]), x, y + 1))
        if y == 0 and x + 1 < len(one):
            heapq.heappush(heap, (-(top[0][x + 1] + top[1][0]), x + 1, 0))


def _exact(vectors: np.ndarray, most: int) -> np.ndarray:
    """The rows in a type in which their inner products with components up to ``most`` are exact."""
    reach = int(np.abs(vectors).max(initial=0)) * most * vectors.shape[1]
    return vectors.astype(np.float64) if reach < EXACT else vectors.astype(np.int64) if reach < 1 << 62 else vectors.astype(np.int64).astype(object)


def search(shard: Shard, anchors: Anchors, books: tuple[np.ndarray, np.ndarray], k: int, same: bool) -> list[list[list[tuple[int, int]]]]:
    """By anchor and window: the up to k (score, id) of rows of the anchor's label (or of all others), best first, whose
    scores lie in the window and reach the floor. Rows of the anchor's id take no part; ties go to the smaller id."""
    most = max(int(np.abs(x).max(initial=0)) for x in (shard.vectors, anchors.vectors))
    v, asked = _exact(shard.vectors, most), _exact(anchors.vectors, most)
    queries, out = Queries(anchors.vectors, books), []
    for i, (name, label) in enumerate(zip(anchors.ids.tolist(), anchors.labels.tolist())):
        may = (shard.labels == label) if same else (shard.labels != label)
        may &= shard.ids != name
        lows, highs = anchors.lows[i], anchors.highs[i]
        least = [max(x, y) for x, y in zip(lows, anchors.floors[i])]
        best: list[list[tuple[int, int]]] = [[] for _ in lows]
        for upper, lower, a, b in walk(shard, queries, i):
            if not least or upper < min(least):
                break  # every window is certified
            if lower > max(highs):
                continue
            at = a + np.flatnonzero(may[a:b])
            if not len(at):
                continue
            scores = v[at] @ asked[i]
            for w, (low, high) in enumerate(zip(least, highs)):
                if upper < low:
                    continue
                for j in np.flatnonzero((scores >= low) & (scores <= high)).tolist():
                    found = (int(scores[j]), -int(shard.ids[at[j]]))
                    if len(best[w]) < k:
                        heapq.heappush(best[w], found)
                    elif found > best[w][0]:
                        heapq.heapreplace(best[w], found)
                if len(best[w]) == k:
                    least[w] = max(least[w], best[w][0][0])
        out.append([[(s, -n) for s, n in sorted(heap, reverse=True)] for heap in best])
    return out


#: A window without bounds: scores fit 64 bits.
OPEN = 1 << 62


def _codebooks(table: DataFrame, count: int, cell: int) -> Books:
    """By vector length, the codebooks of both halves, fitted on a sample of rows by a hash of their number."""
    picked = table.where(F.expr(f"pmod(xxhash64(row, 11), {max(count, 1)}) < {SAMPLE}")).select("v").limit(2 * SAMPLE)
    by_length: dict[int, list] = {}
    for r in picked.toLocalIterator():
        by_length.setdefault(len(r.v), []).append(r.v)
    entries = int(np.clip(np.sqrt(count / cell), 1, ENTRIES))
    books = {}
    for d, rows in by_length.items():
        x = np.array(rows, dtype=np.float64)
        books[d] = fit(x[:, : d // 2], entries), fit(x[:, d // 2 :], entries)
    return books


def _books_for(books: Books, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of a length that the sample lacks lie in one cell around zero."""
    return books.get(d) or (np.zeros((1, d // 2)), np.zeros((1, d - d // 2)))


def _dump(value) -> bytes:
    return pickle.dumps(tuple(value))


def _flat(batch_column: pa.Array, d: int) -> np.ndarray:
    return batch_column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _indexed(table: DataFrame, books: Books, count: int, size: int) -> DataFrame:
    """shard, d, index, entries: the rows in shards along the cells. ``entries`` is what the directory holds of a shard."""

    def place(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lengths = batch.column("d").to_numpy()
        for d in np.unique(lengths).tolist():
            part = batch.filter(pa.array(lengths == d))
            v, (one, two) = _flat(part.column("v"), d).astype(np.float64), _books_for(books, d)
            a, b = (assign(x, book)[0].astype(np.int32) for x, book in ((v[:, : d // 2], one), (v[:, d // 2 :], two)))
            yield pa.record_batch([*part.columns, pa.array(a), pa.array(b)], names=[*part.schema.names, "a", "b"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        number = TaskContext.get().partitionId() << 32

        def row(part: pa.Table, d: int) -> pa.RecordBatch:
            nonlocal number
            number += 1
            take = lambda c: part.column(c).to_numpy()
            s = build(take("row"), take("vec_id"), take("label"), take("asks"), _flat(part.column("v").combine_chunks(), d), take("a"), take("b"), _books_for(books, d))
            entries = _dump((s.ua, s.ra, s.ub, s.rb))
            return pa.record_batch([pa.array([number - 1]), pa.array([d], pa.int32()), pa.array([_dump(s)], pa.binary()), pa.array([entries], pa.binary())], names=["shard", "d", "index", "entries"])

        def flush(all_: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            table = pa.Table.from_batches(held)
            at = 0
            while at < table.num_rows and (all_ or table.num_rows - at > size):
                d = table.column("d")[at].as_py()
                part = table.slice(at, size)
                part = part.slice(0, int((part.column("d").to_numpy() == d).sum()))  # sorted by length
                yield row(part, d)
                at += part.num_rows
            held = table.slice(at).to_batches()

        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) > size:
                yield from flush(False)
        if held:
            yield from flush(True)

    kinds = "row long, vec_id long, label long, asks boolean, d int, v array<long>"
    placed = table.mapInArrow(in_batches(place), f"{kinds}, a int, b int")
    order = ("d", "a", "b", "row")
    dealt = placed.repartitionByRange(max(1, -(-count // size)), *order).sortWithinPartitions(*order)
    return written(dealt.mapInArrow(pack, "shard long, d int, index binary, entries binary"), "multi-index")


def _directory(shards: DataFrame, chunk: int) -> DataFrame:
    """chunk, part: the entries and radii of some ``chunk`` shards a row."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))]
        for at in range(0, len(rows), chunk):
            yield pa.record_batch([pa.array([_dump(rows[at : at + chunk])], pa.binary())], names=["part"])

    parts = shards.select("shard", "d", "entries").coalesce(max(1, -(-shards.count() // chunk))).mapInArrow(pack, "part binary")
    return written(parts.withColumn("chunk", F.monotonically_increasing_id()), "multi-directory")


def _routed(blocks: DataFrame, directory: DataFrame, books: Books) -> DataFrame:
    """block, shard: for every block of anchors the other shards that may hold a row of one of its windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, rows = None, ()
        for batch in batches:
            for block, d, raw, chunk, part in zip(*(c.to_pylist() for c in batch.columns)):
                if chunk != last:
                    last, rows = chunk, [(s, n, pickle.loads(e)) for s, n, e in pickle.loads(part)]
                anchors = Anchors(*pickle.loads(raw))
                asking = [i for i, x in enumerate(anchors.lows) if x]
                if not asking:
                    continue
                queries = Queries(anchors.vectors[asking], _books_for(books, d))
                least = np.array([min(max(x, y) for x, y in zip(anchors.lows[i], anchors.floors[i])) for i in asking], dtype=np.float64)
                most = np.array([max(anchors.highs[i]) for i in asking], dtype=np.float64)
                to = []
                for shard, n, entries in rows:
                    if n == d and shard != block:
                        upper, lower = queries.bounds(*entries)
                        if ((upper >= least) & (lower <= most)).any():
                            to.append(shard)
                if to:
                    yield pa.record_batch([pa.array([block] * len(to), pa.int64()), pa.array(to, pa.int64())], names=["block", "shard"])

    chunks = [r.chunk for r in directory.select("chunk").collect()]  # one a chunk of shards
    met = blocks.select("block", "d", "anchors", F.explode(F.array(*[F.lit(c).cast("long") for c in chunks])).alias("chunk")).join(directory, "chunk")
    return met.select("block", "d", "anchors", "chunk", "part").mapInArrow(run, "block long, shard long")


#: What a found row carries: its anchor, the window's place and positive, and its own id and score.
FOUND = "anchor long, anchor_id long, slot int, positive_id long, positive_score long, vec_id long, score long"
_KINDS = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]


def _as_rows(anchors: Anchors, positives: list[list[tuple[int, int]]], found: list) -> list[tuple]:
    out = []
    for row, name, windows, of in zip(anchors.rows.tolist(), anchors.ids.tolist(), found, positives):
        out += [(row, name, w, *of[w], n, s) for w, best in enumerate(windows) for s, n in best]
    return out


def _searched(blocks: DataFrame, directory: DataFrame, shards: DataFrame, books: Books, k: int, same: bool) -> DataFrame:
    """``FOUND`` rows of each block's own shard and all others that may matter; blocks: block, d, anchors, positives."""

    def load(raw: bytes, cache: list) -> Shard:
        if not cache or cache[0] != raw:
            cache[:] = [raw, Shard(*pickle.loads(raw))]
        return cache[1]

    def at_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, d, raw, positives, index in zip(*(c.to_pylist() for c in batch.columns)):
                anchors = Anchors(*pickle.loads(raw))
                found = search(load(index, []), anchors, _books_for(books, d), k, same)
                floors = [[best[-1][0] if len(best) == k else -OPEN for best in windows] for windows in found]
                anchors = anchors._replace(floors=floors)
                yield pa.record_batch(
                    [pa.array([block]), pa.array([d], pa.int32()), pa.array([_dump(anchors)], pa.binary()), pa.array([positives], pa.binary()), pa.array([_dump(found)], pa.binary())],
                    names=["block", "d", "anchors", "positives", "found"],
                )

    def unpacked(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for raw, positives, found in zip(*(c.to_pylist() for c in batch.columns)):
            yield from _batch(_as_rows(Anchors(*pickle.loads(raw)), pickle.loads(positives), pickle.loads(found)))

    def away(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: list = []
        for batch in batches:
            for d, raw, positives, index in zip(*(c.to_pylist() for c in batch.columns)):
                anchors = Anchors(*pickle.loads(raw))
                yield from _batch(_as_rows(anchors, pickle.loads(positives), search(load(index, cache), anchors, _books_for(books, d), k, same)))

    held = shards.select(F.col("shard").alias("at"), "index")
    home = blocks.join(held, F.col("block") == F.col("at")).select("block", "d", "anchors", "positives", "index")
    home = written(home.mapInArrow(at_home, "block long, d int, anchors binary, positives binary, found binary"), "anchors-home")
    routed = written(_routed(home, directory, books), "anchors-routed")
    pairs = routed.join(home.select("block", "d", "anchors", "positives"), "block").join(held, F.col("shard") == F.col("at"))
    rest = pairs.select("d", "anchors", "positives", "index").mapInArrow(away, FOUND)
    own = home.select("anchors", "positives", "found").mapInArrow(in_batches(unpacked), FOUND)
    ranked = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
    best = own.unionByName(rest).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return written(best, "anchors-found")


def _batch(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    if rows:
        names = [c.split()[0] for c in FOUND.split(", ")]
        yield pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*rows), _KINDS)], names=names)


def _asking(anchors_of: Callable[[Shard], Anchors]):
    """Batches of shards to batches of their blocks of anchors."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for shard, d, raw in zip(*(c.to_pylist() for c in batch.columns)):
            index = Shard(*pickle.loads(raw))
            if index.asks.any():
                anchors = anchors_of(index)
                nothing = [[(0, 0)]] * len(anchors.ids)
                yield pa.record_batch(
                    [pa.array([shard]), pa.array([d], pa.int32()), pa.array([_dump(anchors)], pa.binary()), pa.array([_dump(nothing)], pa.binary())],
                    names=["block", "d", "anchors", "positives"],
                )

    return in_batches(run)


BLOCKS = "block long, d int, anchors binary, positives binary"


def mine(
    spark: SparkSession, vectors: DataFrame, is_anchor: Column, scale: float = 256.0, positives: int = 5, negatives: int = 10,
    low: int = 30, high: int = 90, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    shard: int = SHARD, cell: int = CELL, chunk: int = CHUNK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components are floor(scale * x), a row's score is its inner product with the anchor; higher scores come first, ties go
    to the smaller id. An anchor's positives are its first ``positives`` other rows of the same (integer) label. For each
    anchor and positive, the first ``negatives`` rows of other labels with low * positive_score <= 100 * negative_score
    <= high * positive_score, ranked from 1. Fewer give fewer rows. Rows with a null id, label or vector, an empty
    vector, or a null or non-finite component take no part. Vectors meet only vectors of their own length. Rows that
    share an id are separate candidates, but none for anchors of that id, and anchors of their own, whose results are all
    returned. An empty table gives no rows; other columns play no part. Scores must fit 62-bit integers. ``shard``, ``cell`` and ``chunk`` bound sizes only: no result depends on them.
    """
    prepare(spark)
    value = F.col(vector_col)
    whole = F.transform(value, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    there = sound(value) & (F.size(value) > 0) & F.col(id_col).isNotNull() & F.col(label_col).isNotNull()
    table = vectors.where(there).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"), F.size(value).alias("d"), whole.alias("v"),
    )
    table = written(table, "vectors")
    count = table.count()
    books = _codebooks(table, count, cell)
    shards = _indexed(table, books, count, shard)
    directory = _directory(shards, chunk)

    def all_of(index: Shard) -> Anchors:
        some = np.flatnonzero(index.asks)
        n = len(some)
        return Anchors(index.rows[some], index.ids[some], index.labels[some], index.vectors[some], [[-OPEN]] * n, [[OPEN]] * n, [[-OPEN]] * n)

    asked = written(shards.select("shard", "d", "index").mapInArrow(_asking(all_of), BLOCKS), "anchors")
    first = _searched(asked, directory, shards, books, positives, same=True)

    # Each anchor's windows; a block has at most SHARD anchors with a few positives each.
    each = first.groupBy("anchor").agg(F.collect_list(F.struct("rank", "vec_id", "score")).alias("found"))
    names = asked.select("block", "anchors").mapInArrow(in_batches(_members), "block long, anchor long")
    by_block = names.join(each, "anchor").groupBy("block").agg(F.collect_list(F.struct("anchor", "found")).alias("found"))

    def windows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for block, d, raw, found in zip(*(c.to_pylist() for c in batch.columns)):
            anchors = Anchors(*pickle.loads(raw))
            by_anchor = {x["anchor"]: [(y["vec_id"], y["score"]) for y in sorted(x["found"], key=lambda y: y["rank"])] for x in found}
            of = [by_anchor.get(r, []) for r in anchors.rows.tolist()]
            lows = [[-((-low * s) // 100) for _, s in some] for some in of]
            highs = [[(high * s) // 100 for _, s in some] for some in of]
            anchors = anchors._replace(lows=lows, highs=highs, floors=[[-OPEN] * len(some) for some in of])
            yield pa.record_batch([pa.array([block]), pa.array([d], pa.int32()), pa.array([_dump(anchors)], pa.binary()), pa.array([_dump(of)], pa.binary())], names=["block", "d", "anchors", "positives"])

    aimed = asked.select("block", "d", "anchors").join(by_block, "block").select("block", "d", "anchors", "found")
    aimed = written(aimed.mapInArrow(in_batches(windows), BLOCKS), "anchors-windows")
    best = _searched(aimed, directory, shards, books, negatives, same=False)
    return best.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def _members(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for block, raw in zip(*(c.to_pylist() for c in batch.columns)):
        rows = Anchors(*pickle.loads(raw)).rows
        yield pa.record_batch([pa.array(np.full(len(rows), block)), pa.array(rows)], names=["block", "anchor"])
