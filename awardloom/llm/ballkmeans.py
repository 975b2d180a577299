"""Vector codes by ball k-means: each part of a vector becomes the number of its codebook's nearest entry.

An entry and the parts assigned to it are a ball: its radius is the largest distance of a part to the entry. If two
entries are at least twice that radius apart, no part of the ball can change to the other, so only nearer
entries are neighbours of the ball. Sorted by their distance they cut the ball into a stable core, which no
neighbour reaches and which is skipped, and rings around it: a part may change only to those neighbours that lie
within twice its own distance. All distances are squared integers, so the tests are exact and ties go to the
lower entry.

The vectors lie in a written table together with their entries. A round is one pass that reassigns the rows of each
task, with the few entries as the only thing sent, and one that sums parts by entry in each task before Spark adds them up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_dir
from .common import discard, prepare

#: Components that a task holds at a time: the rows of one ball are looked at together.
AT_ONCE = 1 << 20
#: Scaled components must stay below this, so that squared distances fit 64 bits.
REACH = 1 << 22


def exact(x: np.ndarray, length: int) -> np.ndarray:
    """Floating point where all squared distances of such rows are exact in it, else 64-bit integers (for parts of up to 32,768 components)."""
    most = int(np.abs(x).max(initial=0))
    if most >= REACH:
        raise ValueError(f"a scaled component of {most} is beyond {REACH}")
    return x.astype(np.float64 if 16 * max(length, 1) * (most + 1) ** 2 < 1 << 53 else np.int64)


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of rows and entries."""
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(axis=1)[None, :]


def assign(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each row, compared with all entries, and the squared distance; ties go to the lower entry."""
    d = squared(x, entries)
    own = d.argmin(axis=1)
    return own, d[np.arange(len(x)), own]


def reassign(x: np.ndarray, own: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``assign``, given each row's entry of before: only rows in rings are compared, with their rings' neighbours."""
    gaps = squared(entries, entries)
    away = ((x - entries[own]) ** 2).sum(axis=1)
    out, least = own.copy(), away.copy()
    order = np.argsort(own, kind="stable")
    edges = np.searchsorted(own[order], np.arange(len(entries) + 1))
    for ball in np.flatnonzero(np.diff(edges)).tolist():
        members = order[edges[ball] : edges[ball + 1]]
        reach = 4 * away[members]
        neighbours = np.flatnonzero(gaps[ball] <= reach.max())
        neighbours = neighbours[neighbours != ball]
        neighbours = neighbours[np.argsort(gaps[ball][neighbours], kind="stable")]
        ring = np.searchsorted(gaps[ball][neighbours], reach, side="right")  # neighbours that each member may change to
        wide = np.ceil(np.log2(np.maximum(ring, 1))).astype(int)
        for w in np.unique(wide[ring > 0]).tolist():  # rings whose numbers of neighbours are within a power of two go together
            here = np.flatnonzero((wide == w) & (ring > 0))
            some = np.sort(neighbours[: ring[here].max()])
            rows = members[here]
            d = squared(x[rows], entries[some])
            best = d.argmin(axis=1)
            near, name = d[np.arange(len(rows)), best], some[best]
            moved = (near < least[rows]) | (near == least[rows]) & (name < own[rows])
            out[rows[moved]], least[rows[moved]] = name[moved], near[moved]
    return out, least


def cuts(length: int, parts: int) -> list[slice]:
    """Consecutive parts of equal length; the first ones are one longer where that can't be."""
    ends = np.cumsum([length // parts + (p < length % parts) for p in range(parts)]).tolist()
    return [slice(a, b) for a, b in zip([0, *ends], ends)]


def _matrix(column: pa.Array | pa.ChunkedArray, length: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def _codes(column: pa.ChunkedArray, parts: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u2").reshape(-1, parts).astype(np.int64)


def _gathered(batches: Iterable[pa.RecordBatch], length: int, at_once: int) -> Iterator[pa.Table]:
    """The rows of a task in tables of about ``at_once`` components."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows * length >= at_once:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held)


def _sums(table: DataFrame, books: list[np.ndarray], length: int, at_once: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(sums, counts) of the parts assigned to each entry, by part position. The driver sees one number a component."""
    parts = len(books)
    sizes = [k.size + len(k) for k in books]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _gathered(batches, length, at_once):
            v, codes, out = _matrix(part.column(0), length), _codes(part.column(1), parts), []
            for p, span in enumerate(cuts(length, parts)):
                order = np.argsort(codes[:, p], kind="stable")
                entry, first, count = np.unique(codes[order, p], return_index=True, return_counts=True)
                sums, counts = np.zeros(books[p].shape, np.int64), np.zeros(len(books[p]), np.int64)
                if sums.size:
                    sums[entry] = np.add.reduceat(v[order, span], first, axis=0)
                counts[entry] = count
                out += [sums.ravel(), counts]
            total = np.concatenate(out)
            slots = np.flatnonzero(total)
            yield pa.record_batch([pa.array(slots), pa.array(total[slots])], names=["slot", "total"])

    found = table.select("v", "codes").mapInArrow(run, "slot long, total long").groupBy("slot").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    whole = np.zeros(sum(sizes), dtype=object)
    for r in found.toLocalIterator():
        whole[r.slot] = int(r.total)
    out, at = [], 0
    for book, size in zip(books, sizes):
        out.append((whole[at : at + book.size].reshape(book.shape), whole[at + book.size : at + size]))
        at += size
    return out


def sound(value):
    """Column: the vector is there and holds no null and no component that isn't finite."""
    return value.isNotNull() & F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))


def compress(
    spark: SparkSession, vectors: DataFrame, scale: float = 1024.0, parts: int = 4, entries: int = 256, rounds: int = 4,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", at_once: int = AT_ONCE,
) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error, label_error: one row a vector; the codebooks, one (entries x components) array a part).

    Components are floor(scale * x). Rows whose vector is null or holds a null or non-finite component are dropped.
    Vectors are cut into ``parts`` equal consecutive parts (the first ones one longer where the length can't be divided).
    Each codebook starts as that part of the ``entries`` rows of the smallest ids (null ids last, ties by vector; fewer
    rows give fewer entries). ``rounds`` times every part goes to its nearest entry and entries become
    floor(sum / count); unused ones stay. Then parts are assigned once more. ``code`` has two hexadecimal digits a
    part (four beyond 256 entries), ``error`` the summed squared distances, ``label_error`` the errors of all rows of
    the label (nulls together). All vectors have the length of the smallest id's non-empty one; others have no
    code and no error. Repeated rows are rows of their own; an empty table gives no rows and empty codebooks. Other
    columns play no part. A scaled component of 2**22 or more is an error.
    """
    prepare(spark)
    value = F.col(vector_col)
    whole = F.transform(value, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    table = vectors.where(sound(value)).select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), whole.alias("v"))
    order = (F.col("vec_id").asc_nulls_last(), "v")
    first = table.where(F.size("v") > 0).orderBy(*order).select(F.size("v")).first()
    length = first[0] if first else 0
    fits = F.size("v") == length if length else F.lit(False)
    start = np.array([r.v for r in table.where(fits).orderBy(*order).limit(entries).collect()], dtype=np.int64)
    start = start.reshape(len(start), length)
    spans = cuts(length, parts)
    books = [start[:, s] for s in spans]
    label_type = table.schema["label"].dataType.simpleString()

    def step(books: list[np.ndarray], first: bool, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in _gathered(batches, length, at_once):
                v = _matrix(part.column("v"), length)
                before = None if first else _codes(part.column("codes"), parts)
                codes, error = np.empty((len(v), parts), dtype="<u2"), np.zeros(len(v), np.int64)
                for p, span in enumerate(spans):
                    both = exact(np.concatenate([books[p], v[:, span]]), length)
                    book, x = both[: len(books[p])], both[len(books[p]) :]
                    own, d = assign(x, book) if first else reassign(x, before[:, p], book)
                    codes[:, p] = own
                    error += d.astype(np.int64)
                packed = pa.array([r.tobytes() for r in codes], pa.binary())
                kept = [part.column("vec_id"), part.column("label")]
                tail = [packed, pa.array(error)] if last else [part.column("v"), packed]
                names = ["vec_id", "label", *(["codes", "error"] if last else ["v", "codes"])]
                yield from pa.table([*kept, *tail], names=names).to_batches()

        return run

    def passed(df: DataFrame, books: list[np.ndarray], first: bool, last: bool) -> str:
        kinds = f"vec_id long, label {label_type}, " + ("codes binary, error long" if last else "v array<long>, codes binary")
        path = fresh_dir(spark, "vector-codes")
        df.mapInArrow(step(books, first, last), kinds).write.parquet(path)
        return path

    current = table.where(fits)
    path = None
    for k in range(rounds + 1):
        new = passed(current, books, first=k == 0, last=k == rounds)
        if path:
            discard(spark, path)
        path, current = new, spark.read.parquet(new)
        if k < rounds and len(start):
            for p, (sums, counts) in enumerate(_sums(current, books, length, at_once)):
                used = np.flatnonzero(counts)
                books[p] = books[p].copy()
                books[p][used] = np.array([[s // c for s in row] for row, c in zip(sums[used], counts[used])], dtype=np.int64).reshape(len(used), -1)

    digits = 2 if entries <= 256 else 4
    # Little-endian 16-bit numbers: of each four digits the latter two, then the former.
    pieces = [F.substring(F.hex("codes"), 4 * p + at, 2) for p in range(parts) for at in ((1,) if digits == 2 else (3, 1))]
    coded = current.select("vec_id", "label", F.lower(F.concat(*pieces)).alias("code"), "error")
    rest = table.where(~fits).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    rows = coded.unionByName(rest)
    totals = rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    out = rows.join(totals, F.col("label").eqNullSafe(F.col("of")), "left")
    return out.select("vec_id", "label", "code", "error", "label_error"), books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' decimal components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()
