"""SimHash near duplicates by a hierarchical index over fingerprints in Gray order.

A fingerprint has 64 bits: a bit is set if more than half of the text's hashed word shingles have it set. The different
fingerprints are sorted by their rank in the Gray code and cut into shards. Codes that follow one another in Gray
order share most of their bits, so a run of them has a pattern: a mask of the bits that all of them share, and those bits.
In a shard, ``LEAF`` codes are a leaf, ``FAN`` nodes an upper node, up to the root; the shards' roots are in turn
the leaves of a directory of chunks. Two nodes are compared on the bits that both masks hold; going down, only bits
that no upper pair has compared are added to the differences so far, and a pair of groups is dropped as soon as they exceed the bound.

1. Every shard is searched against itself; what is linked there is a local component of its codes.
2. The directory gives the pairs of shards whose patterns allow a link. Each such pair is one row.
3. Links between the two shards' components are searched; groups that already are one component are not compared.

A task emits links that join two components only, so a dense group never gives all its pairs. The links' components,
found by star steps over written tables, are those of all links.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ids_and_texts, in_batches, prepare, words, written
from .hyperminhash import components

#: Codes of a leaf, nodes below an upper node, levels; so a shard has at most LEAF * FAN ** (LEVELS - 1) codes.
LEAF, FAN, LEVELS = 32, 8, 4
SHARD = LEAF * FAN ** (LEVELS - 1)
#: Shards of a chunk of the directory; pairs of leaves that are compared at once; shingle hashes whose bits are counted at once.
CHUNK, AT_ONCE, PASS = 2048, 256, 65_536
SEED = 42


def fingerprint(text: str, size: int = 3) -> int:
    """Bits set in over half the shingles' XXH64 (seed 42), repeats included.

    A shingle is ``size`` words with single blanks between; fewer words are one shingle; no word gives zero.
    """
    found = words(text)
    n = len(found)
    if not n:
        return 0
    size = min(size, n)
    line, digest = b" ".join(found), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, n) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    total = n - size + 1
    counts = np.zeros(64, np.int64)
    for at in range(0, total, PASS):
        to = min(at + PASS, total)
        spans = zip(starts[at:to].tolist(), ends[at + size - 1 : to + size - 1].tolist())
        h = np.fromiter((digest(line[a:b], SEED) for a, b in spans), ">u8", to - at)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > total).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, print (the fingerprint's 64 bits as a signed integer): one row a document; null texts are empty ones."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = np.fromiter((fingerprint(t, size) for t in batch.column(1).to_pylist()), np.uint64, batch.num_rows)
        return pa.record_batch([batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "print"])

    return ids_and_texts(docs, id_col, text_col).mapInArrow(in_batches(run), "doc_id long, print long")


def gray_rank(code: Column) -> Column:
    """Place of a 64-bit code in the Gray code's order, as a signed integer that sorts alike."""
    rank = code
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-(1 << 63)).cast("long"))


class Index(NamedTuple):
    """Codes in Gray order; by level, root last, each node's mask of shared bits and the bits themselves."""

    codes: np.ndarray  # padded to whole leaves by repeating the last
    size: int
    masks: list[np.ndarray]
    bits: list[np.ndarray]


def build(codes: np.ndarray) -> Index:
    """The index of up to ``SHARD`` codes."""
    n = len(codes)
    padded = np.concatenate([codes, np.repeat(codes[-1:], -n % LEAF)])
    every, some = np.bitwise_and.reduceat(padded, np.arange(0, len(padded), LEAF)), np.bitwise_or.reduceat(padded, np.arange(0, len(padded), LEAF))
    masks, bits = [every | ~some], [every]
    for _ in range(LEVELS - 1):
        runs = np.arange(0, len(every), FAN)
        every, some = np.bitwise_and.reduceat(every, runs), np.bitwise_or.reduceat(some, runs)
        masks.append(every | ~some)
        bits.append(every)
    return Index(padded, n, masks, bits)


def close_leaves(one: Index, two: Index, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of leaves whose shared bits differ in at most ``most`` places, by descent from the two roots."""
    a = b = np.zeros(1, np.int64)
    seen = np.zeros(1, np.uint64)
    far = np.zeros(1, np.int64)
    for level in range(LEVELS - 1, -1, -1):
        if level < LEVELS - 1:
            step = np.arange(FAN)
            shape = (len(a), FAN, FAN)
            x = np.broadcast_to((a[:, None] * FAN + step)[:, :, None], shape).ravel()
            y = np.broadcast_to((b[:, None] * FAN + step)[:, None, :], shape).ravel()
            there = (x < len(one.masks[level])) & (y < len(two.masks[level]))
            if one is two:
                there &= x <= y
            seen, far = np.repeat(seen, FAN * FAN)[there], np.repeat(far, FAN * FAN)[there]
            a, b = x[there], y[there]
        both = one.masks[level][a] & two.masks[level][b]
        far = far + np.bitwise_count((one.bits[level][a] ^ two.bits[level][b]) & both & ~seen)
        keep = far <= most
        a, b, seen, far = a[keep], b[keep], (both | seen)[keep], far[keep]
    return a, b


class Parts:
    """Components of the codes at hand: ``of`` holds a label a code, equal within a component."""

    def __init__(self, labels: np.ndarray):
        self.of = labels

    def join(self, x: np.ndarray, y: np.ndarray) -> Iterator[tuple[int, int]]:
        """Join the codes x[i] and y[i]; gives the pairs that joined two components."""
        p, q = self.of[x], self.of[y]
        apart = np.flatnonzero(p != q)
        if not len(apart):
            return
        low, high = np.minimum(p[apart], q[apart]), np.maximum(p[apart], q[apart])
        _, first = np.unique(low * len(self.of) + high, return_index=True)
        root: dict[int, int] = {}

        def find(k: int) -> int:
            while k in root:
                k = root[k]
            return k

        for i in first.tolist():
            u, v = find(int(low[i])), find(int(high[i]))
            if u != v:
                root[max(u, v)] = min(u, v)
                yield int(x[apart[i]]), int(y[apart[i]])
        names = np.array(sorted(root), np.int64)
        to = np.array([find(k) for k in names.tolist()], np.int64)
        at = np.searchsorted(names, self.of).clip(max=len(names) - 1)
        self.of = np.where(names[at] == self.of, to[at], self.of)


def link(one: Index, two: Index, labels: np.ndarray, most: int) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Pairs of places that join components, and the labels after it. Places of ``two`` follow those of ``one``
    (its padded length) unless both are the same index."""
    shift = 0 if one is two else len(one.codes)
    a, b = close_leaves(one, two, most)
    near = np.argsort(np.abs(a - b), kind="stable")
    a, b = a[near], b[near]
    parts, found = Parts(labels), []
    cells = np.arange(LEAF)
    for at in range(0, len(a), AT_ONCE):
        x, y = a[at : at + AT_ONCE], b[at : at + AT_ONCE]
        by_leaf = parts.of.reshape(-1, LEAF)
        low, high = by_leaf.min(axis=1), by_leaf.max(axis=1)
        y_leaf = y + shift // LEAF
        open_ = ~((low[x] == high[x]) & (low[y_leaf] == high[y_leaf]) & (low[x] == low[y_leaf]))
        x, y, y_leaf = x[open_], y[open_], y_leaf[open_]
        if not len(x):
            continue
        p, q = one.codes.reshape(-1, LEAF)[x], two.codes.reshape(-1, LEAF)[y]
        k, i, j = np.nonzero(np.bitwise_count(p[:, :, None] ^ q[:, None, :]) <= most)
        found += parts.join(x[k] * LEAF + cells[i], y_leaf[k] * LEAF + cells[j])
    return found, parts.of


def _own_labels(index: Index) -> np.ndarray:
    """A label a place; the padding has the last code's."""
    return np.minimum(np.arange(len(index.codes), dtype=np.int64), index.size - 1)


def _u8(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u8")


def _shards(prints: DataFrame, count: int, most: int, size: int) -> DataFrame:
    """shard, codes, labels (place of a component's first code), mask, bits: runs of up to ``size`` codes in Gray order."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = np.empty(0, np.uint64), TaskContext.get().partitionId() << 32

        def row(codes: np.ndarray) -> pa.RecordBatch:
            nonlocal number
            index = build(codes)
            _, labels = link(index, index, _own_labels(index), most)
            root = [np.array([x[-1][0]]).view(np.int64) for x in (index.masks, index.bits)]
            number += 1
            return pa.record_batch(
                [pa.array([number - 1]), pa.array([codes.astype("<u8").tobytes()]), pa.array([labels[: len(codes)].astype("<u4").tobytes()]), pa.array(root[0]), pa.array(root[1])],
                names=["shard", "codes", "labels", "mask", "bits"],
            )

        for batch in batches:
            held = np.concatenate([held, batch.column(0).to_numpy().view(np.uint64)])
            while len(held) > size:
                yield row(held[:size])
                held = held[size:]
        if len(held):
            yield row(held)

    ranked = prints.select("print", gray_rank(F.col("print")).alias("rank"))
    ordered = ranked.repartitionByRange(max(1, -(-count // size)), "rank").sortWithinPartitions("rank").select("print")
    return written(ordered.mapInArrow(pack, "shard long, codes binary, labels binary, mask long, bits long"), "gray-shards")


def _close_shards(shards: DataFrame, most: int, chunk: int) -> DataFrame:
    """one, two: the pairs of shards (one < two) whose roots differ in at most ``most`` shared bits."""
    spark = shards.sparkSession

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        whole = pa.Table.from_batches(rows) if rows else None
        for at in range(0, whole.num_rows if whole else 0, chunk):
            part = whole.slice(at, chunk)
            raw = [pa.array([part.column(c).to_numpy().astype("<i8").tobytes()], pa.binary()) for c in ("shard", "mask", "bits")]
            yield pa.record_batch(raw, names=["shards", "masks", "bits"])

    roots = shards.select("shard", "mask", "bits")
    wanted = max(1, -(-shards.count() // chunk))
    chunks = roots.coalesce(wanted).mapInArrow(pack, "shards binary, masks binary, bits binary")
    chunks = written(chunks.withColumn("chunk", F.monotonically_increasing_id()), "gray-directory")
    numbers = [r.chunk for r in chunks.select("chunk").collect()]  # one a chunk of shards
    meets = spark.createDataFrame([(p, q) for p in numbers for q in numbers if p <= q] or [(0, 0)], "p long, q long")
    side = lambda end, key: chunks.select(F.col("chunk").alias(key), *[F.col(c).alias(f"{c}_{end}") for c in ("shards", "masks", "bits")])
    rows = meets.join(side("p", "p"), "p").join(side("q", "q"), "q").select("shards_p", "masks_p", "bits_p", "shards_q", "masks_q", "bits_q")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                (s, m, v), (t, n, w) = ([np.frombuffer(x, "<i8") for x in side] for side in (row[:3], row[3:]))
                for i in range(len(s)):
                    differ = np.bitwise_count(((v[i] ^ w) & m[i] & n).view(np.uint64))
                    to = t[(differ <= most) & (t > s[i])]
                    if s[0] != t[0]:  # another chunk: shards in either order
                        to = t[(differ <= most) & (t != s[i])]
                    if len(to):
                        yield pa.record_batch([pa.array(np.minimum(s[i], to)), pa.array(np.maximum(s[i], to))], names=["one", "two"])

    return rows.mapInArrow(run, "one long, two long")


def link_codes(spark: SparkSession, prints: DataFrame, most: int = 2, shard: int = SHARD, chunk: int = CHUNK) -> DataFrame:
    """id, component (the smallest code reachable) of the codes (column print, all different) that reach a smaller one by steps
    of at most ``most`` bits. ``shard`` (at most ``SHARD``) and ``chunk`` bound the codes of a shard and the shards of a piece of the directory."""
    prepare(spark)
    shards = _shards(prints, prints.count(), most, shard)

    def own(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for codes, labels in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            codes, labels = np.frombuffer(codes, "<i8"), np.frombuffer(labels, "<u4")
            joined = np.flatnonzero(labels != np.arange(len(labels)))
            yield pa.record_batch([pa.array(codes[joined]), pa.array(codes[labels[joined]])], names=["a", "b"])

    inner = shards.select("codes", "labels").mapInArrow(in_batches(own), "a long, b long")
    pairs = _close_shards(shards, most, chunk)
    side = lambda name, end: shards.select(F.col("shard").alias(name), F.col("codes").alias(f"codes_{end}"), F.col("labels").alias(f"labels_{end}"))
    rows = pairs.join(side("two", "q"), "two").join(side("one", "p"), "one").select("one", "codes_p", "labels_p", "codes_q", "labels_q")

    def labelled(index: Index, raw: bytes) -> np.ndarray:
        labels = np.frombuffer(raw, "<u4").astype(np.int64)
        return np.concatenate([labels, np.repeat(labels[-1:], len(index.codes) - len(labels))])

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, one = None, None
        for batch in batches:
            for name, codes_p, labels_p, codes_q, labels_q in zip(*(c.to_pylist() for c in batch.columns)):
                if name != last:
                    last, one = name, build(_u8(codes_p))
                two = build(_u8(codes_q))
                labels = np.concatenate([labelled(one, labels_p), labelled(two, labels_q) + len(one.codes)])
                found, _ = link(one, two, labels, most)
                if found:
                    x, y = (np.array(side) for side in zip(*found))
                    a, b = one.codes[x], two.codes[y - len(one.codes)]
                    yield pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    links = written(inner.unionByName(rows.mapInArrow(across, "a long, b long")), "gray-links")
    return components(links)


def near_duplicates(
    spark: SparkSession, docs: DataFrame, size: int = 3, most: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id: one row a document.

    Texts are lower-cased (A-Z), fingerprints are of ``size``-word shingles, repeats included; documents are linked if
    their fingerprints differ in at most ``most`` bits; component_id is the smallest id reachable. A text without a word, or
    a null one, has fingerprint zero and is linked like any other. Every row is a document of its own: a
    shared id links nothing. A null id links its texts like others, but is no component_id unless nothing else is
    reachable. Equal texts have equal fingerprints, which are compared once. An empty table gives no rows; other
    columns play no part.
    """
    prepare(spark)
    signed = written(fingerprints(docs, size, id_col, text_col), "fingerprints")
    classes = written(signed.groupBy("print").agg(F.min("doc_id").alias("least")), "gray-classes")
    linked = link_codes(spark, classes.select("print"), most)
    named = classes.join(linked, F.col("print") == F.col("id"), "left").select("print", "least", F.coalesce("component", "print").alias("component"))
    groups = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = written(named.join(groups, "component").select("print", "component_id"), "gray-groups")
    digits = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return signed.join(named, "print").select("doc_id", digits.alias("fingerprint"), "component_id")
