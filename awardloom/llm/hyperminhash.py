"""Near-duplicate groups by HyperMinHash registers, banding and verification on full shingle sets.

Every document is a set of hashed word shingles. A register keeps the minimum of the set under one hash
function as a count of leading zeros and ten mantissa bits, 16 bits in all; four registers are a band and
fill one 64-bit integer. Documents that agree in a band are candidates. The share of equal registers, less
what chance collisions of the short registers add, estimates the Jaccard index; what may reach the
threshold is verified on the full sets. With 40 bands of 4, a pair at an index of 0.8 shares no band with
a probability of 7e-10, and its estimate rules it out with a probability of 9e-11.

Groups of any size are handled without emitting all their pairs:

1. Documents with equal sets are one class (a plain aggregate), represented by the smallest id.
2. Of the classes in a bucket, each is compared with the smallest id there; one such candidate a class is
   verified, so verification grows with the classes, not with their pairs.
3. The links found give components. Buckets whose members lie in one component can add nothing. In the
   others, the members outside the bucket's largest component meet all other members in blocks, bounded in
   members and in shingles, where pairs that the estimate allows are verified at once, each in the first band that it shares; only links leave a block.

After step 3 every pair that shares a bucket has been verified, ruled out by its estimate, or lies in one
component, so the components are those of all links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ids_and_texts, in_batches, prepare, words, written

BANDS, ROWS = 40, 4
REGISTERS = BANDS * ROWS
MANTISSA = 10
#: Standard deviations of the estimate by which a pair may stay below the threshold and still be verified.
SLACK = 7.0
#: Members of a bucket and their shingles that are compared at once in step 3, members that one hub is compared with at once.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 21
SALT = 128
#: Shingle hashes that are multiplied at once.
CHUNK = 2048

_rng = np.random.default_rng(20240229)
MULTIPLIERS = _rng.integers(0, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADDENDS = _rng.integers(0, 1 << 63, REGISTERS, dtype=np.uint64)
ORDER = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles of ``size`` words.

    Fewer words are one shingle of all; no word gives the empty set.
    """
    found = words(text)
    n = len(found)
    if not n:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, n)
    size = min(size, n)
    acc = h[: n - size + 1].copy()
    for j in range(1, size):
        acc *= ORDER
        acc += h[j : n - size + 1 + j]
    return np.unique(_mix(acc + np.uint64(size)))


def registers(hashes: np.ndarray) -> np.ndarray:
    """The 16-bit registers of a non-empty set."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(hashes), CHUNK):
        part = np.multiply.outer(hashes[start : start + CHUNK], MULTIPLIERS)
        part += ADDENDS
        np.minimum(least, part.min(axis=0), out=least)
    length = np.frexp((least >> np.uint64(11)).astype(np.float64))[1].astype(np.int64)  # bit length of the top 53 bits
    shift = np.maximum(length + 10 - MANTISSA, 0).astype(np.uint64)
    zeros = (53 - length).astype(np.uint16)
    return zeros << np.uint16(MANTISSA) | ((least >> shift) & np.uint64((1 << MANTISSA) - 1)).astype(np.uint16)


def collision_rate(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Probability that different minima of sets of n and m elements have equal registers."""
    k = np.arange(0, 54)
    floor = lambda x: np.exp(np.multiply.outer(x.astype(float), np.log1p(-np.minimum(2.0 ** -(k + 1.0), 1 - 1e-12))))
    above = lambda x: np.concatenate([np.zeros((len(x), 1)), floor(x)[:, :-1]], axis=1)
    p, q = floor(n) - above(n), floor(m) - above(m)
    return (p * q).sum(axis=1) / 2.0**MANTISSA


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard estimates of rows of registers."""
    chance = collision_rate(n, m)
    return ((a == b).mean(axis=1) - chance) / (1 - chance)


def may_link(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, threshold: float) -> np.ndarray:
    slack = SLACK * np.sqrt(threshold * (1 - threshold) / REGISTERS)
    sizes = np.minimum(n, m) >= threshold * np.maximum(n, m) - 1e-9
    return sizes & (estimate(a, b, n, m) >= threshold - slack)


def signatures(docs: DataFrame, size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, digest (128 bits of the set), registers; the last two are null for empty sets."""
    return _signed(ids_and_texts(docs, id_col, text_col), size, "doc_id long")


def _signed(table: DataFrame, size: int, kinds: str) -> DataFrame:
    """The columns of the table (of these kinds) but for the last, the text; n_shingles, digest, registers."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, digests, regs = [], [], []
        for text in batch.column(batch.num_columns - 1).to_pylist():
            s = shingle_set(text, size)
            n.append(len(s))
            digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            regs.append(registers(s).tobytes() if len(s) else None)
        return pa.record_batch(
            [*batch.columns[:-1], pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(regs, pa.binary())],
            names=[*batch.schema.names[:-1], "n_shingles", "digest", "registers"],
        )

    return table.mapInArrow(in_batches(run), f"{kinds}, n_shingles long, digest binary, registers binary")


def band_rows(classes: DataFrame) -> DataFrame:
    """key, band, id: one row a class and band; the key is the band's registers and its number, hashed."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        regs = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype="<u8").reshape(len(ids), BANDS)
        keys = _mix(regs + np.arange(1, BANDS + 1, dtype=np.uint64) * ORDER)
        band = np.tile(np.arange(BANDS, dtype=np.int16), len(ids))
        return pa.record_batch(
            [pa.array(keys.ravel().view(np.int64)), pa.array(band), pa.array(np.repeat(ids, BANDS))], names=["key", "band", "id"]
        )

    return classes.select("id", "registers").mapInArrow(in_batches(run), "key long, band short, id long")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u2").reshape(len(column), REGISTERS)


def _plausible(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose estimate allows a link."""
    left = classes.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("registers").alias("r_a"))
    right = classes.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("registers").alias("r_b"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, m = (batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 4))
        ok = may_link(_matrix(batch.column(3)), _matrix(batch.column(5)), n, m, threshold)
        return pa.record_batch([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(ok))

    both = pairs.join(right, "b").join(left, "a").select("a", "b", "n_a", "r_a", "n_b", "r_b")
    return both.mapInArrow(in_batches(run), "a long, b long")


def linked(s: np.ndarray, t: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, of non-empty sets."""
    common = len(np.intersect1d(s, t, assume_unique=True))
    return common > 0 and 100 * common >= percent * (len(s) + len(t) - common)


def _verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold: 100 * intersection >= percent * union.

    The members b of one hub a are dealt out over salted groups; the hub's text goes to each, before its
    members, and a task streams its sorted rows holding one hub at a time.
    """
    many = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("members"))
    salted = pairs.join(many, "a").select("a", "b", F.expr(f"pmod(xxhash64(b), cast(ceil(members / {SALT}) as bigint))").alias("salt"))
    roles = salted.select("a", "salt", F.col("b").alias("id"), F.lit(1).alias("role")).unionByName(
        salted.select("a", "salt", F.col("a").alias("id"), F.lit(0).alias("role")).distinct()
    )
    rows = (
        roles.join(texts, "id")
        .select("a", "salt", "role", "id", "text")
        .repartition(F.col("a"), F.col("salt"))
        .sortWithinPartitions("a", "salt", "role", "id")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, sets = None, []
        for batch in batches:
            found = []
            for a, salt, role, b, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (a, salt) != hub:
                    hub, sets = (a, salt), []
                s = shingle_set(text, size)
                if not role:
                    sets.append(s)
                    continue
                for t in sets:
                    if linked(s, t, percent):
                        found.append((a, b))
                        break
            if found:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """id, component (the smallest id reachable) of every id in the edges (a, b).

    Alternating large-star and small-star steps over written edge tables: a step links the neighbours of
    each id to the smallest of them; the edges end as stars around the smallest ids.
    """

    def least(e: DataFrame) -> DataFrame:
        return e.groupBy("u").agg(F.min("v").alias("m"))

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    e = written(e, "edges")
    before = mark(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = least(both).select("u", F.least("u", "m").alias("m"))
        large = both.join(nearest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.join(least(large), "u")
        out = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        e = written(out.where("u <> v").distinct(), "edges")
        now = mark(e)
        if now == before:
            break
        before = now
    return e.select(F.col("u").alias("id"), F.col("v").alias("component"))


def _cross_links(buckets: DataFrame, classes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) between components, of buckets (key, band, id, component) that hold several.

    The members of a bucket's largest component are not compared with one another, and lie in blocks of
    some ``BLOCK`` members or ``BLOCK_SHINGLES`` shingles; the others lie in blocks of their own, and each of these
    meets every block. A group is a pair of blocks, so no group grows with its bucket or with the length of its texts.
    """
    buckets = buckets.join(classes.select("id", "n"), "id")
    parts = buckets.groupBy("key", "component").agg(F.struct(F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles")).alias("size"))
    sizes = parts.groupBy("key").agg(
        F.max_by("component", F.struct("size.members", "component")).alias("largest"),
        F.max_by("size", F.struct("size.members", "component")).alias("most"),
        F.struct(F.sum("size.members").alias("members"), F.sum("size.shingles").alias("shingles")).alias("all"),
    )
    blocks = lambda n, m: F.expr(f"cast(ceil(greatest(({n}) / {BLOCK}, ({m}) / {BLOCK_SHINGLES})) as bigint)")
    inner, outer = blocks("most.members", "most.shingles"), blocks("all.members - most.members", "all.shingles - most.shingles")
    sizes = sizes.select("key", "largest", inner.alias("inner_blocks"), outer.alias("outer_blocks"))
    placed = buckets.join(sizes, "key").withColumn("outer", F.col("component") != F.col("largest"))
    placed = placed.withColumn("block", F.expr("pmod(xxhash64(id), if(outer, outer_blocks, inner_blocks))"))
    # Group (i, j): outer block j with inner block i, or with outer block -1 - i.
    meets = """if(outer,
        concat(transform(sequence(0L, inner_blocks - 1), i -> struct(i, block as j)),
               transform(sequence(0L, outer_blocks - 1), c -> struct(-1 - least(c, block) as i, greatest(c, block) as j))),
        transform(sequence(0L, outer_blocks - 1), j -> struct(block as i, j)))"""
    dealt = placed.select("key", "band", "outer", "block", "id", "component", "n", F.explode(F.expr(meets)).alias("g"))
    rows = (
        dealt.join(classes.select("id", "registers"), "id")
        .join(texts, "id")
        .select("key", F.col("g.i").alias("i"), F.col("g.j").alias("j"), "band", "outer", "block", "id", "component", "n", "registers", "text")
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j", "outer", "id")
    )

    def compare(group: list[tuple]) -> Iterator[tuple[int, int]]:
        (_, i, j, band, *_), n = group[0], len(group)
        outer, block, ids, comp, sizes = (np.array([g[k] for g in group], dtype=np.int64) for k in (4, 5, 6, 7, 8))
        regs = np.frombuffer(b"".join(g[9] for g in group), dtype="<u2").reshape(n, REGISTERS)
        bands = regs.view("<u8")
        sets: dict[int, np.ndarray] = {}

        def set_of(x: int) -> np.ndarray:
            if x not in sets:
                sets[x] = shingle_set(group[x][10], size)
            return sets[x]

        for x in np.flatnonzero(outer).tolist():
            ok = (comp != comp[x]) & (ids != ids[x])
            if i >= 0:
                ok &= outer == 0
            elif -1 - i == j:
                ok[: x + 1] = False
            else:
                ok &= block != block[x]
                ok[: x + 1] = False
            ok &= ~(bands[:, :band] == bands[x, :band]).any(axis=1)  # not met in an earlier band
            ys = np.flatnonzero(ok)
            if len(ys):
                same = np.broadcast_to(regs[x], (len(ys), REGISTERS))
                ys = ys[may_link(same, regs[ys], np.full(len(ys), sizes[x]), sizes[ys], percent / 100)]
            for y in ys.tolist():
                if comp[y] != comp[x] and linked(set_of(x), set_of(y), percent):
                    yield min(int(ids[x]), int(ids[y])), max(int(ids[x]), int(ids[y]))
                    comp[comp == comp[y]] = comp[x]  # one component from here on

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import groupby

        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        for _, group in groupby(rows, key=lambda r: r[:3]):
            found = list(compare(list(group)))
            if found:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long").distinct()


def _linked(
    classes: DataFrame, texts_of: Callable[[DataFrame], DataFrame], shared: DataFrame | None, size: int, percent: int
) -> DataFrame:
    """id, component of the classes (id, n, registers) that are linked with others. ``texts_of`` gives (id, text) of a
    table of ids; ``shared`` are further links (a, b)."""
    threshold = percent / 100
    bands = band_rows(classes)
    full = bands.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least <> most")
    members = written(bands.join(full.select("key", "least"), "key").select("key", "band", "id", "least"), "buckets")

    stars = members.where("id <> least").select(F.col("least").alias("a"), F.col("id").alias("b")).distinct()
    stars = written(_plausible(stars, classes, threshold), "stars")
    first = stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    involved = members.select("id").distinct()
    texts = written(texts_of(involved), "texts")
    found = _verified(first, texts, size, percent)
    links = written(found.unionByName(shared) if shared is not None else found, "links")

    found = components(links)
    held = members.join(found, "id", "left").select("key", "band", "id", F.coalesce("component", "id").alias("component"))
    mixed = held.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    several = held.join(mixed.select("key"), "key").dropDuplicates(["key", "id"])
    more = written(_cross_links(several, classes, texts, size, percent), "links")

    return components(found.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(more))


def near_duplicates(
    spark: SparkSession, docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row a document.

    Documents are linked if 100 * intersection >= percent * union of their sets of ``size``-word shingles;
    component_id is the smallest id reachable over links. Texts without a word (null texts too) are linked
    with nothing. Rows that share an id are one document with several texts, linked by any of them. A row
    with a null id is linked with nothing: its component_id is null and it is kept. An empty table gives no rows.
    """
    prepare(spark)
    signed = written(signatures(docs, size, id_col, text_col), "signatures")
    classes = written(
        signed.where("digest is not null and doc_id is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("registers").alias("registers")),
        "classes",
    )
    table = ids_and_texts(docs, id_col, text_col).withColumnRenamed("doc_id", "id")
    # Rows that share an id: one document, so its classes are linked.
    shared = signed.where("digest is not null and doc_id is not null").groupBy("doc_id").agg(F.min("digest").alias("x"), F.max("digest").alias("y"))
    shared = shared.where("x <> y").select("doc_id").join(signed.select("doc_id", "digest"), "doc_id")
    shared = shared.join(classes.select("digest", "id"), "digest").select(F.col("id").alias("a"), F.col("doc_id").alias("b"))
    whole = _linked(classes, lambda involved: table.join(involved, "id", "left_semi"), shared, size, percent)

    named = classes.join(whole, "id", "left").select("digest", F.coalesce("component", "id").alias("component"))
    return (
        signed.select("doc_id", "n_shingles", "digest")
        .join(named, "digest", "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def keep_one(spark: SparkSession, docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, of one document of each group: that of the smallest id.

    Rows that share an id are one document, of which one row stays. Rows with a null id stay.
    """
    groups = near_duplicates(spark, docs, size, percent, id_col, text_col)
    kept = groups.where("kept and doc_id is not null").select(F.col("doc_id").alias(id_col)).distinct()
    named = docs.where(F.col(id_col).isNotNull()).join(kept, id_col, "left_semi").dropDuplicates([id_col])
    return named.select(*docs.columns).unionByName(docs.where(F.col(id_col).isNull()))


def keep_rows(spark: SparkSession, docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, of which one stays of each group of near duplicates, decided row by row.

    Every row is a document of its own, whatever its id: rows that share an id or have none are compared by their
    texts like all others. Of a group the row of the smallest id stays (null ids last; then by hashes of the text and
    of the row). A row whose text has no word is linked with nothing and stays, as often as it is there.
    """
    prepare(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    # Written with a number a row, so that only numbers, ids and hashes go through the grouping and no text does.
    number = next(n for n in (f"_row{i}" for i in range(len(docs.columns) + 1)) if n not in docs.columns)
    table = written(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    worded = F.coalesce(F.col(text_col).rlike("[^\\x09-\\x0d ]"), F.lit(False))
    prints = F.unhex(F.md5(text.cast("binary"))), F.xxhash64(*[F.col(c) for c in docs.columns])
    rows = table.where(worded).select(F.col(number).alias("row"), F.col(id_col).cast("long").alias("doc_id"), prints[0].alias("print"), prints[1].alias("content"), text.alias("text"))
    signed = _signed(rows, size, "row long, doc_id long, print binary, content long")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "print", "content", "row")
    signed = written(signed.select(order.alias("first"), "n_shingles", "digest", "registers"), "signatures")
    classes = signed.groupBy("digest").agg(F.min("first").alias("first"), F.first("n_shingles").alias("n"), F.first("registers").alias("registers"))
    # Written once, so that the numbers stay.
    classes = written(classes.select(F.monotonically_increasing_id().alias("id"), "first", "n", "registers"), "classes")

    def texts_of(involved: DataFrame) -> DataFrame:
        wanted = classes.join(involved, "id", "left_semi").select("id", F.col("first.row").alias(number))
        return table.select(number, text.alias("text")).join(wanted, number).select("id", "text")

    whole = _linked(classes, texts_of, None, size, percent)
    grouped = classes.join(whole, "id", "left").groupBy(F.coalesce("component", "id").alias("component")).agg(F.min("first").alias("first"))
    stays = grouped.select(F.col("first.row").alias(number)).unionByName(table.where(~worded).select(number))
    return table.join(stays, number, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
