"""Ball k-means codes, the Gray-order index and hard negatives against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from awardloom.llm import ballkmeans, grayindex, multiindex, queries

# Ball k-means


def brute_codes(rows, scale, parts, entries, rounds):
    """(vec_id, label, code, error) a row and the codebooks, with Python's integers and all distances."""
    kept = [(i, lab, [math.floor(scale * float(x)) for x in v]) for i, lab, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((r for r in kept if r[2]), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    if not order:
        return [(i, lab, None, None) for i, lab, _ in kept], []
    length = len(order[0][2])
    whole = [r for r in order if len(r[2]) == length]
    spans = ballkmeans.cuts(length, parts)
    books = [[r[2][s] for r in whole[:entries]] for s in spans]

    def nearest(p, v):
        return min((sum((x - y) ** 2 for x, y in zip(v[spans[p]], c)), k) for k, c in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            members = [[] for _ in books[p]]
            for _, _, v in whole:
                members[nearest(p, v)[1]].append(v[spans[p]])
            new.append([[sum(col) // len(m) for col in zip(*m)] if m else c for m, c in zip(members, books[p])])
        books = new
    out = []
    for i, lab, v in kept:
        if len(v) != length:
            out.append((i, lab, None, None))
            continue
        found = [nearest(p, v) for p in range(parts)]
        out.append((i, lab, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    return out, books


def vectors(seed, n=220, d=10):
    rng = np.random.default_rng(seed)
    rows = [(int(i), int(rng.integers(0, 4)), [float(x) for x in rng.normal(0, 0.02, d).astype(np.float32)]) for i in rng.permutation(n)]
    rows += [(500 + i, None, rows[3][2]) for i in range(30)] + [(500, 1, rows[4][2])] * 3  # ties, repeated rows
    return rows + [(900, 1, None), (901, 2, []), (902, 1, [1.0, None] * 5), (903, 1, [float("nan")] * d), (904, 3, [float("-inf")] * d), (None, 2, rows[9][2]), (905, 2, [1.0, 2.0])]


@pytest.mark.parametrize("parts,entries", [(4, 16), (3, 300)])
def test_codes_equal_brute_force(spark, parts, entries):
    rows = vectors(parts)
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumn("codes", F.lit("clash")).repartition(4)
    want, books = brute_codes(rows, 1024.0, parts, entries, 3)
    got, found = ballkmeans.compress(spark, df, parts=parts, entries=entries, rounds=3, at_once=400)
    if entries > 256:
        want = [(*r[:2], r[2] and "".join("00" + r[2][k : k + 2] for k in range(0, len(r[2]), 2)), r[3]) for r in want]
    assert [b.tolist() for b in found] == books
    got = got.collect()
    assert sorted(map(str, (tuple(r)[:4] for r in got))) == sorted(map(str, want))
    for r in got:
        assert r.label_error == sum(w[3] or 0 for w in want if w[1] == r.label)


def test_rings_find_what_all_distances_find():
    rng = np.random.default_rng(0)
    centres = rng.integers(-2000, 2000, (60, 5))
    x = ballkmeans.exact(centres[rng.integers(0, 60, 3000)] + rng.integers(-60, 60, (3000, 5)), 5)
    book = ballkmeans.exact(np.concatenate([centres[:40] + rng.integers(-9, 9, (40, 5)), centres[:3], centres[:1]]), 5)  # some entries twice
    own, _ = ballkmeans.assign(x, ballkmeans.exact(centres[:44], 5))
    want, got = ballkmeans.assign(x, book), ballkmeans.reassign(x, own, book)
    assert (want[0] == got[0]).all() and (want[1] == got[1]).all()
    tied = np.array([[0.0], [2.0], [4.0]])
    assert ballkmeans.reassign(np.array([[1.0], [3.0]]), np.array([1, 2]), tied)[0].tolist() == [0, 1]


def test_codes_of_empty_tables(spark):
    df = spark.createDataFrame([(1, 2, None), (2, 2, [float("nan")])], "vec_id long, label int, embedding array<float>")
    for table in (df, df.limit(0)):
        got, books = ballkmeans.compress(spark, table)
        assert got.count() == 0 and all(b.size == 0 for b in books) and ballkmeans.digest(books) == hashlib.sha256(b"").hexdigest()
    got, _ = ballkmeans.compress(spark, spark.createDataFrame([(1, "x", [0.5] * 8), (2, None, [])], "vec_id long, label string, embedding array<float>"))
    assert {tuple(r) for r in got.collect()} == {(1, "x", "00000000", 0, 0), (2, None, None, None, None)}
    with pytest.raises(Exception, match="beyond"):
        ballkmeans.compress(spark, spark.createDataFrame([(1, 1, [1e6] * 4)], "vec_id long, label int, embedding array<double>"))[0].collect()


# Gray order


def brute_print(text, size=3):
    ws = (text or "").encode().lower().split()
    if not ws:
        return 0
    k = min(size, len(ws))
    h = [xxhash.xxh64_intdigest(b" ".join(ws[i : i + k]), 42) for i in range(len(ws) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(codes, most):
    """code -> smallest code reachable."""
    root = {c: c for c in codes}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    codes = sorted(codes)
    for i, a in enumerate(codes):
        for b in codes[i + 1 :]:
            if (a ^ b).bit_count() <= most:
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {c: find(c) for c in codes}


def signed(c):
    return c - (1 << 64) if c >> 63 else c


def flipped(c, rng, n):
    for _ in range(n):
        c ^= 1 << rng.randrange(64)
    return c


def many_codes(rng):
    out = {0, (1 << 64) - 1, 1, 3, 7}
    for _ in range(250):  # chains
        c = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 7)):
            out.add(c)
            c = flipped(c, rng, rng.randrange(1, 5))
    dense = rng.getrandbits(64)
    return sorted(out | {flipped(dense, rng, rng.randrange(0, 4)) for _ in range(500)})


@pytest.mark.parametrize("most,shard,chunk", [(2, 16_384, 2048), (2, 100, 3), (3, 500, 2), (0, 40, 50)])
def test_linked_codes_equal_brute_force(spark, most, shard, chunk):
    codes = many_codes(random.Random(most))
    df = spark.createDataFrame([(signed(c),) for c in codes], "print long")
    got = {r.id: r.component for r in grayindex.link_codes(spark, df, most, shard, chunk).collect()}
    groups = {}
    for c, g in brute_groups(codes, most).items():
        groups.setdefault(g, []).append(signed(c))
    assert got == {c: min(g) for g in groups.values() for c in g if c != min(g)}


def test_index_keeps_every_close_pair_and_drops_others():
    rng = random.Random(3)
    codes = np.array(sorted({rng.getrandbits(64) for _ in range(3000)} | {flipped(0, rng, 3) for _ in range(100)}), np.uint64)
    rank = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    index = grayindex.build(codes[np.argsort(rank)])
    a, b = grayindex.close_leaves(index, index, 2)
    met = set(zip(a.tolist(), b.tolist()))
    assert len(met) < 0.8 * len(index.masks[0]) * (len(index.masks[0]) + 1) / 2
    close = np.argwhere(np.bitwise_count(index.codes[: index.size, None] ^ index.codes[None, : index.size]) <= 2)
    assert {(i // 32, j // 32) for i, j in close.tolist() if i <= j} <= met


def test_links_within_an_index_of_several_levels(monkeypatch):
    for name, value in (("LEAF", 2), ("FAN", 3), ("AT_ONCE", 5)):
        monkeypatch.setattr(grayindex, name, value)
    codes = np.array(many_codes(random.Random(1))[:400], np.uint64)
    rank = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    codes = codes[np.argsort(rank)]
    for x in (codes[i : i + n] for n in (1, 13, 54) for i in range(0, len(codes), n)):  # 54 = 2 * 3 ** 3
        index = grayindex.build(x)
        _, labels = grayindex.link(index, index, grayindex._own_labels(index), 2)
        groups = brute_groups(x.tolist(), 2)
        names = [groups[c] for c in x.tolist()]
        assert [labels[i] == labels[j] for i in range(len(x)) for j in range(i)] == [names[i] == names[j] for i in range(len(x)) for j in range(i)]


def test_gray_rank_is_the_inverse_code(spark):
    values = [0, 1, 2, 3, 1 << 62, -1, -(1 << 63), 12345, -777]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "c long").select(grayindex.gray_rank(F.col("c"))).collect()]
    back = [(r + (1 << 63)) for r in got]
    assert [b ^ b >> 1 for b in back] == [v % (1 << 64) for v in values]


def test_near_documents_equal_brute_force(spark):
    rng = random.Random(8)
    rows = []
    for _ in range(60):
        ws = [f"W{rng.randrange(500)}" for _ in range(rng.randrange(1, 200))]
        for _ in range(rng.randrange(1, 5)):
            rows.append(" ".join(ws))
            ws[rng.randrange(len(ws))] = "changed"
    rows += ["", None, " \n\t", "one", "ONE", "one two", "AÉ b", "aÉ B", "x y z " * 40_000] * 2
    rng.shuffle(rows)
    table = [(i * 2 + 1, t) for i, t in enumerate(rows)] + [(None, "one"), (None, "alone here now"), (3, "twice the same id"), (3, "twice the same id")]
    df = spark.createDataFrame([(*r, 1, "clash") for r in table], "doc_id long, text string, print int, least string").repartition(3)
    got = grayindex.near_duplicates(spark, df).collect()
    prints = [(d, brute_print(t)) for d, t in table]
    groups = brute_groups({p for _, p in prints}, 2)
    least = {}
    for d, p in prints:
        least[groups[p]] = min((x for x in (least.get(groups[p]), d) if x is not None), default=None)
    assert sorted(map(str, map(tuple, got))) == sorted(str((d, f"{p:016x}", least[groups[p]])) for d, p in prints)
    assert grayindex.near_duplicates(spark, df.limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    prints = {d: brute_print(t) for d, t in docs}
    groups = brute_groups(set(prints.values()), 2)
    least = {}
    for d, p in sorted(prints.items()):
        least.setdefault(groups[p], d)
    got = queries.QUERIES["op12_gray_order_index"](spark, "/root/testdata/sf0.001").collect()
    assert {tuple(r) for r in got} == {(d, f"{p:016x}", least[groups[p]]) for d, p in prints.items()} and len(got) == len(docs)


# Hard negatives


def brute_negatives(rows, scale, asks, n_pos, n_neg, low, high):
    whole = [(i, lab, [math.floor(scale * float(x)) for x in v]) for i, lab, v in rows if None not in (i, lab) and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, lab, v in whole:
        if not asks(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, u)), j, m == lab) for j, m, u in whole if j != i and len(u) == len(v))
        for s, p, _ in [x for x in scored if x[2]][:n_pos]:
            found = [(j, -t) for t, j, same in scored if not same and low * -s <= 100 * -t <= high * -s][:n_neg]
            out += [(i, p, k + 1, j, -s, t) for k, (j, t) in enumerate(found)]
    return sorted(out)


def labelled(seed, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.3, (6, 9))
    rows = []
    for i in range(600):
        lab = int(rng.integers(0, 6))
        rows.append((i, lab, [float(x) for x in centres[lab] + rng.normal(0, spread, 9)]))
    rows += [(1000 + i, i % 3, rows[7][2]) for i in range(40)] + [(1000, 2, rows[8][2]), (1000, 2, rows[8][2]), (1000, 1, rows[10][2])]
    rows += [(2000, 1, None), (2010, None, rows[1][2]), (None, 1, rows[1][2]), (2020, 1, []), (2030, 1, [None] * 9), (2040, 1, [float("inf")] * 9), (2050, 1, [0.0] * 9)]
    return rows + [(3000, 1, [1.0, 2.0]), (3010, 1, [2.0, 2.0]), (3020, 2, [0.5, 0.5]), (3030, 2, [7.0]), (3040, 2, [-3.0]), (3050, 1, [-2.0])]


@pytest.mark.parametrize("spread,shard,chunk", [(0.05, 8192, 1024), (0.3, 50, 3), (0.1, 7, 4)])
def test_negatives_equal_brute_force(spark, spread, shard, chunk):
    rows = labelled(int(100 * spread), spread)
    df = spark.createDataFrame([(*r, 5, "clash") for r in rows], "vec_id long, label int, embedding array<double>, d int, row string").repartition(3)
    got = multiindex.mine(spark, df, F.col("vec_id") % 10 == 0, positives=4, negatives=6, shard=shard, cell=4, chunk=chunk)
    # repeated ids give several rows of one content
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows, 256.0, lambda i: i % 10 == 0, 4, 6, 30, 90)


def test_negatives_beyond_exact_doubles_and_empty(spark):
    rows = [(i, i % 2, [float(1 << 29) + i, float(1 << 27) - 3 * i, 1.0]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, label long, embedding array<double>")
    got = multiindex.mine(spark, df, F.col("vec_id") % 7 == 0, scale=1.0, low=10, high=100)
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows, 1.0, lambda i: i % 7 == 0, 5, 10, 10, 100)
    for some in (df.limit(0), df.limit(1), df.where("label = 0")):
        assert multiindex.mine(spark, some, F.col("vec_id") % 7 == 0).count() == 0
    assert multiindex.mine(spark, df, F.lit(None).cast("boolean")).count() == 0


def test_walk_falls_and_bounds_hold():
    rng = np.random.default_rng(4)
    v = rng.integers(-90, 90, (800, 8))
    books = multiindex.fit(v[:, :4], 9), multiindex.fit(v[:, 4:], 9)
    a, b = (ballkmeans.assign(x.astype(float), k)[0] for x, k in ((v[:, :4], books[0]), (v[:, 4:], books[1])))
    order = np.lexsort((b, a))
    n = np.arange(800)
    shard = multiindex.build(n, n, n, n == 0, v[order], a[order], b[order], books)
    asked = multiindex.Queries(v[:5], books)
    for i in range(5):
        seen, last = 0, math.inf
        scores = v[order] @ v[i]
        for upper, lower, x, y in multiindex.walk(shard, asked, i):
            assert upper <= last and (scores[x:y] <= upper).all() and (scores[x:y] >= lower).all()
            seen, last = seen + y - x, upper
        upper, lower = asked.bounds(shard.ua, shard.ra, shard.ub, shard.rb)
        assert seen == 800 and scores.max() <= upper[i] and scores.min() >= lower[i]
