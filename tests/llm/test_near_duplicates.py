"""HyperMinHash groups against brute force over all pairs."""

import random

import numpy as np
import pytest

from awardloom.llm import hyperminhash as H


def brute(rows, size, percent):
    """doc_id -> (set size, component) by comparing every pair of shingle sets."""
    sets = {}
    for doc_id, text in rows:
        ws = (text or "").encode().lower().split()
        k = min(size, len(ws))
        sets[doc_id] = {tuple(ws[i : i + k]) for i in range(len(ws) - k + 1)} if ws else set()
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {d: (len(sets[d]), find(d)) for d in ids}


def edited(words, rng, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return words


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    out, boilerplate = [], [rng.choice(vocabulary) for _ in range(40)]
    for _ in range(60):  # bases with near copies around the threshold, in chains
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(3, 300))]
        for _ in range(rng.randrange(1, 8)):
            out.append(" ".join(words))
            words = edited(words, rng, rng.randrange(0, max(2, len(words) // 25)))
    big = [rng.choice(vocabulary) for _ in range(150)]
    out += [" ".join(edited(big, rng, rng.randrange(0, 6))) for _ in range(120)]  # one large group
    out += [" ".join(boilerplate + [rng.choice(vocabulary) for _ in range(rng.randrange(5, 40))]) for _ in range(60)]
    out += [None, "", "  \n", "one", "One", "one two", "one two three four", "one\ttwo  three four"] * 2
    rng.shuffle(out)
    return [(i * 3 + 2, t) for i, t in enumerate(out)]


@pytest.mark.parametrize("size", [4, 5])
def test_components_equal_brute_force(spark, rows, size):
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], "doc_id long, text string, id int, component string")
    got = {r.doc_id: r for r in H.near_duplicates(spark, df.repartition(4), size, 80).collect()}
    want = brute(rows, size, 80)
    assert {d: (r.n_shingles, r.component_id) for d, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())
    kept = [r.doc_id for r in H.keep_one(spark, df, size, 80).collect()]
    assert sorted(kept) == sorted({c for _, c in want.values()})


def test_small_blocks_find_the_same(spark, rows, monkeypatch):
    """Blocks and salts change the plan, not the links."""
    monkeypatch.setattr(H, "BLOCK", 8)
    monkeypatch.setattr(H, "BLOCK_SHINGLES", 700)  # some blocks are full by their texts' length
    monkeypatch.setattr(H, "SALT", 4)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in H.near_duplicates(spark, df, 4, 80).collect()}
    assert got == {d: c for d, (_, c) in brute(rows, 4, 80).items()}


def test_null_ids_shared_ids_and_empty_tables(spark):
    a, b = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    rows = [(None, a), (None, a), (7, a), (7, a), (9, b), (7, b), (12, b), (20, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in H.near_duplicates(spark, df).collect()), key=str)
    assert got == sorted([(None, None, True)] * 2 + [(7, 7, True)] * 3 + [(9, 7, False), (12, 7, False), (20, 20, True)], key=str)
    assert sorted(str(r.doc_id) for r in H.keep_one(spark, df).collect()) == ["20", "7", "None", "None"]
    assert H.near_duplicates(spark, df.limit(0)).count() == 0 and H.keep_one(spark, df.limit(0)).count() == 0


def test_rows_are_kept_one_by_one(spark, rows):
    """Rows that share an id or have none stay unless their own text is near that of a kept row."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(50)) for x in "abc")
    near = a.replace("a49", "x")
    some = [(None, a), (None, near), (None, c), (None, c + " "), (7, a), (7, b), (7, b), (3, near), (20, None), (20, None), (None, " ")]
    df = spark.createDataFrame(some, "doc_id long, text string")
    got = H.keep_rows(spark, df.repartition(3)).collect()
    assert [r.doc_id for r in got if r.text == near] == [3] and not any(r.text == a for r in got)
    assert [r.doc_id for r in got if r.text == b] == [7] and [r.doc_id for r in got if (r.text or "").startswith("c")] == [None]
    assert sorted(str(r.doc_id) for r in got if not (r.text or "").strip()) == ["20", "20", "None"] and len(got) == 6
    assert H.keep_rows(spark, df.limit(0)).count() == 0
    hot = [(None if i % 3 else 1, t) for i, (_, t) in enumerate(rows)]  # most rows under two keys
    groups = {comp for d, (n, comp) in brute(rows, 5, 80).items()}
    kept = H.keep_rows(spark, spark.createDataFrame(hot, "doc_id long, text string")).collect()
    assert len(kept) == len(groups)


def test_pipeline_keeps_different_texts_under_one_id(spark):
    import corpus_pipeline

    rows = [(7, " ".join(f"{x}{i}" for i in range(50))) for x in "abc"] + [(3, " ".join(f"a{i}" for i in range(50)))]
    got = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert sorted((r.doc_id, r.text[0]) for r in got) == [(3, "a"), (7, "b"), (7, "c")]


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 102), (101, 102), (200, 200)]
    random.Random(1).shuffle(edges)
    got = {r.id: r.component for r in H.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100, 102: 100}


def test_estimates_are_unbiased():
    rng = np.random.default_rng(2)
    for j in (0.0, 0.3, 0.8):
        seen = []
        for _ in range(60):
            n = 300
            common = int(round(2 * n * j / (1 + j)))
            pool = rng.integers(0, 1 << 63, 2 * n - common, dtype=np.uint64) * np.uint64(2)
            a, b = H.registers(pool[:n]), H.registers(pool[n - common :])
            seen.append(H.estimate(a[None], b[None], np.array([n]), np.array([n]))[0])
        assert abs(np.mean(seen) - j) < 0.02


def test_registers_keep_zeros_and_mantissa():
    least = (np.arange(1, 200, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[:, None] * H.MULTIPLIERS + H.ADDENDS
    m = [int(x) for x in least.min(axis=0)]
    want = [(64 - x.bit_length()) << 10 | (x >> (x.bit_length() - 11)) & 1023 for x in m]
    assert H.registers(np.arange(1, 200, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).tolist() == want
