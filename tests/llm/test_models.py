"""Language model, toxic segments and language identification: against plain forms, and on held-out rows."""

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from awardloom.llm import hmm, langid, queries, toxicity
from awardloom.llm.common import crc_mod

SF = "/root/testdata/sf0.01"
ODD = [None, "", " ", "a", "The of and " * 5000, "12 34 !!", "ÄÖ ñ", "x" * 3000, "a"]


def remainder(doc_id, m):
    return zlib.crc32(str(doc_id).encode()) % m


# Hidden Markov model


def test_forward_and_expected_counts_equal_sums_over_all_paths():
    rng = np.random.default_rng(0)
    norm = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
    start, move, emit = norm(rng.random(3), 0), norm(rng.random((3, 3)), 1), norm(rng.random((5, 3)), 0)
    nothing = np.empty(0)
    model = hmm.Model(start, move, emit, nothing, nothing, nothing, 0, 0, 0)
    sequences = [np.array(s) for s in ([0, 1, 4, 2, 2], [3, 3, 1, 0], [2, 4], [1], [1])]
    out = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    hmm.expected(model, sequences, out)
    want = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    likelihoods = []
    for s in sequences:
        paths = list(itertools.product(range(3), repeat=len(s)))
        p = [
            start[z[0]] * emit[s[0], z[0]] * math.prod(move[a, b] * emit[o, b] for a, b, o in zip(z, z[1:], s[1:])) for z in paths
        ]
        likelihoods.append(math.log(sum(p)))
        for z, w in zip(paths, np.array(p) / sum(p)):
            want[0][z[0]] += w
            for a, b in zip(z, z[1:]):
                want[1][a, b] += w
            for o, a in zip(s, z):
                want[2][o, a] += w
    assert np.allclose(hmm.forward(model, sequences), likelihoods)
    for a, b in zip(out, want):
        assert np.allclose(a, b)


@pytest.fixture(scope="module")
def scored(spark):
    return {r.doc_id: r for r in queries.op2_hidden_markov(spark, SF).collect()}


def test_base_score_and_counts_equal_a_plain_count(spark, scored):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    cut = {r.doc_id: [*r.text.encode().lower().split(), None] for r in docs}
    counts = Counter(w for d, ws in cut.items() if remainder(d, 5) != 1 for w in ws)
    n, share = sum(counts.values()), math.log10(sum(counts.values()) + 0.5 * (len(counts) + 1))
    assert set(scored) == set(cut)
    for d, ws in cut.items():
        r = scored[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (remainder(d, 5) == 1, len(ws), sum(w in counts for w in ws), n)
        assert math.isclose(r.base_score, sum(math.log10(counts[w] + 0.5) - share for w in ws), rel_tol=1e-9)


def test_model_beats_the_base_on_held_out_documents(scored):
    held = [r for r in scored.values() if r.held_out]
    per_token = lambda c: sum(r[c] for r in held) / sum(r.n_tokens for r in held)
    assert per_token("score") > per_token("base_score") + 0.1


def test_likelihood_of_whole_texts_equals_a_plain_recursion(spark):
    """The whole score, rare words and long texts included, against the recursion written out word by word."""
    texts = ["a b c d e f a b", "b a b a", "c d c d c d", "zz b a", "", None, "a " * 700 + "q"] * 4
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    hmm_head, hmm.HEAD = hmm.HEAD, 3
    try:
        from awardloom.llm.common import prepare

        prepare(spark)
        table = hmm.blocks(spark, df, F.col("doc_id") % 7 == 3, "doc_id", "text")
        counts, model = hmm.vocabulary(spark, table)
        model, seen = hmm.fit(spark, table, model, states=2, schedule=(1.0, 1.0, 1.0))
        got = {r.doc_id: r for r in hmm.score(spark, table, counts, model).collect()}
    finally:
        hmm.HEAD = hmm_head
    assert seen[0] < seen[1] < seen[2]  # Baum-Welch never loses (the blend is small)
    import xxhash

    train = Counter(w for i, t in enumerate(texts) if i % 7 != 3 for w in (t or "").encode().split())
    names = {int(np.uint64(xxhash.xxh64_intdigest(w)).view(np.int64)): w for w in train}
    head = {names[int(h)]: i for i, h in enumerate(model.head)}
    assert 0 < len(head) <= 3
    for i, t in enumerate(texts):
        ws, total, state = (t or "").encode().split(), 0.0, None
        for w in [*ws, None]:
            extra = 1.0
            if w is None:
                symbol = model.end
            elif w in head:
                symbol = head[w]
            else:
                cls = zlib.crc32(w[-3:]) % hmm.CLASSES
                symbol, extra = len(head) + cls, (train[w] + 0.5) / model.class_mass[cls]
            now = model.emit[symbol] * (model.start if state is None else state @ model.move)
            total += math.log10(now.sum() * extra)
            state = now / now.sum()
        assert math.isclose(got[i].score, total, rel_tol=1e-9), t


def test_every_step_sees_all_training_documents(spark):
    """The likelihood before each step is that of the whole training set, however few its documents."""
    from awardloom.llm.common import prepare

    prepare(spark)
    texts = ["a b c d e f a b", "b a b a", "c d c d c d", "e f e f e", "a a b b", "d c d", "f e f", "a b a"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    table = hmm.blocks(spark, df, F.lit(False), "doc_id", "text")
    _, model = hmm.vocabulary(spark, table)
    model, seen = hmm.fit(spark, table, model, states=2)
    assert len(seen) == 8 and max(seen) < seen[-1] + 1.0
    assert not np.allclose(model.emit[:, 0], model.emit[:, 1], rtol=0.05)
    with pytest.raises(ValueError):
        hmm.fit(spark, table, model, schedule=(1 / 16, 1.0))


def test_hidden_markov_edge_cases(spark):
    rows = [(i, t, "clash") for i, t in enumerate(ODD)] + [(None, "a b", "x"), (None, None, "x"), (3, "a", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, block string")
    got = hmm.score_documents(spark, df, crc_mod("doc_id", 5) == 1).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert all(r.train_tokens == 0 for r in hmm.score_documents(spark, df, F.lit(True)).collect())
    assert hmm.score_documents(spark, df.limit(0), F.lit(False)).count() == 0


# Toxic segments


def brute_segments(scores):
    """All maximal scoring segments by their recursive definition: the best one (shortest, then leftmost), then left and right of it."""

    def split(a, b):
        best = None
        for i in range(a, b):
            total = 0
            for j in range(i, b):
                total += scores[j]
                if total > 1e-9 and (best is None or total > best[0] + 1e-9):
                    best = (total, i, j + 1)
        return [] if best is None else split(a, best[1]) + [(best[1], best[2])] + split(best[2], b)

    return split(0, len(scores))


def test_segments_equal_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(200):
        n = int(rng.integers(1, 30))
        hits = {int(i): float(w) for i, w in zip(rng.integers(0, n, 6), rng.normal(1, 1.5, 6))}
        scores = [hits.get(i, -0.37) for i in range(n)]
        got = toxicity.maximal_segments(sorted(hits.items()), 0.37)
        assert [(s.start, s.end) for s in got] == brute_segments(scores)
        for s in got:
            assert math.isclose(s.score, sum(scores[s.start : s.end]), abs_tol=1e-9)


def test_segments_of_isolated_hits_take_linear_time():
    import time

    falling = [(100 * i, 1.0) for i in range(60_000)]
    rising = [(100 * i, 4.9 if i % 2 else 5.2) for i in range(60_000)]
    start = time.process_time()
    assert len(toxicity.maximal_segments(falling)) == 60_000
    toxicity.maximal_segments(rising)
    assert time.process_time() - start < 5


def test_toxic_documents_are_found_on_held_out_rows(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    got = queries.op3_toxic_segments(spark, "/root/testdata/sf0.1").collect()
    held = [r for r in got if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (remainder(r.doc_id, 4) == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    hit = sum(r.predicted and labels[r.doc_id] for r in held)
    assert hit / sum(labels[r.doc_id] for r in held) > 0.75 and hit / sum(r.predicted for r in held) > 0.95
    text = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id < 500").collect()}
    spans = [(text[r.doc_id][p.start : p.end]) for r in got if r.doc_id < 500 for p in r.passages]
    assert spans and all(s and not s[0].isspace() and not s[-1].isspace() for s in spans)


def test_toxicity_edge_cases(spark):
    rows = [(i, t, 5) for i, t in enumerate(ODD)] + [(None, "bad", 1), (2, "bad bad", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score int")
    some = spark.createDataFrame([(0, 1), (3, 0), (4, 1), (None, 1), (5, None), (8, 0), (8, 1)], "doc_id long, toxic int")
    for labels in (some, some.limit(0), some.where("toxic = 0")):
        model = toxicity.fit(spark, df, labels)
        got = toxicity.score(spark, df, model).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
        assert toxicity.keep_clean(spark, df, model).columns == df.columns
        assert toxicity.score(spark, df.limit(0), model).count() == 0


def test_an_id_that_many_rows_share_is_sampled_by_its_texts(spark, monkeypatch):
    words = [f"w{i}" for i in range(50)]
    clean = [(1, " ".join(words[i % 40 : i % 40 + 9]) + f" n{i}") for i in range(400)] + [(1, "the same text")] * 200
    toxic = [(2, f"{words[i % 50]} vile scum n{i}") for i in range(60)]
    df = spark.createDataFrame(clean + toxic, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int")
    fitted = []
    logistic = toxicity._logistic
    monkeypatch.setattr(toxicity, "_logistic", lambda x, y: fitted.append(len(y)) or logistic(x, y))
    whole, part = toxicity.fit(spark, df, labels), toxicity.fit(spark, df, labels, sample=100)
    assert fitted[0] == 461 and 30 < fitted[1] < 170
    assert whole.weights == part.weights and {b"vile", b"scum"} <= whole.weights.keys()  # all rows count as words
    assert toxicity.fit(spark, df, labels, sample=100) == part


# Language identification


def test_probabilities_of_a_model_add_up(spark):
    df = spark.createDataFrame([(i, "en", "abab abba baab aabb ab") for i in range(3)], "doc_id long, lang string, text string")
    s = langid.Scorer(langid.fit(spark, df))
    p = lambda w: math.exp(s.words([w])[0][0])
    total = sum(p(b"".join(w)) for n in range(1, 11) for w in itertools.product([b"a", b"b"], repeat=n))
    assert 0.9 < total < 1  # words of a and b carry nearly all mass, never more than one


def test_models_equal_plain_counts_of_all_grams(spark):
    """Every gram takes part, in two languages, also the rarest of 600,000 of one language."""
    rng = np.random.default_rng(11)
    draw = lambda n, k: ["".join(chr(0x4E00 + c) for c in rng.integers(0, 20_000, k)) for _ in range(n)]
    junk = draw(6_000, 100)
    small = ["abab abba baab aabb ab", "ab ba"]
    df = spark.createDataFrame([(i, "xx", t) for i, t in enumerate(junk)] + [(-1 - i, "en", t) for i, t in enumerate(small)], "doc_id long, lang string, text string")
    model = langid.fit(spark, df)
    assert model.languages == ["en", "xx"]
    scorer = langid.Scorer(model)
    for j, texts in enumerate((small, junk)):
        cut = [w.decode() for t in texts for w in langid.letters(t)]
        count = [None, {}, {}, {}, Counter(w[i : i + 4] for w in ("\0\0\0" + w + "\1" for w in cut) for i in range(len(w) - 3))]
        for k in (3, 2, 1):
            count[k] = Counter(g[1:] for g in count[k + 1])
        law, of = [None], [None]
        for k in (1, 2, 3, 4):
            once, twice = (sum(v == c for v in count[k].values()) for c in (1, 2))
            law.append(min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.05)
            total, kinds = Counter(), Counter()
            for g, n in count[k].items():
                total[g[:-1]] += n
                kinds[g[:-1]] += 1
            of.append((total, kinds))

        def p(g, k):
            if not k:
                return 1 / langid.ALPHABET
            g = g[len(g) - k :]
            total, kinds = of[k]
            if not total[g[:-1]]:
                return p(g, k - 1)
            return (max(count[k].get(g, 0) - law[k], 0) + law[k] * kinds[g[:-1]] * p(g, k - 1)) / total[g[:-1]]

        for w in [*cut[:3], *cut[-3:], "abc", "q", "b" * 9]:
            marked = "\0\0\0" + w + "\1"
            want = sum(math.log(p(marked[i : i + 4], 4)) for i in range(len(marked) - 3))
            assert math.isclose(scorer.words([w.encode()])[0][j], want, rel_tol=1e-4), (j, w)


def test_languages_of_held_out_documents(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op5_kneser_ney_language(spark, SF).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(truth) and all(r.held_out == (remainder(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in got)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.98
    assert sum(r.accepted for r in held) / len(held) > 0.99


def test_language_edge_cases(spark):
    rows = [(i, t, "en" if i % 2 else "de", "x") for i, t in enumerate(ODD)] + [(None, "the", None, "x"), (50, "der", "de", "x"), (50, "der", "de", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, accepted string")
    model = langid.fit(spark, df)
    got = {r.doc_id: r for r in langid.predict(spark, df, model).collect()}
    for i, t in enumerate(ODD):
        assert (got[i].lang_pred == "und") == (not langid.has_letter(t)), t
    assert langid.keep_accepted(spark, df, model).columns == df.columns
    none = langid.fit(spark, df.limit(0))
    assert {r.lang_pred for r in langid.predict(spark, df, none).collect()} == {"und"}
    assert langid.predict(spark, df.limit(0), model).count() == 0


def test_foreign_text_is_rejected(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(spark, docs)
    odd = spark.createDataFrame([(1, "Ελληνικά κείμενα που κανένα μοντέλο δεν έχει δει " * 20), (2, "日本語の文章です " * 50)], "doc_id long, text string")
    assert not any(r.accepted for r in langid.predict(spark, odd, model).collect())


def test_rejection_limits_come_from_all_training_texts(spark):
    rng = np.random.default_rng(3)
    words = np.array(["der", "und", "haus", "maus", "baum", "stadt", "fluss", "berg"])
    texts = [" ".join(rng.choice(words, rng.integers(1, 30))) for _ in range(45_000)]
    docs = spark.createDataFrame([(i, "de" if i % 3 else "xx", t) for i, t in enumerate(texts)], "doc_id long, lang string, text string").repartition(4)
    model = langid.fit(spark, docs)
    sums, size = langid.Scorer(model)(texts)
    for j, mine in ((0, [i for i in range(45_000) if i % 3]), (1, range(0, 45_000, 3))):
        e, s = (-sums[mine, j] / size[mine]), size[mine]
        centre = np.average(e, weights=s)
        a, b = np.linalg.lstsq(np.column_stack([np.ones(len(e)), 1 / s]), (e - centre) ** 2, rcond=None)[0]
        a, b = max(a, 1e-4), max(b, 1e-4)
        limit = max(0.0, np.quantile((e - centre) / np.sqrt(a + b / s), 0.9999)) + langid.MARGIN
        assert np.allclose([model.centre[j], *model.spread[j], model.limit[j]], [centre, a, b, limit], rtol=1e-6, atol=1e-9)
    want = sorted(map(tuple, langid.predict(spark, docs, langid.fit(spark, docs, F.col("doc_id") % 7 != 1)).collect()))
    got = sorted(map(tuple, langid.fit_predict(spark, docs, F.col("doc_id") % 7 != 1).collect()))
    assert [r[:2] + r[3:] for r in got] == [r[:2] + r[3:] for r in want] and np.allclose([r[2] for r in got], [r[2] for r in want])
