"""Toxic passages by maximum-scoring segments of token log-odds.

A word's weight is its log-odds ratio between toxic and clean training texts under an informative Dirichlet
prior (the prior counts follow the word's share of all training words), less one standard deviation, where it
is significant. A word counts once a text, so that one text's repetitions weigh no more than its label. Every
other word costs a small drift, so that the expected score is negative and segments end. One linear scan
finds all maximal scoring segments of a text. For texts without toxic passages the best segment of n words
follows an extreme-value law, P(S >= x) = 1 - exp(-K n exp(-lambda x)); lambda solves
sum p(w) exp(lambda s(w)) = 1 over clean words, K is fitted to clean texts. Segments are rated by their
expected number under it, and a logistic curve over a text's segments gives its probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import forget, in_batches, prepare, written

#: Labelled documents to learn from, at most (about; chosen by a hash of their ids).
SAMPLE = 60_000
#: Prior counts as a share of all counts, least z-score of a weight, cost of each other word.
PRIOR, SIGNIFICANT, DRIFT = 0.1, 3.0, 0.05
#: A passage is significant if fewer than this many are expected in clean text of that length.
E_VALUE = 0.05
#: Probability from which a text counts as toxic.
THRESHOLD = 0.3

#: ASCII that is no letter or digit separates words; A-Z is folded; all other bytes belong to words.
FOLD = bytes((c | 32) if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
WORD = re.compile(rb"[^ ]+")


class Model(NamedTuple):
    weights: dict[bytes, float]
    lam: float
    log_k: float
    curve: tuple[float, float, float, float]


class Segment(NamedTuple):
    start: int
    end: int
    score: float


def folded(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").translate(FOLD)


def maximal_segments(hits: list[tuple[int, float]], drift: float = DRIFT) -> list[Segment]:
    """All maximal scoring segments of a sequence whose items cost ``drift`` but for the hits (place, weight).

    The linear scan keeps a list of candidate segments with the cumulative score before (left) and after
    (right) each, and a link to the nearest earlier one with a smaller left. A new one is merged with the last whose
    left is smaller, unless that one's right is not smaller. If none has a smaller left, all earlier ones are final.
    """
    final: list[list] = []
    kept: list[list] = []  # start, end, left, right, link
    total, at = 0.0, 0
    for place, weight in hits:
        total -= drift * (place - at)
        at = place + 1
        if weight <= 0:
            total += weight
            continue
        new = [place, place + 1, total, total + weight]
        total += weight
        j = len(kept) - 1
        while True:
            while j >= 0 and kept[j][2] >= new[2]:
                j = kept[j][4]
            if j < 0:
                final += kept
                kept = [[*new, -1]]
                break
            if kept[j][3] >= new[3]:
                kept.append([*new, j])
                break
            new, link = [kept[j][0], new[1], kept[j][2], new[3]], kept[j][4]
            del kept[j:]
            j = link
    return [Segment(a, b, right - left) for a, b, left, right, _ in final + kept]


def hits_of(words: list[bytes], weights: dict[bytes, float]) -> list[tuple[int, float]]:
    return [(i, weights[w]) for i, w in enumerate(words) if w in weights]


def features(words: list[bytes], model: Model) -> tuple[float, float, float]:
    """Best normalised score, sum of the positive ones, share of words in significant passages."""
    n = max(len(words), 1)
    base = model.log_k + math.log(n)
    rated = [(model.lam * s.score - base, s) for s in maximal_segments(hits_of(words, model.weights))]
    best = max([r for r, _ in rated], default=-base)
    good = [(r, s) for r, s in rated if r > -math.log(E_VALUE)]
    return min(best, 60.0), math.log1p(sum(max(r, 0.0) for r, _ in rated)), sum(s.end - s.start for _, s in good) / n


def probability(x: tuple[float, float, float], curve: tuple[float, ...]) -> float:
    z = curve[0] + sum(c * v for c, v in zip(curve[1:], x))
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def passages(text: str, model: Model) -> list[tuple[int, int, float, float]]:
    """(start, end) in characters, score and expected number of every significant passage."""
    raw = folded(text)
    if not any(w in model.weights for w in raw.split()):
        return []
    spans = [m.span() for m in WORD.finditer(raw)]
    words = [raw[a:b] for a, b in spans]
    base, out = model.log_k + math.log(max(len(words), 1)), []
    whole = text.encode("utf-8", "surrogatepass")
    chars = lambda end: len(whole[:end].decode("utf-8", "surrogatepass"))
    for s in maximal_segments(hits_of(words, model.weights)):
        rate = base - model.lam * s.score
        if rate < math.log(E_VALUE):
            out.append((chars(spans[s.start][0]), chars(spans[s.end - 1][1]), s.score, math.exp(max(rate, -700))))
    return out


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> tuple[float, ...]:
    """Newton's method; the ridge keeps separable data finite."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(w.tolist())


def _lambda(scores: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of sum p exp(lambda s) = 1 (mean score negative, some score positive)."""
    if not (scores > 0).any():
        return 1.0
    low, high = 1e-6, 1.0
    value = lambda t: float((shares * np.exp(np.minimum(t * scores, 700))).sum()) - 1
    while value(high) < 0 and high < 1e6:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (low, mid) if value(mid) > 0 else (mid, high)
    return (low + high) / 2


def fit(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, may_learn: Column | None = None, id_col: str = "doc_id",
    text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE,
) -> Model:
    """Learn from about ``sample`` labelled documents at most, of those for which ``may_learn`` (over id_col) holds.

    The sampled labels, a table of bounded size, are broadcast to the scan of the texts; word counts are
    aggregated by Spark. All words that are clear enough have a weight; as each takes several toxic texts, the sample
    bounds them. Rows that share an id all count as words; the curve is fitted to about ``sample`` different texts at most, and
    texts that share an id and are equal count once in it. Null labels, ids and texts teach nothing. Without a toxic and a clean text there is no weight, and every text gets
    the share of toxic labels (0 without labels).
    """
    prepare(spark)
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    if may_learn is not None:
        known = known.where(may_learn)
    known = known.groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    n = known.count()
    share = min(1.0, sample / max(n, 1))
    chosen = known.where(F.expr(f"pmod(xxhash64(doc_id), 1048576) < {math.ceil(share * 1048576)}"))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where(F.col(text_col).isNotNull())
    train = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", F.xxhash64("text").alias("print"), "text", "toxic")

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = Counter(), Counter()
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found[toxic != 0].update(set(folded(text).split()))
        both = list(found[0].keys() | found[1].keys())
        columns = [[f[w] for w in both] for f in found]
        # The null word counts the rows.
        return pa.record_batch(
            [pa.array([*both, None], pa.binary()), pa.array([*columns[0], batch.num_rows], pa.int64()), pa.array([*columns[1], 0], pa.int64())],
            names=["word", "clean", "toxic"],
        )

    counts = train.select("text", "toxic").mapInArrow(in_batches(count), "word binary, clean long, toxic long")
    counts = counts.groupBy("word").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
    counts = written(counts, "toxic-words")
    n_rows = counts.where("word is null").agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    counts = counts.where("word is not null")
    clean, toxic = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(F.sum("t"), F.lit(0))).first()
    if not clean or not toxic:
        tox = known.agg(F.avg("toxic")).first()[0] or 0.0
        bias = math.log(max(tox, 1e-9) / max(1 - tox, 1e-9))
        return Model({}, 1.0, 0.0, (bias, 0.0, 0.0, 0.0))
    total = PRIOR * (clean + toxic)
    prior = F.lit(PRIOR) * (F.col("c") + F.col("t"))
    odds = lambda y, n: F.log((y + prior) / (n + total - y - prior))
    delta = odds(F.col("t"), toxic) - odds(F.col("c"), clean)
    deviation = F.sqrt(1 / (F.col("t") + prior) + 1 / (F.col("c") + prior))
    strong = counts.select("word", (F.col("c") + prior).alias("p"), (delta - deviation).alias("weight"), (delta / deviation).alias("z"))
    strong = strong.where((F.col("z") >= SIGNIFICANT) & (F.col("weight") > DRIFT))
    rows = strong.orderBy("word").collect()
    weights = {bytes(r.word): r.weight for r in rows}
    listed = np.array([r.p for r in rows]) / (clean + total)
    lam = _lambda(np.array([-DRIFT, *[r.weight for r in rows]]), np.array([1 - listed.sum(), *listed]))
    draft = Model(weights, lam, 0.0, (0.0,) * 4)
    part = math.ceil(min(1.0, sample / max(n_rows, 1)) * 1048576)
    judged = train.where(F.expr(f"pmod(xxhash64(doc_id, print), 1048576) < {part}"))

    def rated(model: Model) -> list:
        """best, total, share, n (words), toxic of the judged texts, about ``sample`` of them at most."""

        def rate(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for text in batch.column(2).to_pylist():
                words = folded(text).split()
                out.append((*features(words, model), float(max(len(words), 1))))
            values = [pa.array(c, pa.float64()) for c in zip(*out)]
            return pa.record_batch([batch.column(0), batch.column(1), *values, batch.column(3)], names=["doc_id", "print", "best", "total", "share", "n", "toxic"])

        kinds = "doc_id long, print long, best double, total double, share double, n double, toxic int"
        return judged.mapInArrow(in_batches(rate), kinds).distinct().orderBy("doc_id", "print").collect()

    seen = rated(draft)  # with K = 1
    best, n_words = (np.array([r[k] for r in seen], dtype=float) for k in ("best", "n"))
    y = np.array([r.toxic != 0 for r in seen], dtype=float)
    # P(best >= x) = 1 - exp(-K exp(-x)), about K exp(-x): half of the clean texts with any hit reach their median.
    clean_best = best[(y == 0) & (best > -np.log(n_words))]
    share_hit = max(len(clean_best), 1) / max(1.0, float((y == 0).sum()))
    log_k = math.log(share_hit / 2) + (float(np.median(clean_best)) if len(clean_best) else 0.0)
    log_k = max(-10.0, min(10.0, log_k))
    model = draft._replace(log_k=log_k)
    seen = rated(model)
    x = np.array([[r.best, r.total, r.share] for r in seen])
    return model._replace(curve=_logistic(x, np.array([r.toxic != 0 for r in seen], dtype=float)))


def score_batch(texts: list[str | None], model: Model) -> list[float]:
    return [probability(features(folded(t or "").split(), model), model.curve) for t in texts]


def score(spark: SparkSession, docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted, passages (start, end, score, e_value) of every row; whole texts, no row moves.

    A null text scores as an empty one. Repeated rows repeat; an empty table gives no rows.
    """
    prepare(spark)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("e_value", pa.float64())]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        scores = score_batch(texts, model)
        found = [[dict(zip(("start", "end", "score", "e_value"), p)) for p in passages(t, model)] for t in texts]
        predicted = [int(s >= THRESHOLD) for s in scores]
        return pa.record_batch(
            [batch.column(0), pa.array(scores, pa.float64()), pa.array(predicted, pa.int32()), pa.array(found, span)],
            names=["doc_id", "score", "predicted", "passages"],
        )

    schema = "doc_id long, score double, predicted int, passages array<struct<start:int,end:int,score:double,e_value:double>>"
    table = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return table.mapInArrow(in_batches(run), schema)


def keep_clean(spark: SparkSession, docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text is not predicted toxic."""
    prepare(spark)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            scores = score_batch(batch.column(at).to_pylist(), model)
            yield batch.filter(pa.array([s < THRESHOLD for s in scores], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
