"""Language identification by interpolated Kneser-Ney character models, one a language.

A model predicts each character of a word, and its end, from the three before it (a mark stands for what
precedes the word). Counts of the four-character grams discount absolutely; lower orders count the distinct
characters that precede a gram. Discounts, continuation counts and probabilities are computed by Spark over all
counted grams; none is dropped. All models share one sorted array of gram hashes, each with the log probabilities
and back-off weights of the languages that have it, so a look-up is a binary search. A text's language is the one of lowest cross-entropy a character. Texts whose cross-entropy lies far outside what training
texts of that language and length show are rejected.

Words repeat, so their log probabilities are computed once a word and remembered.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.medians import ranked_value
from .common import forget, in_batches, prepare, worker_state, written

ORDER = 4
#: Standard deviations above the mean cross-entropy from which a text is rejected, beyond the largest
#: deviation of all but a ten-thousandth of the calibration texts.
MARGIN = 10.0
#: Words remembered by one worker, and the longest that is.
MEMO, LONG = 300_000, 64
#: Different words gathered by a counting task before it sends them on.
GATHER = 200_000
#: Characters with a probability when never seen: the uniform distribution below the first order.
ALPHABET = 1 << 16

#: ASCII that is no letter separates words.
APART = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Model(NamedTuple):
    languages: list[str]
    hashes: np.ndarray  # sorted
    first: np.ndarray  # place of each hash's first entry, and the number of entries
    lang: np.ndarray  # language of each entry
    log_p: np.ndarray  # of each entry, nan where the language has the gram as a context only
    back_off: np.ndarray  # of each entry, 0 where the gram is no context
    unseen: np.ndarray  # log probability of an unseen character, by language
    centre: np.ndarray  # mean cross-entropy of training texts, by language
    spread: np.ndarray  # (a, b) by language: its variance is a + b / length
    limit: np.ndarray  # deviations from which a text is rejected, by language


def letters(text: str) -> list[bytes]:
    """Lower-case words of letters and other characters beyond ASCII, as UTF-8."""
    return text.lower().encode("utf-8", "replace").translate(APART).split()


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def grams(words: list[bytes]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """For each predicted character of each word: the word's place, and for orders 1 to 4 the hashes of the
    gram that it ends and of that gram's context."""
    text = [w.decode("utf-8", "replace") for w in words]
    joined = ("\x00" * (ORDER - 1)).join(["", *[t + "\x01" for t in text]])
    codes = np.frombuffer(joined.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(7)
    place = np.repeat(np.arange(len(text)), [len(t) + ORDER for t in text])
    ends = np.flatnonzero(codes != 7)  # all but the marks
    by_order, acc, power = [], np.zeros(len(codes), np.uint64), np.uint64(1)
    for k in range(ORDER):
        shifted = codes if not k else np.concatenate([np.zeros(k, np.uint64), codes[:-k]])
        acc = acc + shifted * power
        power = np.uint64(int(power) * int(MULTIPLIER) & (1 << 64) - 1)
        by_order.append(mixed(acc + np.uint64(k + 1)))
    none = np.zeros(len(ends), np.uint64)
    contexts = [none, *[by_order[k][ends - 1] for k in range(ORDER - 1)]]
    return place[ends], [h[ends] for h in by_order], contexts


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def kneser_ney(counted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, hash, log_p, back_off) of every gram and context; (lang, unseen), the log probability of an unseen character.

    ``counted``: lang, the hashes h4 to h1 of a gram and its suffixes, those of their contexts x4 to x2, and n.
    The discount of an order follows from the numbers of its grams counted once and twice.
    """
    none, longer, orders = F.lit(0).cast("long"), counted, {}
    for k in range(ORDER, 0, -1):
        if k < ORDER:  # distinct characters before a gram: the distinct longer grams that end in it
            rest = [f"h{j}" for j in range(1, k)] + [f"x{j}" for j in range(2, k + 1)]
            longer = written(longer.groupBy("lang", f"h{k}").agg(F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in rest]), "grams")
        context, suffix = (F.col(f"x{k}"), F.col(f"h{k - 1}")) if k > 1 else (none, none)
        orders[k] = longer.select("lang", F.col(f"h{k}").alias("gram"), context.alias("context"), suffix.alias("suffix"), "n")
    parts, lower, unseen = [], None, None
    for k, t in sorted(orders.items()):
        once, twice = (F.count_if(F.col("n") == c) for c in (1, 2))
        d = F.when(once > 0, F.least(F.lit(0.95), F.greatest(F.lit(0.05), once / (once + 2 * twice)))).otherwise(0.05)
        discounts = F.broadcast(t.groupBy("lang").agg(d.alias("d")))  # a row a language
        contexts = t.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")).join(discounts, "lang")
        contexts = contexts.withColumn("weight", F.col("d") * F.col("kinds") / F.col("total"))
        if k == 1:
            contexts = F.broadcast(contexts)  # one context a language
            unseen = contexts.select("lang", F.log(F.col("weight") / ALPHABET).alias("unseen"))
            t = t.withColumn("below", F.lit(1.0 / ALPHABET))
        else:
            t = t.join(lower, ["lang", "suffix"])  # every suffix of a counted gram is counted
            parts.append(contexts.select("lang", F.col("context").alias("hash"), F.lit(None).cast("float").alias("log_p"), F.log("weight").cast("float").alias("back_off")))
        p = (F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total") + F.col("weight") * F.col("below")).alias("p")
        found = written(t.join(contexts, ["lang", "context"]).select("lang", F.col("gram").alias("suffix"), p), "gram-probabilities")
        parts.append(found.select("lang", F.col("suffix").alias("hash"), F.log("p").cast("float").alias("log_p"), F.lit(None).cast("float").alias("back_off")))
        lower = found.withColumnRenamed("p", "below")
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy("lang", "hash").agg(F.max("log_p").alias("log_p"), F.max("back_off").alias("back_off")), unseen


def fit(
    spark: SparkSession, docs: DataFrame, may_learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang", calibrate: bool = True,
) -> Model:
    """Models from all texts with a non-null language (of the rows for which ``may_learn`` holds); the rejection limits too,
    unless ``calibrate`` is false: then nothing is rejected.

    Spark counts each language's words, then the grams of the different words, and computes the models. The driver
    and the workers hold the finished arrays: 24 bytes for each language's different gram or context at most, none is
    left out. Without training texts there is no language.
    """
    prepare(spark)
    known = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    if may_learn is not None:
        known = known.where(may_learn)
    train = known.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        found: dict[str, Counter] = {}

        def out() -> pa.RecordBatch:
            rows = [(lang, w, n) for lang, c in found.items() for w, n in c.items()]
            found.clear()
            kinds = (pa.string(), pa.binary(), pa.int64())
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows) if rows else ((),) * 3, kinds)], names=["lang", "word", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.setdefault(lang, Counter()).update(letters(text))
            if sum(map(len, found.values())) > GATHER:
                yield out()
        yield out()

    words = train.mapInArrow(count, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        langs, n = np.array(batch.column(0).to_pylist(), dtype=object), batch.column(2).to_numpy()
        every = batch.column(1).to_pylist()
        for lang in dict.fromkeys(langs.tolist()):
            mine = np.flatnonzero(langs == lang)
            place, by_order, contexts = grams([every[i] for i in mine])
            top, first, at = np.unique(by_order[-1], return_index=True, return_inverse=True)
            total = np.bincount(at, n[mine][place]).astype(np.int64)
            signed = lambda h: pa.array(h[first].view(np.int64))
            yield pa.record_batch(
                [pa.array([lang] * len(top)), *(signed(h) for h in by_order[::-1]), *(signed(c) for c in contexts[:0:-1]), pa.array(total)],
                names=["lang", "h4", "h3", "h2", "h1", "x4", "x3", "x2", "n"],
            )

    columns = ["h3", "h2", "h1", "x4", "x3", "x2"]
    counted = words.mapInArrow(in_batches(cut), "lang string, " + ", ".join(f"{c} long" for c in ("h4", *columns, "n")))
    counted = counted.groupBy("lang", "h4").agg(F.sum("n").alias("n"), *[F.first(c).alias(c) for c in columns])
    counted = written(counted, "grams")
    languages = sorted(r.lang for r in counted.select("lang").distinct().collect())
    if not languages:
        nothing = np.empty(0)
        return Model([], np.empty(0, np.uint64), np.zeros(1, np.int64), *[nothing] * 5, np.empty((0, 2)), nothing)
    every, lowest = kneser_ney(counted)
    number = spark.createDataFrame(list(enumerate(languages)), "j int, lang string")
    entries = every.join(F.broadcast(number), "lang").select("hash", "j", "log_p", F.coalesce("back_off", F.lit(0.0).cast("float")).alias("back_off"))
    table = entries.toArrow()
    hash_of, lang_of, log_p, back_off = (table.column(c).to_numpy() for c in ("hash", "j", "log_p", "back_off"))
    del table
    order = np.argsort(hash_of.view(np.uint64), kind="stable")
    hashes, first = np.unique(hash_of.view(np.uint64)[order], return_index=True)
    unseen_of = {r.lang: r.unseen for r in lowest.collect()}
    unseen = np.array([unseen_of[lang] for lang in languages])
    flat = np.zeros(len(languages))
    model = Model(
        languages, hashes, np.append(first, len(order)), lang_of[order].astype(np.int32), log_p[order].astype(np.float32),
        back_off[order].astype(np.float32), unseen, flat, np.zeros((len(languages), 2)), flat + np.inf,
    )
    if not calibrate:
        return model
    training = known.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    return calibrated(written(measured(spark, training, model), "entropies"), model)


class Scorer:
    """Log probabilities of texts by language; remembers words."""

    def __init__(self, model: Model):
        self.model, self.memo = model, {}

    def words(self, words: list[bytes]) -> list[np.ndarray]:
        m = self.model
        place, by_order, contexts = grams(words)
        last = len(m.hashes) - 1

        def rows(h: np.ndarray) -> np.ndarray:
            """Places of the hashes; -1 where missing."""
            at = np.minimum(np.searchsorted(m.hashes, h), last)
            return np.where(m.hashes[at] == h, at, -1)

        def of(at: np.ndarray, values: np.ndarray, otherwise: float) -> np.ndarray:
            """The entries of found hashes, by language."""
            out = np.full((len(at), len(m.languages)), otherwise)
            found = np.flatnonzero(at >= 0)
            starts = m.first[at[found]]
            n = m.first[at[found] + 1] - starts
            entry = np.arange(n.sum()) + np.repeat(starts - np.cumsum(n) + n, n)
            out[np.repeat(found, n), m.lang[entry]] = values[entry]
            return out

        total = None
        for k, (h, x) in enumerate(zip(by_order, contexts)):
            p = of(rows(h), m.log_p, np.nan)
            if not k:
                total = np.where(np.isnan(p), m.unseen, p)
                continue
            total = np.where(np.isnan(p), of(rows(x), m.back_off, 0.0) + total, p)
        sums = np.add.reduceat(total, np.flatnonzero(np.diff(place, prepend=-1)), axis=0)
        return list(sums)

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(log probability by language, characters with word ends) of each text."""
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        cut = [letters(t or "") for t in texts]
        found = [list(map(memo.get, c)) for c in cut]
        new = list({w for c, f in zip(cut, found) if None in map(type_of, f) for w, v in zip(c, f) if v is None})
        for start in range(0, len(new), 20_000):
            part = new[start : start + 20_000]
            memo.update(zip(part, self.words(part)))
        sums = np.zeros((len(texts), len(self.model.languages)))
        size = np.zeros(len(texts))
        for i, c in enumerate(cut):
            if c:
                sums[i] = np.sum(list(map(memo.__getitem__, c)), axis=0)
                size[i] = len(b"".join(c).decode("utf-8", "replace")) + len(c)
        for w in new:
            if len(w) > LONG:
                del memo[w]
        return sums, size


def type_of(value):
    """None for None, else True: arrays don't compare to one truth value."""
    return None if value is None else True


MEASURES = "doc_id long, own int, own_entropy double, best int, score double, lettered boolean, entropy double, size double"


def measured(spark: SparkSession, rows: DataFrame, model: Model) -> DataFrame:
    """Of each row (doc_id, lang, text): the places of its language (null if not learned) and of the best one, the cross-entropies
    of both, the best one's probability, whether there is a letter, and the number of characters."""
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)
    place = {lang: j for j, lang in enumerate(model.languages)}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(2).to_pylist()
        sums, size, best, score, entropy, lettered = _measure(texts, shared)
        own = [place.get(lang) for lang in batch.column(1).to_pylist()]
        at = np.array([-1 if j is None else j for j in own])
        mine = -sums[np.arange(len(at)), at] / np.maximum(size, 1)
        columns = [
            batch.column(0), pa.array(own, pa.int32()), pa.array(mine, mask=at < 0), pa.array(best.astype(np.int32)), pa.array(score), pa.array(lettered),
            pa.array(entropy), pa.array(size),
        ]
        return pa.record_batch(columns, names=[c.split()[0] for c in MEASURES.split(", ")])

    return rows.select("doc_id", "lang", "text").mapInArrow(in_batches(run, keeps=True), MEASURES)


def calibrated(rows: DataFrame, model: Model) -> Model:
    """Mean, spread and limit of the cross-entropy of each language's training texts, from all of them.

    ``rows``: as ``measured`` gives them, stored; those with a place of their own are the training texts. Means and the two
    numbers of the spread follow from sums, the limit from a search for the two values around its rank.
    """
    rows = rows.where("own IS NOT NULL AND size > 0").select("own", F.col("own_entropy").alias("e"), F.col("size").alias("s"))
    k = len(model.languages)
    centre, spread, limit = np.zeros(k), np.ones((k, 2)), np.full(k, np.inf)
    of = lambda values: F.get(F.array(*[F.lit(float(v)) for v in values]), F.col("own"))
    found = rows.groupBy("own").agg(F.count("e").alias("n"), F.try_divide(F.sum(F.col("e") * F.col("s")), F.sum("s")).alias("m"))
    many = {r.own: r for r in found.collect() if r.n > 1}
    for j, r in many.items():
        centre[j] = r.m
    if not many:
        return model._replace(centre=centre, spread=spread, limit=limit)
    x, y = 1 / F.col("s"), F.pow(F.col("e") - of(centre), 2)
    sums = rows.groupBy("own").agg(F.sum(x).alias("x"), F.sum(x * x).alias("xx"), F.sum(y).alias("y"), F.sum(x * y).alias("xy"))
    for r in sums.collect():
        if r.own in many:
            a, b = np.linalg.lstsq(np.array([[many[r.own].n, r.x], [r.x, r.xx]]), np.array([r.y, r.xy]), rcond=None)[0]
            spread[r.own] = max(a, 1e-4), max(b, 1e-4)
    deviation = (F.col("e") - of(centre)) / F.sqrt(of(spread[:, 0]) + of(spread[:, 1]) / F.col("s"))
    away = written(rows.select("own", deviation.alias("v")), "deviations")
    ends = away.groupBy("own").agg(F.min("v").alias("low"), F.max("v").alias("high")).collect()
    for r in ends:
        if r.own in many:
            values = away.where(F.col("own") == r.own).select("v")
            rank = (many[r.own].n - 1) * 0.9999  # from 0
            below = ranked_value(values, r.low, r.high, int(rank) + 1)
            above = ranked_value(values, r.low, r.high, min(int(rank) + 2, many[r.own].n))
            limit[r.own] = max(0.0, below + (above - below) * (rank - int(rank))) + MARGIN
    return model._replace(centre=centre, spread=spread, limit=limit)


def scorer(shared) -> Scorer:
    """One scorer a worker and broadcast model."""
    key = shared._jbroadcast.id() if getattr(shared, "_jbroadcast", None) else id(shared.value)
    return worker_state(("languages", key), lambda: Scorer(shared.value))


def _measure(texts: list[str | None], shared) -> tuple:
    """(log probability by language, characters, best language, its probability among the languages, its cross-entropy, whether
    there is a letter) of each text."""
    sums, size = scorer(shared)(texts)
    best = sums.argmax(axis=1)
    rows = np.arange(len(texts))
    posterior = 1 / np.exp(np.minimum(sums - sums[rows, best][:, None], 0)).sum(axis=1)
    lettered = np.array([has_letter(t) for t in texts], dtype=bool)
    return sums, size, best, np.where(lettered, posterior, 0.0), -sums[rows, best] / np.maximum(size, 1), lettered


def judge(texts: list[str | None], shared) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(language, probability among the languages, accepted) of each text."""
    model = shared.value
    if not model.languages:
        return ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
    _, size, best, score, entropy, lettered = _measure(texts, shared)
    deviation = (entropy - model.centre[best]) / np.sqrt(model.spread[best, 0] + model.spread[best, 1] / np.maximum(size, 1))
    langs = [model.languages[b] if ok else "und" for b, ok in zip(best.tolist(), lettered.tolist())]
    return langs, score, lettered & (deviation <= model.limit[best])


def fit_predict(
    spark: SparkSession, docs: DataFrame, may_learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """As ``predict`` by a model that ``fit`` makes of the same documents, with each text scored once for both: a small stored
    table of measures gives the limits and, by them, the acceptance."""
    model = fit(spark, docs, may_learn, id_col, text_col, lang_col, calibrate=False)
    if not model.languages:
        return predict(spark, docs, model, id_col, text_col)
    learns = F.coalesce(may_learn & F.col(text_col).isNotNull(), F.lit(False))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.when(learns, F.col(lang_col)).alias("lang"), F.col(text_col).alias("text"))
    rows = written(measured(spark, rows, model), "entropies")
    model = calibrated(rows, model)
    of = lambda values: F.get(F.array(*[F.lit(v) for v in values]), F.col("best"))
    floats = lambda values: of([float(v) for v in values])
    variance = floats(model.spread[:, 0]) + floats(model.spread[:, 1]) / F.greatest(F.col("size"), F.lit(1.0))
    accepted = F.col("lettered") & ((F.col("entropy") - floats(model.centre)) / F.sqrt(variance) <= floats(model.limit))
    lang = F.when(F.col("lettered"), of(model.languages)).otherwise("und")
    return rows.select("doc_id", lang.alias("lang_pred"), "score", accepted.alias("accepted"))


def predict(spark: SparkSession, docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, accepted of every row; whole texts, no row moves.

    Texts that are null or have no letter are ``und`` with score 0 and not accepted. Ties go to the language first
    in order. Repeated rows repeat; an empty table gives no rows; without a learned language all are ``und``.
    """
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, scores, accepted = judge(batch.column(1).to_pylist(), shared)
        return pa.record_batch([batch.column(0), pa.array(langs), pa.array(scores), pa.array(accepted)], names=["doc_id", "lang_pred", "score", "accepted"])

    table = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return table.mapInArrow(in_batches(run, keeps=True), "doc_id long, lang_pred string, score double, accepted boolean")


def keep_accepted(spark: SparkSession, docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose language is accepted."""
    prepare(spark)
    at = docs.columns.index(text_col)
    shared = spark.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(judge(batch.column(at).to_pylist(), shared)[2]))

    return docs.mapInArrow(in_batches(run, keeps=True), docs.schema)
