"""Hidden Markov language model: Baum-Welch counts aggregated over partitions, exact likelihoods by the forward recursion.

A text is its words and one end. The states emit symbols: each of the most frequent training words, one
symbol for each class of all other words (by a hash of the word's last bytes), and the end. Within a class a
word's probability does not depend on the state: (c + 1/2) / (N_class + (V_class + 1) / 2), with all unseen
words of the class as one. So the state tables have a bounded size, while every word of the corpus has
its own count: rare words' counts are joined by Spark, as their factor of a text's likelihood is a plain sum.

Documents are read once into blocks of word numbers with each block's own vocabulary. Every Baum-Welch step
runs over all blocks where they lie, adds up each task's expected counts, and sums them over tasks by Spark; the driver
sees one table of (symbols x states). Every step takes all training documents. Training sees long texts in
stretches of ``STRETCH`` words; scores are of whole texts.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_dir
from .common import prepare, words, written

#: States, words with a symbol of their own (at most), classes of the other words.
STATES, HEAD, CLASSES = 8, 32_768, 2_048
#: Share of the training documents in each Baum-Welch step: all of them.
SCHEDULE = (1.0,) * 8
#: Characters and documents of a block; words that one pass of the recursions holds; words of a training stretch.
BLOCK_CHARS, BLOCK_DOCS, PASS, STRETCH = 12_000_000, 8_192, 200_000, 512
#: Share of the plain word distribution in every state's emissions; first probability to stay in a state.
BLEND, STAY = 0.02, 0.9
#: Expected counts travel in slices of so many symbols, and are first summed over so many groups of tasks.
SLICE, SALTS = 1_024, 16


class Model(NamedTuple):
    start: np.ndarray  # (states,)
    move: np.ndarray  # (states, states)
    emit: np.ndarray  # (symbols, states)
    head: np.ndarray  # sorted word hashes
    head_counts: np.ndarray
    class_mass: np.ndarray  # N_class + (V_class + 1) / 2
    tokens: int  # N
    kinds: int  # V
    ends: int  # training documents

    @property
    def end(self) -> int:
        return len(self.head) + len(self.class_mass)


def blocks(spark: SparkSession, docs: DataFrame, held_out: Column, id_col: str, text_col: str) -> DataFrame:
    """block, doc_ids, held, lengths (words), tokens (places in the block's vocabulary), and the vocabulary:
    hashes, classes and training counts. A null text has no words."""
    table = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held")
    )
    names = ["block", "doc_ids", "held", "lengths", "tokens", "hashes", "classes", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, start = TaskContext.get().partitionId() << 32, 0

        def fresh():
            vocabulary = defaultdict()
            vocabulary.default_factory = vocabulary.__len__
            return [], [], [], vocabulary, [0]

        ids, held, tokens, vocabulary, chars = fresh()

        def out() -> pa.RecordBatch:
            nonlocal start
            counts = np.zeros(len(vocabulary), np.int64)
            for h, t in zip(held, tokens):
                if not h:
                    np.add.at(counts, t, 1)
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, vocabulary), np.uint64, len(vocabulary)).view(np.int64)
            classes = np.fromiter((zlib.crc32(w[-3:]) % CLASSES for w in vocabulary), np.int16, len(vocabulary))
            lengths = np.array([len(t) for t in tokens], "<i4")
            flat = np.concatenate(tokens).astype("<u4") if tokens else np.empty(0, "<u4")
            start += 1
            values = [
                pa.array([number + start], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([held], pa.list_(pa.bool_())),
                pa.array([lengths.tobytes()], pa.binary()), pa.array([flat.tobytes()], pa.binary()),
                pa.array([hashes], pa.list_(pa.int64())), pa.array([classes], pa.list_(pa.int16())), pa.array([counts], pa.list_(pa.int64())),
            ]
            return pa.record_batch(values, names=names)

        for batch in batches:
            for doc_id, text, h in zip(*(c.to_pylist() for c in batch.columns)):
                found = words(text)
                ids.append(doc_id)
                held.append(h)
                tokens.append(np.fromiter(map(vocabulary.__getitem__, found), np.uint32, len(found)))
                chars[0] += len(text)
                if chars[0] >= BLOCK_CHARS or len(ids) >= BLOCK_DOCS:
                    yield out()
                    ids, held, tokens, vocabulary, chars = fresh()
        if ids:
            yield out()

    schema = "block long, doc_ids array<long>, held array<boolean>, lengths binary, tokens binary, hashes array<long>, classes array<short>, counts array<long>"
    path = fresh_dir(spark, "word-blocks")
    table.mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def _symbols(hashes: np.ndarray, classes: np.ndarray, model: Model) -> np.ndarray:
    """Symbol of each vocabulary entry."""
    if not len(model.head):
        return classes.astype(np.int64)
    at = np.minimum(np.searchsorted(model.head, hashes), len(model.head) - 1)
    return np.where(model.head[at] == hashes, at, len(model.head) + classes.astype(np.int64))


def _passes(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Sequences by falling length, as many at a time as hold some ``PASS`` words."""
    order = np.argsort(-lengths, kind="stable")
    total = np.cumsum(lengths[order])
    start = 0
    while start < len(order):
        end = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + PASS, "right")))
        yield order[start:end]
        start = end


def _by_time(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Items of sequences (by falling length) in order of their place; number of sequences at each place."""
    lengths = np.array([len(s) for s in sequences])
    active = len(sequences) - np.searchsorted(lengths[::-1], np.arange(lengths[0]), "right")
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(lengths.sum()) - np.repeat(starts, lengths)
    return np.concatenate(sequences)[np.argsort(place, kind="stable")], active


def forward(model: Model, sequences: list[np.ndarray], keep: bool = False):
    """Natural log likelihood of each symbol sequence (by falling length, none empty).

    Scaled recursion: at each place the state probabilities given all symbols so far, and the factor by which
    they were scaled; the logs of the factors add up to the log likelihood. With ``keep``, all of these too.
    """
    symbols, active = _by_time(sequences)
    emissions = model.emit[symbols]
    states = emissions.shape[1]
    alpha = np.empty((len(symbols) if keep else 0, states))
    scale = np.empty(len(symbols))
    at, before = 0, None
    for n in active.tolist():
        now = emissions[at : at + n]
        now = now * (model.start if before is None else before[:n] @ model.move)
        factor = now.sum(axis=1)
        now /= factor[:, None]
        scale[at : at + n] = factor
        if keep:
            alpha[at : at + n] = now
        before = now
        at += n
    rank = np.concatenate([np.arange(n) for n in active.tolist()])
    total = np.bincount(rank, np.log(scale), len(sequences))
    return (total, symbols, active, emissions, alpha, scale) if keep else total


def expected(model: Model, sequences: list[np.ndarray], out: tuple[np.ndarray, np.ndarray, np.ndarray]) -> float:
    """Add the expected starts, moves and emissions of the sequences to ``out``; their log likelihood."""
    total, symbols, active, emissions, alpha, scale = forward(model, sequences, keep=True)
    starts, moves, emits = out
    ends = np.cumsum(active)
    beta = np.ones((active[-1], alpha.shape[1]))
    moved = np.zeros_like(moves)
    gamma = alpha  # overwritten place by place from the end, where alpha is no longer needed
    for t in range(len(active) - 1, -1, -1):
        n, a = int(active[t]), int(ends[t] - active[t])
        later = len(beta)
        if later < n:  # sequences that end here
            beta = np.concatenate([beta, np.ones((n - later, beta.shape[1]))])
        if t:
            m = int(active[t - 1])
            ahead = emissions[a : a + n] * beta / scale[a : a + n, None]
            b = a - m
            moved += alpha[b : b + n].T @ ahead
            new = ahead @ model.move.T
        gamma[a : a + n] *= beta
        if t:
            beta = new
    starts += gamma[: active[0]].sum(axis=0)
    moves += moved * model.move
    for k in range(gamma.shape[1]):
        emits[:, k] += np.bincount(symbols, gamma[:, k], emits.shape[0])
    return float(total.sum())


def _documents(row: dict, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols of all words, lengths, bounds) of a block."""
    hashes, classes = (np.asarray(row[c]) for c in ("hashes", "classes"))
    lengths = np.frombuffer(row["lengths"], "<i4").astype(np.int64)
    tokens = np.frombuffer(row["tokens"], "<u4")
    of = _symbols(hashes, classes, model) if len(hashes) else np.empty(0, np.int64)
    return of[tokens], lengths, np.concatenate([[0], np.cumsum(lengths)])


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield {
            name: column[i].values.to_numpy(zero_copy_only=False)
            if pa.types.is_list(column.type) and name != "doc_ids" and column[i].is_valid
            else column[i].as_py()  # ids may be null
            for name, column in zip(batch.schema.names, batch.columns)
        }


def step(spark: SparkSession, table: DataFrame, model: Model) -> tuple[Model, float]:
    """One Baum-Welch step over all training documents: (new model, log likelihood under the old)."""
    shared = spark.sparkContext.broadcast(model)
    n_symbols, n_states = model.emit.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        starts, moves, emits = np.zeros(n_states), np.zeros((n_states, n_states)), np.zeros((n_symbols, n_states))
        likelihood = 0.0
        for batch in batches:
            for row in _rows(batch):
                symbols, lengths, bounds = _documents(row, model)
                parts = []
                for i in np.flatnonzero(~row["held"].astype(bool)).tolist():
                    s = np.append(symbols[bounds[i] : bounds[i + 1]], model.end)
                    parts += [s[a : a + STRETCH] for a in range(0, len(s), STRETCH)]
                for some in _passes(np.array([len(p) for p in parts], dtype=np.int64)) if parts else ():
                    likelihood += expected(model, [parts[i] for i in some.tolist()], (starts, moves, emits))
        salt = TaskContext.get().partitionId() % SALTS
        pieces = [(-1, np.concatenate([starts, moves.ravel(), [likelihood]]))]
        pieces += [(a // SLICE, emits[a : a + SLICE].ravel()) for a in range(0, n_symbols, SLICE) if emits[a : a + SLICE].any()]
        yield pa.record_batch(
            [pa.array([p for p, _ in pieces], pa.int32()), pa.array([salt] * len(pieces), pa.int32()), pa.array([v.astype("<f4" if p >= 0 else "<f8").tobytes() for p, v in pieces], pa.binary())],
            names=["slice", "salt", "sums"],
        )

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for p, salt, raw in zip(*(c.to_pylist() for c in batch.columns)):
                value = np.frombuffer(raw, "<f4" if p >= 0 else "<f8").astype(np.float64)
                sums[p, salt] = sums[p, salt] + value if (p, salt) in sums else value
        for (p, salt), value in sums.items():
            raw = value.astype("<f4" if p >= 0 else "<f8").tobytes()
            yield pa.record_batch([pa.array([p], pa.int32()), pa.array([salt], pa.int32()), pa.array([raw], pa.binary())], names=["slice", "salt", "sums"])

    schema = "slice int, salt int, sums binary"
    wanted = table.select("held", "lengths", "tokens", "hashes", "classes")
    partial = wanted.mapInArrow(run, schema).repartition("slice", "salt").mapInArrow(added, schema)
    rows = partial.withColumn("salt", F.lit(0)).repartition("slice").mapInArrow(added, schema).collect()
    emits, head = np.zeros((n_symbols, n_states)), np.zeros(n_states + n_states**2 + 1)
    for r in rows:
        if r.slice < 0:
            head = np.frombuffer(r.sums, "<f8")
        else:
            part = np.frombuffer(r.sums, "<f4").reshape(-1, n_states)
            emits[r.slice * SLICE : r.slice * SLICE + len(part)] = part
    shared.unpersist()
    starts, moves = head[:n_states], head[n_states:-1].reshape(n_states, n_states)
    plain = _plain(model)
    emit = (1 - BLEND) * (emits + 1e-12) / (emits + 1e-12).sum(axis=0) + BLEND * plain[:, None]
    normal = lambda x: x / x.sum(axis=-1, keepdims=True)
    return model._replace(start=normal(starts + 1.0), move=normal(moves + 1.0), emit=emit), float(head[-1])


def _plain(model: Model) -> np.ndarray:
    """The symbols' shares of the training tokens."""
    mass = np.concatenate([model.head_counts + 0.5, model.class_mass, [model.ends + 0.5]])
    return mass / mass.sum()


def vocabulary(spark: SparkSession, table: DataFrame) -> tuple[DataFrame, Model]:
    """Training counts of all words (hash, class, c > 0), and a model that knows the words but not yet the states."""
    exploded = table.select(F.explode(F.arrays_zip("hashes", "classes", "counts")).alias("w"))
    counted = exploded.where("w.counts > 0").groupBy(F.col("w.hashes").alias("hash"))
    counts = written(counted.agg(F.first("w.classes").alias("class"), F.sum("w.counts").alias("c")), "word-counts")
    # The most frequent words, by levels of an eighth of a power of two, as far as they fit.
    level = F.floor(8 * F.log2("c"))
    levels = sorted(map(tuple, counts.groupBy(level.alias("l")).agg(F.count(F.lit(1)), F.sum("c")).collect()), reverse=True)
    cut, held = math.inf, 0
    for at, n, _ in levels:
        if held + n > HEAD:
            break
        cut, held = at, held + n
    counts = counts.withColumn("in_head", level >= F.lit(float(cut)))
    head = counts.where("in_head").select("hash", "c").toArrow().sort_by("hash") if held else None
    mass = np.full(CLASSES, 0.5)
    for r in counts.where("not in_head").groupBy("class").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect():
        mass[r["class"]] += r.n + r.v / 2
    ends = table.select(F.sum(F.size(F.filter("held", lambda h: ~h)))).first()[0] or 0
    hashes, head_counts = (head.column(c).to_numpy() for c in ("hash", "c")) if held else (np.empty(0, np.int64),) * 2
    tokens, kinds = sum(c for _, _, c in levels) + ends, sum(n for _, n, _ in levels) + (ends > 0)
    nothing = np.empty(0)
    return counts, Model(nothing, nothing, nothing, hashes, head_counts.astype(np.int64), mass, tokens, kinds, ends)


def fit(spark: SparkSession, table: DataFrame, model: Model, states: int = STATES, schedule: tuple[float, ...] = SCHEDULE) -> tuple[Model, list[float]]:
    """Baum-Welch from the plain word distribution, disturbed by a fixed noise: (model, log likelihood before each step).

    Each item of ``schedule`` is a step; a step over less than all documents would replace the counts of the others.
    """
    if any(share != 1 for share in schedule):
        raise ValueError("a Baum-Welch step takes all training documents")
    rng = np.random.default_rng(7)
    emit = _plain(model)[:, None] * np.exp(rng.normal(0, 0.7, (model.end + 1, states)))
    move = np.full((states, states), (1 - STAY) / max(1, states - 1)) if states > 1 else np.ones((1, 1))
    np.fill_diagonal(move, STAY if states > 1 else 1.0)
    model = model._replace(start=np.full(states, 1 / states), move=move, emit=emit / emit.sum(axis=0))
    seen = []
    for _ in schedule:
        model, likelihood = step(spark, table, model)
        seen.append(likelihood)
    return model, seen


def score(spark: SparkSession, table: DataFrame, counts: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: a row a document.

    The forward recursion runs over whole texts where the blocks lie; rare words' counts are joined once for each
    block and word, and meet their block for the sums.
    """
    shared = spark.sparkContext.broadcast(model)
    names = ["block", "doc_ids", "held", "lengths", "known", "logs", "scores", "rare", "rare_lengths"]

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        logs_of = np.concatenate([np.log10(m.head_counts + 0.5), np.zeros(CLASSES)])
        mass = np.concatenate([np.zeros(len(m.head)), np.log10(m.class_mass)])
        for batch in batches:
            for row in _rows(batch):
                symbols, lengths, bounds = _documents(row, m)
                n = len(lengths)
                scores = np.zeros(n)
                for some in _passes(lengths + 1):
                    found = [np.append(symbols[bounds[i] : bounds[i + 1]], m.end) for i in some.tolist()]
                    scores[some] = forward(m, found) / math.log(10)
                doc = np.repeat(np.arange(n), lengths)
                rare = symbols >= len(m.head)
                sums = lambda x: np.bincount(doc, x, n)
                tokens = np.frombuffer(row["tokens"], "<u4")
                yield pa.record_batch(
                    [
                        pa.array([row["block"]], pa.int64()), pa.array([row["doc_ids"]], pa.list_(pa.int64())),
                        pa.array([row["held"].astype(bool)], pa.list_(pa.bool_())),
                        *(pa.array([v.astype(k).tobytes()], pa.binary()) for v, k in (
                            (lengths, "<i4"), (sums(~rare), "<i4"), (sums(logs_of[symbols]), "<f8"),
                            (scores - sums(mass[symbols]), "<f8"), (tokens[rare], "<u4"), (sums(rare), "<i4"),
                        )),
                    ],
                    names=names,
                )

    local_schema = "block long, doc_ids array<long>, held array<boolean>, lengths binary, known binary, logs binary, scores binary, rare binary, rare_lengths binary"
    scored = table.select("block", "doc_ids", "held", "lengths", "tokens", "hashes", "classes").mapInArrow(local, local_schema)

    entries = table.select("block", F.posexplode("hashes").alias("place", "hash"))
    in_head = F.broadcast(spark.createDataFrame(pa.table({"hash": pa.array(model.head, pa.int64())})))  # at most HEAD rows
    looked_up = entries.join(in_head, "hash", "left_anti").join(counts.where("not in_head").select("hash", "c"), "hash")
    dictionary = looked_up.groupBy("block").agg(F.collect_list("place").alias("places"), F.collect_list("c").alias("c"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        share = math.log10(m.tokens + 0.5 * (m.kinds + 1))
        for batch in batches:
            for row in _rows(batch):
                read = lambda c, k: np.frombuffer(row[c], k)
                lengths, known, logs, scores = read("lengths", "<i4"), read("known", "<i4"), read("logs", "<f8"), read("scores", "<f8")
                rare, n = read("rare", "<u4"), len(lengths)
                of = np.zeros(int(rare.max(initial=0)) + 1)
                if row["places"] is not None and len(row["places"]) and len(rare):
                    of = np.zeros(max(len(of), int(row["places"].max()) + 1))
                    of[row["places"]] = row["c"]
                doc = np.repeat(np.arange(n), read("rare_lengths", "<i4"))
                c = of[rare]
                extra = np.bincount(doc, np.log10(c + 0.5), n)
                known = known + np.bincount(doc, c > 0, n).astype(np.int64) + (m.ends > 0)
                total = lengths + 1
                base = logs + extra + math.log10(m.ends + 0.5) - total * share
                yield pa.record_batch(
                    [
                        pa.array(row["doc_ids"], pa.int64()), pa.array(row["held"].astype(bool)), pa.array(total, pa.int64()),
                        pa.array(known, pa.int64()), pa.array(np.full(n, m.tokens), pa.int64()), pa.array(base), pa.array(scores + extra),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return scored.join(dictionary, "block", "left").mapInArrow(whole, schema)


def score_documents(spark: SparkSession, docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fit on the rows that are not ``held_out`` and score every row; see ``score`` for the columns.

    A null text is an empty one (its end alone); a null ``held_out`` counts as false. Repeated rows are separate documents,
    null ids come back as they are. An empty table gives no rows; without training rows every word is unseen.
    """
    prepare(spark)
    table = blocks(spark, docs, held_out, id_col, text_col)
    counts, model = vocabulary(spark, table)
    model, _ = fit(spark, table, model)
    return score(spark, table, counts, model)
