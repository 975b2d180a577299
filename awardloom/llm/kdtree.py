"""Exact top-k inner products by KD-trees, one per shard of the vectors.

A shard's vectors are split at the median of the coordinate that spreads most, down to leaves; every node
keeps the tight box of its vectors. The largest inner product a query can have in a box is the sum, by
coordinate, of the larger of its products with the two bounds. A search visits boxes best bound first and
ends when the next bound is below the query's kth score. Blocks of queries first search one shard each;
the kth scores found there are passed to the search of all other shards, which then skips most boxes.

Queries travel to the trees in blocks of bounded size, and each (block, shard) is a row of its own, so
a task holds one tree and one block. Vectors are dealt to shards by a hash of their row's number, so that rows that share an
id, equal ones too, spread over all shards; queries are dealt to blocks by a hash of id and vector.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import prepare, written

#: Vectors of a shard, of a leaf, and queries of a block.
SHARD, LEAF, BLOCK = 8192, 64, 512
#: Sums of products up to this are exact in 64-bit floating point.
EXACT = 1 << 53


class Tree(NamedTuple):
    """Vectors in leaf order; node i has children 2i + 1 and 2i + 2 unless it is a leaf."""

    ids: np.ndarray
    vectors: np.ndarray
    low: np.ndarray
    high: np.ndarray
    start: np.ndarray
    end: np.ndarray
    leaf: np.ndarray


def build(ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF) -> Tree:
    """Median splits on the widest coordinate until a node has at most ``leaf`` vectors."""
    n, d = vectors.shape
    depth = max(0, int(np.ceil(np.log2(max(n, 1) / leaf))))
    nodes = (1 << depth + 1) - 1
    low, high = np.zeros((nodes, d), vectors.dtype), np.zeros((nodes, d), vectors.dtype)
    start, end = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
    is_leaf = np.arange(nodes) >= nodes // 2
    order = np.lexsort((ids,))
    end[0] = n
    for i in range(nodes):
        a, b = start[i], end[i]
        part = vectors[order[a:b]]
        low[i], high[i] = part.min(axis=0), part.max(axis=0)
        if not is_leaf[i]:
            axis, mid = int(np.argmax(high[i] - low[i])), (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(part[:, axis], mid)]
            start[2 * i + 1], end[2 * i + 1], start[2 * i + 2], end[2 * i + 2] = a, a + mid, a + mid, b
    return Tree(ids[order], vectors[order], low, high, start, end, is_leaf)


def search(tree: Tree, ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """(query id, its up to k (score, vector id)) with scores of at least the query's floor.

    A vector with the query's own id is no candidate. Ties go to the smaller vector id.
    """
    bounds = np.maximum(queries, 0) @ tree.high.T + np.minimum(queries, 0) @ tree.low.T
    for q, (own, floor) in enumerate(zip(ids.tolist(), floors.tolist())):
        bound, best = bounds[q], []  # best: heap of (score, -vector id), the worst on top
        open_boxes = [(-bound[0], 0)]
        while open_boxes:
            negated, node = heapq.heappop(open_boxes)
            kth = best[0][0] if len(best) == k else floor
            if -negated < max(kth, floor):
                break
            if not tree.leaf[node]:
                for child in (2 * node + 1, 2 * node + 2):
                    heapq.heappush(open_boxes, (-bound[child], child))
                continue
            a, b = tree.start[node], tree.end[node]
            scores = tree.vectors[a:b] @ queries[q]
            for j in np.flatnonzero(scores >= max(kth, floor)).tolist():
                name, found = int(tree.ids[a + j]), (int(scores[j]), -int(tree.ids[a + j]))
                if name == own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
        if best:
            yield own, [(s, -v) for s, v in sorted(best, reverse=True)]


def _numbers(rows: list[list], dtype=np.float64) -> np.ndarray:
    return np.array(rows, dtype=dtype)


def _exact(vectors: np.ndarray, other: int) -> np.ndarray:
    """Floating point where all sums of products are exact, else Python's integers."""
    most = int(np.abs(vectors).max(initial=0))
    return vectors if most * max(most, other) * vectors.shape[1] < EXACT else vectors.astype(np.int64).astype(object)


def top_k(
    spark: SparkSession, vectors: DataFrame, k: int, scale: float, is_query, id_col: str = "vec_id", vector_col: str = "embedding",
    shard: int = SHARD, block: int = BLOCK,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query row's k largest inner products with other rows.

    Components are floor(scale * x), x as double. ``is_query`` is a Column over ``id_col``. Vectors that
    are null or empty, or hold a null or non-finite component, take no part; neither do null ids. Vectors
    meet only vectors of their own length. Rows that share an id are all candidates, but not for queries of that
    id; a repeated query id is one query for each distinct vector, ranked together. Ties go to the smaller
    vec_id. Fewer than k candidates give fewer rows; an empty table gives none. Scaled components must fit 64-bit
    integers, scores too.
    """
    prepare(spark)
    value = F.col(vector_col)
    whole = F.transform(value, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    sound = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
    table = (
        vectors.where(F.col(id_col).isNotNull() & value.isNotNull() & (F.size(value) > 0))
        .where(sound)
        .select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v"), is_query.alias("asks"))
        .withColumn("d", F.size("v"))
    )
    table = written(table.withColumn("row", F.monotonically_increasing_id()), "vectors")  # written, so that the numbers stay
    sizes = table.groupBy("d").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("asks").cast("long")).alias("q"))
    sizes = sizes.select("d", F.expr(f"cast(ceil(n / {shard}) as bigint)").alias("shards"), F.expr(f"cast(ceil(q / {block}) as bigint)").alias("blocks"))
    dealt = table.join(F.broadcast(sizes), "d")  # one row a vector length

    def plant(group: pa.Table) -> pa.Table:
        v = _numbers(group.column("v").to_pylist())
        tree = build(group.column("vec_id").to_numpy(), v)
        d, s = group.column("d")[0].as_py(), group.column("shard")[0].as_py()
        return pa.table({"d": pa.array([d], pa.int32()), "shard": pa.array([s], pa.int64()), "tree": pa.array([pickle.dumps(tree)], pa.binary())})

    trees = dealt.select("d", F.expr("pmod(xxhash64(row), shards)").alias("shard"), "vec_id", "v")
    trees = written(trees.groupBy("d", "shard").applyInArrow(plant, "d int, shard long, tree binary"), "trees")

    def bundle(group: pa.Table) -> pa.Table:
        v = _numbers(group.column("v").to_pylist())
        d, b = group.column("d")[0].as_py(), group.column("block")[0].as_py()
        ids = group.column("vec_id").to_numpy()
        floors = group.column("floor").to_numpy() if "floor" in group.column_names else np.full(len(ids), -np.inf)
        return pa.table(
            {"d": pa.array([d], pa.int32()), "block": pa.array([b], pa.int64()), "queries": pa.array([pickle.dumps((ids, v, floors))], pa.binary())}
        )

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, tree = None, None
        for batch in batches:
            for raw_queries, raw_tree in zip(batch.column(0), batch.column(1)):
                ids, v, floors = pickle.loads(raw_queries.as_py())
                raw = raw_tree.as_py()
                if raw != last:
                    last, tree = raw, pickle.loads(raw)
                reach = int(max(np.abs(v).max(initial=0), np.abs(tree.vectors).max(initial=0)))
                if _exact(v, reach).dtype == object:
                    v, trunk = _exact(v, reach), tree._replace(**{f: getattr(tree, f).astype(np.int64).astype(object) for f in ("vectors", "low", "high")})
                else:
                    trunk = tree
                out = [(q, n, s) for q, found in search(trunk, ids, v, floors, k) for s, n in found]
                if out:
                    yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out)], names=["query_id", "vec_id", "score"])

    result = "query_id long, vec_id long, score long"
    queries = dealt.where("asks").dropDuplicates(["vec_id", "v"]).select("d", "shards", F.expr("pmod(xxhash64(vec_id, v), blocks)").alias("block"), "vec_id", "v")
    per_block = "d int, block long, queries binary"

    # First each block searches one shard ...
    home = queries.groupBy("d", "block").applyInArrow(bundle, per_block).join(F.broadcast(sizes), "d")
    home = home.withColumn("shard", F.expr("pmod(block, shards)"))
    first = written(home.join(trees, ["d", "shard"]).select("queries", "tree").mapInArrow(visit, result), "nearest")
    # ... then all others, with the kth scores found (a hair less, as a double may round them up).
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = first.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).where(F.col("rank") == k)
    floor = kth.select(F.col("query_id").alias("vec_id"), (F.col("score") - F.abs("score") * 1e-15).alias("floor"))
    known = queries.join(floor, "vec_id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    away = known.groupBy("d", "block").applyInArrow(bundle, per_block).join(F.broadcast(sizes), "d")
    away = away.withColumn("shard", F.explode(F.expr("sequence(0L, shards - 1)"))).where("shard <> pmod(block, shards)")
    rest = away.join(trees, ["d", "shard"]).select("queries", "tree").mapInArrow(visit, result)

    best = first.unionByName(rest).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
