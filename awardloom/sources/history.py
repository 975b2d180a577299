"""Award history as a table bucketed and sorted by award key, into which new pulls are merged bucket by bucket.

The key columns, null or not, are one text (``award_key``), which the table is bucketed by. A pull is dealt to the same
buckets, so the history's rows stay where they are: a merge joins bucket with bucket, without an exchange of the history, and
writes the next version beside the last, which stays readable until then. Several pulls may be merged at once, so that the
history is rewritten as seldom as wanted.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import PLACE, keep_first, keep_first_placed
from ..schema import q, quoted
from ..session import free_shuffles

KEY = "award_key"
PULL = "_pull"
#: Stored bytes of pulls that suit a bucket, which a task sorts whole. Buckets are written in so many ranges at most, each a scan of
#: the pulls, and at least so many at once.
BUCKET_BYTES, RANGES, LEAST_AT_ONCE = 16 << 20, 4, 12


def award_key(keys: Sequence[str]) -> Column:
    """Text that is equal exactly if all key columns are; nulls equal each other."""
    parts = [F.coalesce(F.concat(F.length(q(k).cast("string")).cast("string"), F.lit(":"), q(k).cast("string")), F.lit("-")) for k in keys]
    return F.concat_ws(",", *parts)


def _latest(pulls: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row a key: of the last pull that has it the first in ``order``, with the key's text. Pulls of stored tables that all
    come with the places of their rows stay where they lie."""
    numbered, keep = [p.withColumn(PULL, F.lit(-i)) for i, p in enumerate(pulls)], keep_first
    if all(set(PLACE) <= set(p.columns) for p in pulls):  # a row may be in several pulls
        numbered = [p.withColumn(PLACE[0], F.col(PLACE[0]) * len(pulls) + i) for i, p in enumerate(numbered)]
        keep = keep_first_placed
    rows = reduce(lambda a, b: a.unionByName(b), numbered)
    return keep(rows, keys, [PULL, *order]).drop(PULL).withColumn(KEY, award_key(keys))


def _write(rows: Callable[[range], DataFrame], spark: SparkSession, path: str, buckets: int) -> None:
    """Rows of a range of buckets, that lie in their buckets already, as bucketed and sorted files below ``path``, a range after the
    other: the pulls' rows of one range at a time are on disk for their exchange."""
    name = f"history_{uuid.uuid4().hex}"
    step = max(LEAST_AT_ONCE, -(-buckets // RANGES))
    for start in range(0, buckets, step):
        writer = rows(range(start, min(buckets, start + step))).write.mode("append").option("compression", "zstd")
        writer.bucketBy(buckets, KEY).sortBy(KEY).option("path", path).saveAsTable(name)
        free_shuffles(spark)
    spark.sql(f"DROP TABLE {name}")  # the name only: the files are not the catalog's


def _within(rows: DataFrame, some: range, buckets: int) -> DataFrame:
    """The rows of a range of buckets."""
    return rows if len(some) == buckets else rows.filter(F.pmod(F.hash(KEY), F.lit(buckets)).between(some[0], some[-1]))


def buckets_for(size: int, least: int = 1) -> int:
    """How many buckets suit a history of pulls of so many stored bytes."""
    return max(least, -(-size // BUCKET_BYTES))


def create(pulls: Sequence[DataFrame], path: str, keys: Sequence[str], order: Sequence[str], buckets: int) -> str:
    """The first version of a history, from one or more pulls, the latest last."""
    news = _latest(pulls, keys, order)
    _write(lambda some: _within(news, some, buckets).repartition(buckets, KEY), news.sparkSession, path, buckets)
    return path


def opened(spark: SparkSession, path: str, schema: str, buckets: int) -> DataFrame:
    """The history at ``path``, known to be bucketed; ``schema`` as SQL, the key's text included."""
    name = f"history_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def merged(history: DataFrame, pulls: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str], buckets: int) -> DataFrame:
    """History and pulls with one row a key, that of the latest pull that has it. Only the pulls are dealt anew, once."""
    return _met(history, _latest(pulls, keys, order).repartition(buckets, KEY))


def _met(history: DataFrame, news: DataFrame) -> DataFrame:
    old, new = history.alias("old"), news.withColumn(PULL, F.lit(True)).hint("merge").alias("new")
    # By sorted buckets on both sides, whatever the pull's size, so that the result lies in buckets too.
    met = old.join(new, F.col(f"old.{KEY}") == F.col(f"new.{KEY}"), "full_outer")
    return met.select(*[F.when(F.col(f"new.{PULL}"), F.col(f"new.{quoted(c)}")).otherwise(F.col(f"old.{quoted(c)}")).alias(c) for c in history.columns])


def merge(spark: SparkSession, path: str, schema: str, pulls: Sequence[DataFrame], out: str, keys: Sequence[str], order: Sequence[str], buckets: int) -> str:
    """Write the next version of the history at ``path`` to ``out``."""
    history, news = opened(spark, path, schema, buckets), _latest(pulls, keys, order)
    _write(lambda some: _met(_within(history, some, buckets), _within(news, some, buckets).repartition(buckets, KEY)), spark, out, buckets)
    return out
