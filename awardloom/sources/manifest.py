"""Shard table with a commit log: what each pull replaced, empty shards included, and which pulls are done.

    <path>/rows/pull=<name>/award_group=…/shard=…/agency_slug=…   rows, as written by the pull of that name
    <path>/log/<name>                                             a row a planned shard and its rows, 0 included
    <path>/commits/<number>                                       the name of the pull that is commit <number>

A pull counts from the moment that its commit file exists, which is made last and by one writer only. Readers take each
shard from the newest commit that planned it, so a shard that comes back empty is cleared, and a pull that was cut short,
whatever it wrote, leaves no trace. Numbers follow one another; there is one commit a pull.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import q
from . import sinks

LOG = "pull string, rows bigint"


def _fs(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def commits(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, pull) of all committed pulls, oldest first; the driver holds one a pull."""
    fs, folder = _fs(spark, f"{path}/commits")
    if not fs.exists(folder):
        return []
    found = []
    for status in fs.listStatus(folder):
        stream = fs.open(status.getPath())
        name = bytes(stream.readAllBytes()).decode()
        stream.close()
        if name:  # a writer that died between naming the file and filling it has committed nothing
            found.append((int(status.getPath().getName()), name))
    return sorted(found)


def commit(spark: SparkSession, path: str, number: int, pull: str) -> None:
    """Make the pull commit ``number``; fails if another writer was first.

    The name is written beside the log and moved, which either happens or not, and never replaces a file.
    """
    fs, ready = _fs(spark, f"{path}/log/_{pull}")
    out = fs.create(ready, False)
    out.write(pull.encode())
    out.close()
    _, final = _fs(spark, f"{path}/commits/{number:012d}")
    fs.mkdirs(final.getParent())
    if fs.exists(final) or not fs.rename(ready, final):
        raise RuntimeError(f"commit {number} of {path} is taken; pull again")


def write_pull(rows: DataFrame, planned: DataFrame, path: str, keys: Sequence[str]) -> str:
    """Write the rows of a pull and the log of its planned shards (the columns ``keys``), but don't commit; returns its name.

    Rows of shards that were not planned are a mistake in the plan and stop the pull.
    """
    spark, pull = rows.sparkSession, uuid.uuid4().hex
    sinks.write_partitions(rows, f"{path}/rows/pull={pull}", keys)
    # Counted from the rows as given if none was written: an empty write leaves no folder.
    written = read_folder(rows, f"{path}/rows/pull={pull}", keys)
    counts = written.groupBy(*keys).agg(F.count("*").alias("rows"))
    both = planned.select(*keys, F.lit(True).alias("_planned")).distinct().join(counts, list(keys), "full")
    log = both.select(*keys, F.lit(pull).alias("pull"), F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"), F.coalesce("_planned", F.lit(False)).alias("planned"))
    log.write.parquet(f"{path}/log/{pull}")
    stray = spark.read.parquet(f"{path}/log/{pull}").filter("not planned").limit(5).collect()
    if stray:
        raise ValueError(f"rows of shards that were not planned: {[tuple(r)[:len(keys)] for r in stray]}")
    return pull


def read_folder(like: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """Rows of one pull with the columns of ``like``; none if it wrote none. Shard labels stay text."""
    spark = like.sparkSession
    fs, folder = _fs(spark, path)
    kinds = like.select(*[q(c) for c in like.columns if c not in keys], *[F.col(k).cast("string").alias(k) for k in keys]).schema
    if not fs.exists(folder) or not any(s.isDirectory() for s in fs.listStatus(folder)):
        return spark.createDataFrame([], kinds)
    return spark.read.schema(kinds).parquet(path)


def pull_shards(rows: DataFrame, planned: DataFrame, path: str, keys: Sequence[str]) -> str:
    """Replace the planned shards by ``rows``, at once and for all readers."""
    spark = rows.sparkSession
    number = max((n for n, _ in commits(spark, path)), default=0) + 1
    pull = write_pull(rows, planned, path, keys)
    commit(spark, path, number, pull)
    return pull


def current_shards(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """keys, pull, rows of every shard as its newest committed pull left it; shards without rows too."""
    done = commits(spark, path)
    kinds = ", ".join(f"{k} string" for k in keys)
    if not done:
        return spark.createDataFrame([], f"{kinds}, {LOG}")
    log = spark.read.schema(f"{kinds}, {LOG}").parquet(*[f"{path}/log/{name}" for _, name in done])
    order = spark.createDataFrame([(name, n) for n, name in done], "pull string, number bigint")
    newest = log.join(F.broadcast(order), "pull").groupBy(*keys).agg(F.max_by(F.struct("pull", "rows"), "number").alias("x"))  # order: a row a pull
    return newest.select(*keys, "x.pull", "x.rows")


def read_shards(spark: SparkSession, path: str, keys: Sequence[str], schema: str) -> DataFrame:
    """Rows of all shards as the newest committed pulls left them; ``schema`` names the columns beside the keys.

    Folders of pulls that are not committed are not read, and the join on partition columns prunes shards replaced since.
    """
    kinds = ", ".join(f"{k} string" for k in keys)
    live = current_shards(spark, path, keys).filter("rows > 0").select("pull", *keys)
    pulls = [r.pull for r in live.select("pull").distinct().collect()]  # at most one a commit
    if not pulls:
        return spark.createDataFrame([], f"{schema}, {kinds}")
    rows = spark.read.schema(f"{schema}, {kinds}, pull string").option("basePath", f"{path}/rows").parquet(*[f"{path}/rows/pull={p}" for p in pulls])
    return rows.join(live, ["pull", *keys], "left_semi").drop("pull")
