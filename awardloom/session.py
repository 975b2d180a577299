"""Shared-folder lookup for tables that one job writes and later jobs read."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_scope = threading.local()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a scratch folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="awardloom-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """New, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back, so that later steps neither repeat nor depend on its tasks."""
    path = fresh_dir(df.sparkSession, label)
    if getattr(_scope, "tables", None) is not None:
        _scope.tables.append((label, path))
    df.write.option("compression", "zstd").parquet(path)
    free_shuffles(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)  # given, so that no job looks it up


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[Callable[..., None]]:
    """Tables that ``stored`` writes meanwhile in this thread are deleted at the end, or as soon as the function given is called
    with their labels; no frame that reads them may leave."""
    outer, mine = getattr(_scope, "tables", None), []
    _scope.tables = mine

    def drop(*labels: str) -> None:
        for table in [t for t in mine if t[0] in labels]:
            mine.remove(table)
            delete(spark, table[1])

    try:
        yield drop
    finally:
        _scope.tables = outer
        drop(*{label for label, _ in mine})


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def free_shuffles(spark: SparkSession) -> None:
    """Have the files of finished shuffles deleted: Spark does so when the driver's garbage collector finds their plans gone, which a
    driver with memory to spare may not do for half an hour. Called after every table written."""
    spark.sql("VALUES (1)").collect()  # no job; the listeners' last event would keep the last plan
    spark.sparkContext._jvm.System.gc()


#: Bytes of bytecode beyond which Java never compiles a method but interprets it.
COMPILED_METHOD = 8000


def keep_compiled(spark: SparkSession) -> None:
    """Stages whose generated code is one method too large to be compiled run operator by operator, which are compiled.

    A projection of all award columns is that large, and takes three times as long interpreted. The setting stays, as frames
    run later; one that the session has already is left.
    """
    key = "spark.sql.codegen.hugeMethodLimit"
    if not spark.conf.get(key, None):
        spark.conf.set(key, str(COMPILED_METHOD))


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one small file through Hadoop's file system."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    out.write(text.encode())
    out.close()
