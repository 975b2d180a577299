"""What the operators of this subpackage share: bounded Arrow batches, written tables, file access, words."""

from __future__ import annotations

import os
import posixpath
import tempfile
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_dir

#: Rows and bytes of one Arrow batch handed to Python; the byte bound is what counts for long texts.
BATCH_ROWS = 2000
BATCH_BYTES = 8 << 20
#: Object-store schemes that Spark and Arrow name differently (here again, so that workers need not load the scans).
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}


_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Make the package known to Python tasks, and bound what one of them holds at a time.

    The package goes to the executors as a zip file, once per application; the batch bounds are session
    settings on which no result depends.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        folder = tempfile.mkdtemp(prefix="package-")
        path = os.path.join(folder, "awardloom-package.zip")
        with zipfile.ZipFile(path, "w") as z:
            for top, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        file = os.path.join(top, name)
                        z.write(file, os.path.relpath(file, os.path.dirname(package)))
        context.addPyFile(path)
        _shipped.add(context.applicationId)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


_state: dict = {}


def worker_state(key, build: Callable):
    """What a Python worker keeps from task to task, such as a tokenizer: of one owner, as a new owner drops the last one's."""
    if key not in _state:
        forget()
        _state[key] = build()
    return _state[key]


def forget() -> None:
    """Drop what earlier stages left in this worker; for tasks that keep nothing themselves."""
    if _state:
        _state.clear()
        pa.default_memory_pool().release_unused()


def written(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``fresh_dir`` named and that nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def crc_mod(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def ids_and_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just (doc_id, text); null text becomes empty. Other columns, whatever their names, play no part."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def words(text: str) -> list[bytes]:
    """Lower-cased (A-Z only) words between blanks and the controls 9 to 13, as UTF-8.

    ``bytes.lower`` and ``bytes.split`` act on exactly those characters.
    """
    return text.encode("utf-8", "surrogatepass").lower().split()


def in_batches(fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch] | pa.RecordBatch], keeps: bool = False) -> Callable:
    """Apply ``fn`` to each non-empty Arrow batch; it returns one batch or several. ``keeps``: it uses ``worker_state``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            forget()
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                yield from [out] if isinstance(out, pa.RecordBatch) else out

    return run


def arrow_uri(uri: str) -> str:
    """An address as Arrow names it: its own scheme for object stores, two slashes after ``file:``."""
    scheme, colon, rest = uri.partition(":")
    if scheme == "file" and not rest.startswith("//"):
        rest = "//" + rest
    return ARROW_SCHEMES.get(scheme, scheme) + colon + rest


def filesystem(uri: str):
    """(file system, path) for a path or URI that all executors reach."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(arrow_uri(uri))


class Committed:
    """A binary file that appears under its name only when complete, whichever attempt writes it."""

    def __init__(self, folder: str, name: str):
        self.fs, self.path = filesystem(folder)
        self.final = posixpath.join(self.path, name)
        self.temporary = posixpath.join(self.path, f"_{name}.{uuid.uuid4().hex}")

    def __enter__(self):
        self.fs.create_dir(self.path, recursive=True)
        self.stream = self.fs.open_output_stream(self.temporary)
        return self.stream

    def __exit__(self, kind, *_):
        self.stream.close()
        if kind is None:
            self.fs.move(self.temporary, self.final)
        else:
            self.fs.delete_file(self.temporary)


def crc(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF
