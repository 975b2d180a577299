"""Landed award files: listing, header probe, scans, inventory.

Spark's CSV reader applies one header to every file of a read, by position. Landed files may order their columns
differently, so the scan reads records as text, whatever their files' headers, and takes each cell from the place that
the header of its own file gives it. The headers are a small table, a row a file.
"""

from __future__ import annotations

import csv
import io
import logging
import re
import sys
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import null_if_token
from ..operators.dedup import union_all
from ..schema import q
from ..session import keep_compiled, stored
from . import records

log = logging.getLogger(__name__)

# Tasks receive the probe by value: executors need pandas and pyarrow, but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEPARATORS = {"csv": ",", "tsv": "\t"}
FORMATS = ("csv", "parquet")
#: Endings of packed text, which Spark and Arrow unpack by the name.
PACKINGS = ("gz", "bz2")

# Opening a file is quick, so one task probes many; a handful of files needs no second worker.
FILES_PER_TASK = 64

FILE_SCHEMA = "path string, format string, size bigint"
PROBE_SCHEMA = FILE_SCHEMA + ", readable boolean, error string, columns array<string>, types array<string>"

SOURCE_FILE = "source_file"
# A file with a row longer than its header is refused, as a whole.
RAGGED = "expected %s fields, saw %s"
ROW_ORDER = "row_order"


def _suffix(path: str) -> str:
    """The suffix in small letters, of packed text that below the packing's."""
    *rest, last = path.rsplit("/", 1)[-1].lower().rsplit(".", 2)
    return rest[-1] if last in PACKINGS and len(rest) == 2 and rest[-1] in SEPARATORS else last


def format_of(path: str) -> str:
    """Format by file suffix; anything else is refused."""
    suffix = _suffix(path)
    if suffix not in (*SEPARATORS, "parquet"):
        raise ValueError(f"unsupported file format: {path}")
    return suffix


def one_form(path: Column) -> Column:
    """A path as the listing writes it: decoded, with one slash after ``file:``."""
    # Per row in a scan, so only names with a code are decoded.
    short = F.when(F.startswith(path, F.lit("file:/")), F.concat(F.lit("file:/"), F.ltrim(F.substring(path, 7, 1 << 30), F.lit("/")))).otherwise(path)
    return F.when(F.contains(path, F.lit("%")), F.url_decode(F.replace(short, F.lit("+"), F.lit("%2B")))).otherwise(short)


def file_path() -> Column:
    """Path of the file a scanned row comes from; Spark reports it percent-encoded."""
    return one_form(F.col("_metadata.file_path"))


def list_files(spark: SparkSession, root: str, formats: Sequence[str] = FORMATS) -> DataFrame:
    """Files below ``root`` (path, format, size) from the file system's own recursive listing.

    A scan would not do: Spark skips empty files. The driver holds the path and size of every file.
    """
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(root)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    base = re.sub("^file:/+", "file:/", fs.makeQualified(top).toString()).rstrip("/") + "/"
    found, it = [], fs.listFiles(top, True)
    while it.hasNext():
        status = it.next()
        path = re.sub("^file:/+", "file:/", status.getPath().toString())
        parts = path[len(base):].split("/")
        suffix = _suffix(path)
        if suffix in formats and not any(p.startswith(("_", ".")) for p in parts):
            found.append((path, suffix, status.getLen()))
    listed = spark.createDataFrame(sorted(found, key=lambda r: (formats.index(r[1]), r[0])), FILE_SCHEMA)
    return listed.coalesce(1 + len(found) // FILES_PER_TASK)


# Schemes that Spark and the Arrow file systems name differently.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def _open(path: str):
    from pyarrow import fs as pafs

    scheme, _, rest = path.partition(":")
    if scheme == "file" or not rest:
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/") if rest else path
    return pafs.FileSystem.from_uri(f"{ARROW_SCHEMES.get(scheme, scheme)}:{rest}")


def _read_layout(filesystem, inner: str, fmt: str) -> tuple[list[str], list[str]]:
    """Column names (and stored types) from the head or footer of one file."""
    if fmt == "parquet":
        import pyarrow.parquet as pq

        with filesystem.open_input_file(inner) as f:
            stored = pq.ParquetFile(f).schema_arrow
        return list(stored.names), [str(t) for t in stored.types]
    with filesystem.open_input_stream(inner) as f:
        text = io.TextIOWrapper(f, encoding="utf-8-sig", newline="")
        header = next(csv.reader(text, delimiter=SEPARATORS[fmt]), None)
    if not header:
        raise ValueError("no header line")
    return header, ["string"] * len(header)


def _probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for path, fmt, size in zip(batch["path"], batch["format"], batch["size"]):
            place = _open(path)  # an unknown file system is a set-up error and fails the run
            try:
                if size == 0:
                    raise ValueError("file is empty")
                columns, types = _read_layout(*place, fmt)
                rows.append((path, fmt, size, True, None, columns, types))
            except Exception as e:  # any unreadable file is an issue row, never a failed run
                rows.append((path, fmt, size, False, str(e), [], []))
        yield pd.DataFrame(
            rows, columns=["path", "format", "size", "readable", "error", "columns", "types"]
        )


def probe_files(files: DataFrame) -> DataFrame:
    """Open the head or footer of each listed file, in parallel tasks."""
    return files.mapInPandas(_probe, PROBE_SCHEMA)


def load_issues(probed: DataFrame) -> DataFrame:
    """ERROR rows for the files that cannot be read."""
    name = F.substring_index("path", "/", -1)
    return probed.filter(~F.col("readable")).select(
        F.col("path").alias(SOURCE_FILE),
        F.lit(-1).alias("ord"),
        F.lit("ERROR").alias("severity"),
        F.lit("load").alias("rule"),
        F.format_string("Failed to load file %s: %s", name, "error").alias("message"),
        F.lit(None).cast("bigint").alias("issue_count"),
    )


#: Files whose names and column places are sent to every task; the driver has listed them already. More are joined as Spark sees fit.
SENT_FILES = 100_000
# No text has this noncharacter, so a line is one cell.
LINE_SEPARATOR = "\uffff"


def _cell_options(sep: str) -> dict[str, str]:
    return {"sep": sep, "quote": '"', "escape": '"', "nullValue": "\0", "emptyValue": ""}


def _separators(text: Column, sep: str) -> Column:
    """How often the separator, a byte long, is in the text, quoted or not."""
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(sep), F.lit("")))


def _odd_files(spark: SparkSession, widths: DataFrame, paths: Sequence[str], sep: str) -> tuple[set[str], dict[str, tuple[int, int]]]:
    """One splittable pass over the text of all files, whatever their headers: files with a quoted field that
    spans lines, and files with a row of more cells than their header has (``widths``: path, fields), with both numbers.

    Only such files reach the driver.
    """
    value, bare, quote = F.col("value"), F.col("bare"), F.lit('"')
    # A step of its own, so that it is computed once a line. Quotes pair off unless a line ends or starts in a field.
    outside = F.when(F.contains(value, quote), F.regexp_replace(value, '"[^"]*"', "")).otherwise(value)
    lines = spark.read.text(records.quoted_paths(paths)).select(F.col("_metadata.file_path").alias("path"), "value", outside.alias("bare"))
    odd = (
        lines.groupBy("path")
        .agg(F.max(records.ends_open(value, sep)).alias("broken"), F.max(F.when(~F.contains(bare, quote), _separators(bare, sep) + 1)).alias("cells"))
        .withColumn("path", one_form(F.col("path")))
        .join(widths, "path")
        .filter(F.col("broken") | (F.col("cells") > F.col("fields")))
        .collect()
    )
    broken = {r.path for r in odd if r.broken}
    return broken, {r.path: (r.fields, r.cells) for r in odd if not r.broken and r.cells > r.fields}


def _row_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """path, block, line, value: the lines below the headers, of files with a record a line. Blank lines are left out."""
    return (
        spark.read.schema("value string")
        .options(header=True, enforceSchema=True, sep=LINE_SEPARATOR, quote="", escape="", nullValue="\0", emptyValue="")
        .csv(records.quoted_paths(paths))
        .select(file_path().alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"), "value")
    )


def _text_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """path, block, line, value: all lines in the order of the file."""
    return spark.read.text(records.quoted_paths(paths)).select(
        file_path().alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"), "value"
    )


@contextmanager
def _same_splits(spark: SparkSession) -> Iterator[None]:
    """Reads of the same files get the same splits meanwhile, even if executors come or go."""
    key = "spark.sql.files.minPartitionNum"
    if spark.conf.get(key, None):
        yield
        return
    spark.conf.set(key, str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.unset(key)


def _broken_records(spark: SparkSession, paths: Sequence[str], sep: str) -> DataFrame:
    """path, block, line, value: the records below the headers of files with line breaks in fields, written to a table.

    Such files keep their splits; only one with a field as large as a split is read by one task.
    """
    with _same_splits(spark):
        starts = stored(records.split_starts(_text_lines(spark, paths), sep), "split-starts")
        unsplit = [r.path for r in starts.where("whole").select("path").distinct().collect()]
        lines = _text_lines(spark, paths)
        if unsplit:
            alone = spark.createDataFrame([(p,) for p in unsplit], "path string")
            lines = lines.join(F.broadcast(alone), "path", "left_anti")
        rows = records.read_records(lines, starts.where("not whole"), sep)
        return stored(rows.unionByName(_unsplit(spark, unsplit, sep)) if unsplit else rows, "records")


def _unsplit(spark: SparkSession, paths: Sequence[str], sep: str) -> DataFrame:
    """The records of files that are read by one task each: a record is its cells, quoted anew."""

    def again(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        csv.field_size_limit(sys.maxsize)
        for batch in batches:
            for path in batch["path"]:
                place = _open(path)
                with place[0].open_input_stream(place[1]) as f:
                    found = csv.reader(io.TextIOWrapper(f, encoding="utf-8-sig", newline=""), delimiter=sep)
                    rows, line = [], -1
                    for line, cells in enumerate(r for r in found if r):
                        if line:
                            text = sep.join('"' + c.replace("\r\n", "\n").replace('"', '""') + '"' if c else "" for c in cells)
                            rows.append((path, 0, line, text))
                        if len(rows) == 1000:
                            yield pd.DataFrame(rows, columns=["path", "block", "line", "value"])
                            rows = []
                    if rows:
                        yield pd.DataFrame(rows, columns=["path", "block", "line", "value"])

    files = spark.createDataFrame([(p,) for p in paths], "path string").repartition(len(paths))
    return files.mapInPandas(again, records.RECORDS)


def _parsed(rows: DataFrame, schema: str, options: dict[str, str], *keep: str) -> DataFrame:
    """Each record's cells, by ``from_csv``, as the struct c, beside the columns to keep."""
    # Depends on a fresh id, so that no filter on a cell is moved below and parses the record once more.
    value = F.when(F.monotonically_increasing_id() >= 0, F.col("value"))
    return rows.select(*keep, F.from_csv(value, F.lit(schema), options).alias("c"))


def _cells(rows: DataFrame, width: int, sep: str) -> DataFrame:
    """path, block, line and the array of ``width`` cells of each record."""
    names = [f"c{i}" for i in range(width)]
    parsed = _parsed(rows, ", ".join(f"{n} string" for n in names), _cell_options(sep), "path", "block", "line")
    return parsed.select("path", "block", "line", F.array(*[F.col("c")[n] for n in names]).alias("cells"))


def read_delimited(rows: DataFrame, files: DataFrame, sent: bool, names: Sequence[str], width: int, sep: str) -> DataFrame:
    """All-text cells of the records (path, block, line, value) of delimited files of any headers; null spellings become null.

    ``files`` (path, columns) has every file's header, of up to ``width`` columns, and goes to every task if ``sent``; ``names``
    are the columns wanted. Cells are taken by the name that the file's own header gives their place, so names with dots,
    repeated names (the first one wins) and names differing only in case do no harm; a column that a file lacks is null.
    ``source_file`` and ``row_order`` keep where each row came from.
    """
    place = lambda n: (F.nullif(F.array_position("columns", F.lit(n)), F.lit(0).cast("bigint")) - 1).cast("int")
    places = files.select("path", (F.array(*[place(n) for n in names]) if names else F.array().cast("array<int>")).alias("places"))
    rows = _cells(rows, width, sep).join(F.broadcast(places) if sent else places, "path")
    return rows.select(
        *[null_if_token(F.get("cells", F.col("places")[i])).alias(n) for i, n in enumerate(names)],
        F.col("path").alias(SOURCE_FILE),
        # Inside one file block the generated id grows with the line, so this is file order.
        F.struct(F.col("path").alias("file"), "block", "line").alias(ROW_ORDER),
    )


def read_columnar(spark: SparkSession, paths: str | Sequence[str], names: Sequence[str] | None = None, merge: bool = False) -> DataFrame:
    """Parquet scan with source file and row order; with ``merge`` the files may lack columns of one another.

    Files without a valid footer were set aside by the probe. Damage further inside fails the job:
    skipping it would lose rows without a trace.
    """
    rows = spark.read.option("mergeSchema", merge).parquet(*([paths] if isinstance(paths, str) else records.quoted_paths(paths)))
    return rows.select(
        *[q(c) for c in rows.columns if names is None or c in names],
        file_path().alias(SOURCE_FILE),
        F.struct(
            file_path().alias("file"),
            F.lit(0).cast("bigint").alias("block"),
            F.col("_metadata.row_index").alias("line"),
        ).alias(ROW_ORDER),
    )


@dataclass(frozen=True)
class Landing:
    """A frame for all text files of a separator and for each set of Parquet files of like types, and the probe of every file."""

    groups: list[DataFrame]
    files: DataFrame

    @property
    def issues(self) -> DataFrame:
        return load_issues(self.files)


def scan_landing(
    spark: SparkSession,
    root: str,
    formats: Sequence[str] = FORMATS,
    multi_line: bool | str = "auto",
    columns: Sequence[str] | None = None,
) -> Landing:
    """Read every landed file below ``root``; see ``scan_files``."""
    return scan_files(spark, list_files(spark, root, formats), formats, multi_line, columns)


def _like_types(layouts: dict[tuple, list[str]]) -> list[tuple[list[str], bool]]:
    """Paths of Parquet layouts in sets within which every column has one type and one spelling; whether a set has several layouts."""
    sets: list[list] = []
    for (columns, types), paths in layouts.items():
        kinds = {c.lower(): (c, t) for c, t in zip(columns, types)}
        for some in sets:
            if all(some[0].get(k, v) == v for k, v in kinds.items()):
                some[0].update(kinds)
                some[1] += paths
                some[2] = True
                break
        else:
            sets.append([kinds, list(paths), False])
    return [(sorted(members), several) for _, members, several in sets]


def scan_files(
    spark: SparkSession, files: DataFrame, formats: Sequence[str] = FORMATS, multi_line: bool | str = "auto",
    columns: Sequence[str] | None = None,
) -> Landing:
    """Read listed files (path, format, size): one scan for all text files of a separator, whatever their headers.

    Quoted fields may hold line breaks. With ``multi_line="auto"`` one splittable pass over the text finds the files that
    have any, and those are read by way of ``records``; False where the landing is known to be free of line breaks
    spares the pass, True takes every file that way. A file with a row longer than its header is refused whole and listed as
    unreadable, also one that has none of the columns wanted. ``columns`` names those, all by default; files that have none of them
    give no rows.
    """
    keep_compiled(spark)
    probed = stored(probe_files(files), "probe")
    layouts: dict[tuple, list[str]] = {}
    for r in probed.filter("readable").groupBy("format", "columns", "types").agg(F.collect_list("path").alias("paths")).collect():
        layouts[r.format, tuple(r.columns), tuple(r.types)] = sorted(r.paths)
    layouts = dict(sorted(layouts.items(), key=lambda x: (formats.index(x[0][0]), x[0][1])))
    has_wanted = lambda header: columns is None or not set(columns).isdisjoint(header)

    groups, refused = [], []
    for fmt in formats:
        here = {k[1:]: v for k, v in layouts.items() if k[0] == fmt}
        if fmt == "parquet":
            here = {k: v for k, v in here.items() if has_wanted(k[0])}
            groups += [read_columnar(spark, paths, columns, several) for paths, several in _like_types(here)]
            continue
        if not here:
            continue
        sep = SEPARATORS[fmt]
        paths = sorted(p for some in here.values() for p in some)
        wanted = {p for (header, _), some in here.items() if has_wanted(header) for p in some}
        names = list(dict.fromkeys(n for header, _ in here for n in header if columns is None or n in columns))
        width = max(len(header) for header, _ in here) + 1
        widths = probed.select("path", F.size("columns").alias("fields"))
        broken, longest, rows = set(paths) if multi_line is True else set(), {}, None
        if multi_line == "auto":
            broken, longest = _odd_files(spark, widths, paths, sep)
        if broken:  # their cells show only in a full parse, of records with as many separators
            rows = _broken_records(spark, sorted(broken), sep)
            full = rows.join(widths, "path").filter(_separators(F.col("value"), sep) >= F.col("fields")).drop("fields")
            cells = _cells(full, width, sep).join(widths, "path")
            surplus = cells.filter(F.get("cells", F.col("fields")).isNotNull()).groupBy("path").agg(F.max("fields").alias("fields")).collect()
            longest |= {r.path: (r.fields, r.fields + 1) for r in surplus}
        refused += [(p, RAGGED % pair) for p, pair in longest.items()]
        kept = [p for p in paths if p in wanted and p not in longest]
        whole = [p for p in kept if p not in broken]
        if whole:
            rows = _row_lines(spark, whole) if rows is None else _row_lines(spark, whole).unionByName(rows)
        if kept:
            files = probed if columns is None else probed.filter(F.arrays_overlap("columns", F.array(*[F.lit(c) for c in columns])))
            if longest:
                files = files.join(F.broadcast(spark.createDataFrame([(p,) for p in longest], "path string")), "path", "left_anti")
            groups.append(read_delimited(rows, files, len(paths) <= SENT_FILES, names, width, sep))
    if refused:
        why = spark.createDataFrame(refused, "path string, ragged string")
        rest = [c for c in probed.columns if c not in ("readable", "error")]
        probed = probed.join(F.broadcast(why), "path", "left").select(  # one row a refused file
            *rest, (F.col("readable") & F.col("ragged").isNull()).alias("readable"), F.coalesce("ragged", "error").alias("error")
        )
    return Landing(groups, probed)


def inventory(landing: Landing) -> DataFrame:
    """Each landed file: size, whether empty or readable, its columns and its row count."""
    counts = None
    for g in landing.groups:
        part = g.groupBy(SOURCE_FILE).agg(F.count("*").alias("row_count"))
        counts = part if counts is None else counts.unionByName(part)
    files = landing.files.select(
        "path",
        "format",
        "size",
        (F.col("size") == 0).alias("is_empty"),
        "readable",
        "error",
        F.size("columns").alias("column_count"),
        "columns",
    )
    if counts is None:
        return files.withColumn("row_count", F.lit(None).cast("bigint"))
    joined = files.join(counts, F.col("path") == F.col(SOURCE_FILE), "left").drop(SOURCE_FILE)
    return joined.withColumn(
        "row_count", F.when(F.col("readable"), F.coalesce("row_count", F.lit(0)))
    )


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """Processed award table for analysis: Parquet, or CSV under the declared types.

    Part files with line breaks in a field keep their splits, as in a landing.
    """
    from ..schema import AWARD_SCHEMA

    fmt = format_of(path)
    if fmt == "parquet":
        return spark.read.parquet(path)
    sep = SEPARATORS[fmt]
    parts = [r.path for r in list_files(spark, path, (fmt,)).select("path").collect()]
    if not parts:
        return spark.createDataFrame([], AWARD_SCHEMA)
    widths = spark.createDataFrame([(p, len(AWARD_SCHEMA)) for p in parts], "path string, fields int")
    broken, _ = _odd_files(spark, widths, parts, sep)
    options = {"sep": sep, "quote": '"', "escape": '"'}
    split = [p for p in parts if p not in broken]
    frames = [spark.read.schema(AWARD_SCHEMA).options(header=True, enforceSchema=False, **options).csv(records.quoted_paths(split))] if split else []
    if broken:
        frames.append(_parsed(_broken_records(spark, sorted(broken), sep), AWARD_SCHEMA.toDDL(), options).select("c.*"))
    return union_all(frames)
