"""Driver tables, and the landed and processed data sets that queries start from.

A data set is written once per application and source folder below the shared folder, then read
by every query that needs it. That is the job's own shape: land, transform, analyse. The written
tables are columnar, so an analysis reads two columns instead of repeating the transform.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..operators import dedup, profile
from ..plans import transform
from ..schema import SEARCH_FIELDS, SEARCH_PAGE_SIZE, q
from ..session import delete, exists, free_shuffles, fresh_dir, keep_compiled
from ..sources import documents, landing
from . import bindings

TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem", "events")

CONFIG = EngineConfig()

#: Landed JSON is packed; a packed file is read by one task, so it holds a bounded number of records.
PACKED = {"compression": "gzip", "maxRecordsPerFile": 100_000}
#: Records of a search page file, which are up to a page size of rows each.
PACKED_PAGES = PACKED | {"maxRecordsPerFile": 1_000}

_staged: dict[tuple[str, str, str], str] = {}
_lock = threading.RLock()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, sql: str, **frames: DataFrame) -> DataFrame:
    """Run a binding over the driver tables (and the given frames)."""
    named = {t: table(spark, sf_dir, t) for t in TABLES if t in sql} | frames
    text = sql
    for t in sorted(named, key=len, reverse=True):
        text = _as_parameter(text, t)
    return spark.sql(text, **named)


def _as_parameter(sql: str, name: str) -> str:
    out = sql
    for word in ("FROM ", "JOIN ", "JOIN ("):
        out = out.replace(f"{word}{name} ", f"{word}{{{name}}} ").replace(f"{word}{name}\n", f"{word}{{{name}}}\n")
    return out


def staged(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], object]) -> str:
    """Path of a data set, written on first use within this application."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    keep_compiled(spark)
    with _lock:
        if not is_staged(spark, sf_dir, name):
            path = fresh_dir(spark, name)
            write(path)
            free_shuffles(spark)
            _staged[key] = path
        return _staged[key]


def is_staged(spark: SparkSession, sf_dir: str, name: str) -> bool:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    return key in _staged and exists(spark, _staged[key])


def staged_path(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[SparkSession, str], DataFrame]
) -> str:
    """Path of a data set that ``build`` writes when asked for it."""
    build(spark, sf_dir)
    return _staged[spark.sparkContext.applicationId, sf_dir.rstrip("/"), name]


def awards_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed all-text award rows."""
    path = staged(
        spark, sf_dir, "awards_raw",
        lambda p: view(spark, sf_dir, bindings.AWARDS_RAW_BY_ORDER).write.option("compression", "zstd").parquet(p),
    )
    return spark.read.parquet(path)


def awards_raw_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows for a query that passes over some of their columns once.

    They are read where they are stored already. Storing all columns for such a query alone would cost several times the query,
    so otherwise they come from the driver tables, with no more columns and rows than it asks for.
    """
    if is_staged(spark, sf_dir, "awards_raw"):
        return awards_raw(spark, sf_dir)
    keep_compiled(spark)
    return view(spark, sf_dir, bindings.AWARDS_RAW_BY_ORDER)


@contextmanager
def awards_raw_passing(spark: SparkSession, sf_dir: str) -> Iterator[DataFrame]:
    """The same rows for a step that builds a landing of them: if nothing else has stored them, they are gone once it is built."""
    had = is_staged(spark, sf_dir, "awards_raw")
    yield awards_raw(spark, sf_dir)
    if not had:
        with _lock:
            delete(spark, _staged.pop((spark.sparkContext.applicationId, sf_dir.rstrip("/"), "awards_raw")))


def awards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed award table: conformed, typed, deduplicated."""

    def write(path: str) -> None:
        transform.awards_of_stored(awards_raw(spark, sf_dir), CONFIG).write.option("compression", "zstd").parquet(path)

    return spark.read.parquet(staged(spark, sf_dir, "awards", write))


def awards_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, bindings.AWARDS_SEARCH, awards_raw=awards_raw(spark, sf_dir))


def awards_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staged(
        spark, sf_dir, "awards_predicate",
        lambda p: view(spark, sf_dir, bindings.AWARDS_PREDICATE).write.option("compression", "zstd").parquet(p),
    )
    return spark.read.parquet(path)


def search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed search-result pages (JSON), at most one page size of rows in each."""

    def write(path: str) -> None:
        rows = awards_search(spark, sf_dir).select(*[q(f) for f in SEARCH_FIELDS])
        # Consecutive rows of one task share a page, so no page exceeds the page size.
        line = F.monotonically_increasing_id()
        pages = rows.withColumn("page", F.floor(line / SEARCH_PAGE_SIZE)).groupBy("page").agg(
            F.collect_list(F.struct(*[q(f) for f in SEARCH_FIELDS])).alias("results")
        )
        pages.select(
            "results",
            F.struct((F.size("results") == SEARCH_PAGE_SIZE).alias("hasNext")).alias("page_metadata"),
        ).write.options(**PACKED_PAGES).json(path)

    return documents.read_search_pages(spark, staged(spark, sf_dir, "search_pages", write))


def _iso(col) -> F.Column:
    return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def run_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run ledger as landed JSON; four steps per run, built per row."""

    def write(path: str) -> None:
        runs = view(spark, sf_dir, bindings.RUNS_RAW)
        broken_at = F.when(F.col("status") == "FAILED", F.col("event_id") % 4 + 1)
        steps = []
        for i, name in enumerate(bindings.STEP_NAMES, start=1):
            state = (
                F.when(broken_at.isNull() | (F.lit(i) < broken_at), "SUCCESS")
                .when(F.lit(i) == broken_at, "FAILED")
                .otherwise("SKIPPED")
            )
            steps += [
                F.lit(name),
                F.struct(
                    state.alias("status"), _iso(F.col("start_ts")).alias("timestamp"), F.lit("{}").alias("details")
                ),
            ]
        numbers = F.filter(F.sequence(F.lit(1), F.lit(4)), lambda k: k <= F.col("n_errors"))
        errors = F.transform(
            numbers,
            lambda k: F.concat(
                F.lit("Data processing error "), k.cast("string"), F.lit(" of "), F.col("run_id"),
                F.lit(": the step did not finish, see the log of the run for the stack trace and all details"),
            ),
        )
        stem = F.concat(F.lit("results/2024/"), F.col("run_id"))
        files = F.when(
            F.col("n_output_files") > 0,
            F.array(F.concat(stem, F.lit("/awards.parquet")), F.concat(stem, F.lit("/report.txt"))),
        ).otherwise(F.array().cast("array<string>"))
        runs.select(
            "run_id",
            _iso(F.col("start_ts")).alias("start_time"),
            _iso(F.col("end_ts")).alias("end_time"),
            "status",
            F.create_map(*steps).alias("steps"),
            errors.alias("errors"),
            files.alias("output_files"),
        ).write.options(**PACKED).json(path)

    return documents.good(documents.read_runs(spark, staged(spark, sf_dir, "run_ledger", write)))


def quality_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality reports as landed JSON, one per event, each with a few issues and columns."""

    def write(path: str) -> None:
        ev = table(spark, sf_dir, "events")
        issues = F.transform(
            F.sequence(F.lit(1), (F.col("event_id") % 7 + 1).cast("int")),
            lambda k: F.struct(
                F.when((F.col("event_id") + k) % 3 == 0, "ERROR")
                .when((F.col("event_id") + k) % 3 == 1, "WARNING")
                .otherwise("INFO")
                .alias("severity"),
                F.concat(
                    F.lit("issue "), k.cast("string"), F.lit(" of report "), F.col("event_id").cast("string"),
                    F.lit(" found while loading a landed file of kind "), F.col("event_type"),
                ).alias("message"),
                _iso(F.col("ts")).alias("timestamp"),
                F.when(k % 2 == 0, (F.col("user_id") % 50 + k).cast("string")).alias("count"),
            ),
        )
        nulls = F.create_map(
            F.lit("PIID"), F.col("event_id") % 11,
            F.lit("AAC"), F.lit(0).cast("bigint"),
            F.lit("Fiscal Year"), F.col("event_id") % 13,
            F.lit("Date Signed"), F.col("event_id") % 17,
            F.lit("Dollars Obligated"), F.col("event_id") % 19,
            F.lit("Instrument Type"), F.col("event_id") % 23,
            F.lit("Last Date to Order"), F.col("user_id") + 100,
        )
        ev.select(
            _iso(F.col("ts")).alias("processing_timestamp"),
            issues.alias("data_quality_issues"),
            F.struct(
                (F.col("user_id") + 100).alias("total_rows"), F.lit(7).alias("total_columns"), nulls.alias("null_counts")
            ).alias("summary_statistics"),
        ).write.options(**PACKED).json(path)

    return documents.good(
        documents.read_quality_reports(spark, staged(spark, sf_dir, "quality_reports", write))
    )
