"""Writers: processed tables, reports, ledger rows and shard partitions."""

from __future__ import annotations

import json
import logging
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import keep_first, union_all
from ..schema import RUN_SCHEMA, SEARCH_KEYS, q
from ..session import free_shuffles, passing_tables
from . import landing

log = logging.getLogger(__name__)

#: Packed text takes a fifth of the disk or less. A packed file is read by one task, so it holds a bounded number of records.
PACKED_TEXT = {"compression": "gzip", "maxRecordsPerFile": 1_000_000}


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), packed: bool = False) -> str:
    """Write a result table below ``path`` in the chosen format, text packed if wanted."""
    if fmt == "parquet":
        writer = df.write.option("compression", "zstd")
    elif fmt in landing.SEPARATORS:
        # The writer would trim values by default, which is not ours to do.
        writer = df.write.options(
            header=True,
            sep=landing.SEPARATORS[fmt],
            extension=fmt,
            quote='"',
            escape='"',
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )
        if packed:
            writer = writer.options(**PACKED_TEXT)
    else:
        raise ValueError(f"unsupported output format: {fmt}")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format("parquet" if fmt == "parquet" else "csv").save(path)
    free_shuffles(df.sparkSession)
    return path


def write_run_table(
    df: DataFrame, out_dir: str, name: str, run_id: str, fmt: str = "parquet", guard: DataFrame | None = None
) -> str | None:
    """Write ``<out_dir>/<name>_<run_id>.<fmt>``; nothing is written for an empty frame.

    Emptiness is looked up on ``guard`` when given: a frame that is empty exactly when ``df`` is but
    costs no shuffle, so that the check stops at the first row.
    """
    if (df if guard is None else guard).isEmpty():
        log.warning("no data to write for %s", name)
        return None
    return write_table(df, f"{out_dir.rstrip('/')}/{name}_{run_id}.{fmt}", fmt)


def landing_to_parquet(
    spark: SparkSession, root: str, out: str, formats: Sequence[str] = ("csv", "tsv"), **scan_options
) -> str | None:
    """Landed text files to one Parquet table, originals kept; the files that can't be read are listed as
    issues in a table beside it (``<out>_issues``). Without a readable file there is no table.

    Duplicates by search key go per file, as each file is converted on its own; files without any
    of those keys pass through. Rows keep their source file and order for later steps.
    """
    with passing_tables(spark):
        found = landing.scan_landing(spark, root, formats, **scan_options)
        found.issues.write.json(f"{out}_issues")
        if not found.groups:
            log.warning("no readable file below %s", root)
            return None
        rows = union_all(found.groups)
        keys = [k for k in SEARCH_KEYS if k in rows.columns]
        if keys:
            # In a file without any of the keys every row is a key of its own.
            keyed = F.arrays_overlap("columns", F.array(*[F.lit(k) for k in keys]))
            rows = rows.join(found.files.select(F.col("path").alias(landing.SOURCE_FILE), keyed.alias("_keyed")), landing.SOURCE_FILE)
            rows = rows.withColumn("_own", F.when(~F.col("_keyed"), F.col(landing.ROW_ORDER)))
            rows = keep_first(rows, [landing.SOURCE_FILE, "_own", *keys], [landing.ROW_ORDER]).drop("_keyed", "_own")
        return write_table(rows, out)


def write_partitions(df: DataFrame, path: str, keys: Sequence[str]) -> str:
    """Idempotent shard output: only the partitions present in ``df`` are replaced.

    The rebalance hint sizes the output files and splits a partition that is far larger than the
    others over several tasks, instead of sending each key to a single writer.
    """
    (
        df.hint("rebalance", *[q(k) for k in keys])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )
    return path


def write_quality_report(profiles: DataFrame, issues: DataFrame, summary: DataFrame | None, out_dir: str) -> str:
    """Quality report as JSON tables below one folder, the summary if wanted.

    Issues stay rows instead of one nested array, so a landing of very many files is no problem.
    """
    if summary is not None:
        summary.write.json(f"{out_dir}/summary")
    issues.write.json(f"{out_dir}/issues")
    profiles.write.json(f"{out_dir}/profiles")
    return out_dir


def write_report_text(lines: DataFrame, path: str) -> str:
    """Analysis report as text, sections and lines in order.

    Part files follow the same order, so reading them by name gives the report.
    """
    number = F.coalesce(F.concat(F.lit(": "), F.format_number("value", 2)), F.lit(""))
    text = F.concat(F.lit("["), F.col("section"), F.lit("] "), F.coalesce("label", F.lit("")), number)
    lines.orderBy("section", "ord", "label").select(text.alias("value")).write.text(path)
    return path


def step_entry(status: str, timestamp: str, details: Mapping[str, Any] | None = None) -> dict[str, str]:
    return {"status": status, "timestamp": timestamp, "details": json.dumps(dict(details or {}), default=str)}


def append_run(spark: SparkSession, path: str, record: Mapping[str, Any]) -> None:
    """Append one run record to the ledger; an absent end time stays null."""
    row = tuple(record.get(f.name) for f in RUN_SCHEMA.fields)
    spark.createDataFrame([row], RUN_SCHEMA).coalesce(1).write.mode("append").json(path)


def export_metrics(metrics: DataFrame, path: str) -> str | None:
    """Run metrics to CSV; nothing to export gives no file."""
    if metrics.isEmpty():
        return None
    return write_table(metrics, path, "csv")
