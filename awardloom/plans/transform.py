"""Landed files to processed award table, quality report and summary."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..operators import conform, dedup, filters, profile, reports, validate
from ..operators.dedup import union_all
from ..session import free_shuffles, keep_compiled, passing_tables, stored
from ..sources import landing, sinks

log = logging.getLogger(__name__)

BOOKKEEPING = (landing.SOURCE_FILE, landing.ROW_ORDER)


@dataclass(frozen=True)
class Prepared:
    """Typed rows before duplicate removal, and the issues found on the way."""

    rows: DataFrame
    issues: DataFrame


def typed_rows(groups: Sequence[DataFrame], cfg: EngineConfig, wanted: Mapping[str, Any], keep: Sequence[str] = BOOKKEEPING) -> DataFrame:
    """All rows of the frames conformed, typed and marked by rules and filters; no row is dropped."""
    keep_compiled(groups[0].sparkSession)
    # Typing takes nothing from the marks, which are of the text.
    return union_all([conform.clean(validate.with_marks(conform.conform(g, cfg, keep=keep), cfg, wanted), cfg) for g in groups])


def kept_rows(marked: DataFrame) -> DataFrame:
    return marked.filter(validate.marked(validate.KEPT)).drop(validate.MARKS)


def prepare(groups: Sequence[DataFrame], cfg: EngineConfig, custom_filters: Mapping[str, Any] | None = None) -> Prepared:
    """Conform, validate, filter and type frames that each are one file layout, then union them by name."""
    wanted = filters.merge_filters(cfg.default_filters, custom_filters)
    issues = []
    for g in groups:
        conformed = conform.conform(g, cfg, keep=BOOKKEEPING)
        issues.append(validate.issue_log(conformed, cfg, wanted, landing.SOURCE_FILE, conform.missing_columns(g.columns, cfg)))
    return Prepared(kept_rows(typed_rows(groups, cfg, wanted)), union_all(issues))


def _absent(cfg: EngineConfig) -> Column:
    """Array of (severity, rule, message) of the mapped columns that a file (its ``columns``) lacks; a file without any
    of them has one issue more."""
    cells = [
        F.when(
            ~F.array_contains("columns", src),
            F.struct(F.lit(severity).alias("severity"), F.lit("missing_column").alias("rule"), F.lit(validate.MISSING_MESSAGE % (src, dst)).alias("message")),
        )
        for src, dst, severity in conform.missing_columns((), cfg)
    ]
    nothing = F.struct(F.lit("ERROR").alias("severity"), F.lit("load").alias("rule"), F.lit(validate.NOTHING_MESSAGE).alias("message"))
    missing = F.array_compact(F.array(*cells))
    return F.when(F.size(missing) == len(cfg.column_mapping), F.concat(missing, F.array(nothing))).otherwise(missing)


def file_issues(files: DataFrame, counts: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Issues of every readable file: missing columns by its header, rules by the counts of its marks."""
    readable = files.filter("readable").select(F.col("path").alias(landing.SOURCE_FILE), _absent(cfg).alias("absent"))
    joined = readable.join(counts, landing.SOURCE_FILE, "left").withColumns({n: F.coalesce(n, F.lit(0).cast("bigint")) for n in ("n0", "n1")})
    return validate.issues_of_marks(joined, list(cfg.column_mapping.values()), cfg, landing.SOURCE_FILE, F.col("absent"))


def awards_of(rows: DataFrame, cfg: EngineConfig) -> DataFrame:
    """First row per award key, bookkeeping columns removed; rows with places stay where they lie."""
    keep = dedup.keep_first_placed if set(dedup.PLACE) <= set(rows.columns) else dedup.keep_first
    return keep(rows, cfg.dedup_keys, BOOKKEEPING[1:]).drop(*BOOKKEEPING)


def awards_of_stored(table: DataFrame, cfg: EngineConfig, custom_filters: Mapping[str, Any] | None = None) -> DataFrame:
    """The awards of one stored Parquet table of landed rows."""
    wanted = filters.merge_filters(cfg.default_filters, custom_filters)
    return awards_of(kept_rows(typed_rows([dedup.placed(table)], cfg, wanted, (*BOOKKEEPING, *dedup.PLACE))), cfg)


@dataclass(frozen=True)
class Outcome:
    awards_path: str | None
    report_path: str | None


def process_landing(
    spark: SparkSession,
    root: str,
    out_dir: str,
    run_id: str,
    cfg: EngineConfig | None = None,
    custom_filters: Mapping[str, Any] | None = None,
    approx_distinct: bool = False,
    **scan_options,
) -> Outcome:
    """Full transform: one pass types and marks the rows into a stored table, from which awards, issues and counts follow.

    Beside that pass, only the search for odd files reads the text. A CSV result is exported from the typed table and the marks
    of its first rows, which is also what the profiles read then. Tables between the steps are deleted as soon as no step
    reads them, a CSV result is packed unless ``cfg.pack_text`` is off. Where no file is readable, or no row is left, the issues are
    written all the same.
    """
    cfg = cfg or EngineConfig()
    with passing_tables(spark) as drop:
        return _process(spark, root, out_dir, run_id, cfg, custom_filters, approx_distinct, drop, scan_options)


def _process(spark, root, out_dir, run_id, cfg, custom_filters, approx_distinct, drop, scan_options) -> Outcome:
    found = landing.scan_landing(spark, root, columns=list(cfg.column_mapping), **scan_options)
    report = f"{out_dir.rstrip('/')}/quality_report_{run_id}"
    wanted = filters.merge_filters(cfg.default_filters, custom_filters)
    if found.groups:
        marked = stored(typed_rows(found.groups, cfg, wanted), "typed")
        drop("split-starts", "records")  # nothing reads the text again
        counts = stored(validate.mark_counts(marked, cfg, landing.SOURCE_FILE), "marks")
    else:
        nothing = f"{landing.SOURCE_FILE} string, n0 bigint, n1 bigint, found array<bigint>"
        marked, counts = None, spark.createDataFrame([], nothing)
    issues = stored(union_all([found.issues, file_issues(found.files, counts, cfg)]), "issues")
    rows_before = counts.agg(F.coalesce(F.sum("n1"), F.lit(0)).alias("n")).first().n
    if not rows_before:
        log.warning("no data to write for awards")
        issues.write.json(f"{report}/issues")
        return Outcome(None, report)
    awards = awards_of(kept_rows(dedup.placed(marked)), cfg)
    path = f"{out_dir.rstrip('/')}/awards_{run_id}.{cfg.output_format}"
    columnar = cfg.output_format == "parquet"
    if columnar or not cfg.include_quality_report:
        sinks.write_table(awards, path, cfg.output_format, packed=cfg.pack_text)
    if not cfg.include_quality_report:
        return Outcome(path, None)
    if columnar:
        awards = landing.read_processed(spark, path)
        drop("typed", "single-rows", "first-rows")
    after = F.count("*")
    removed = awards.agg(F.lit(rows_before).alias("rows_before"), after.alias("rows_after"), (F.lit(rows_before) - after).alias("rows_removed"))
    sinks.write_quality_report(
        profile.column_profiles(awards, approx_distinct),
        union_all([issues, validate.duplicate_issue(removed)]),
        profile.summary_stats(awards) if cfg.include_summary else None,
        report,
    )
    free_shuffles(spark)
    if not columnar:  # last, as the exchange of the distinct counts needs the disk before
        sinks.write_table(awards, path, cfg.output_format, packed=cfg.pack_text)
    return Outcome(path, report)


def end_of_run_summary(spark: SparkSession, outcome: Outcome) -> DataFrame:
    """Summary lines of a finished run, from what it wrote."""
    issues = spark.read.schema(
        "source_file string, ord int, severity string, rule string, message string, issue_count bigint"
    ).json(f"{outcome.report_path}/issues")
    return reports.run_summary(landing.read_processed(spark, outcome.awards_path), issues)
