"""Run history and quality-report monitoring over the JSON records."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import casts, dates, text
from ..schema import q

RUN_METRIC_COLUMNS = (
    "run_id",
    "status",
    "start_time",
    "end_time",
    "duration_minutes",
    "successful_steps",
    "failed_steps",
    "total_errors",
    "output_files",
)


def parse_instants(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn("started_at", dates.to_instant(q(column)))


def rejected_runs(runs: DataFrame) -> DataFrame:
    """Records whose start time does not parse (kept apart, never silently lost)."""
    return parse_instants(runs, "start_time").filter("started_at is null").drop("started_at")


def recent_runs(runs: DataFrame, as_of: dt.datetime, days: int = 7) -> DataFrame:
    """Runs started in the last ``days``; unparsable start times drop out."""
    stamped = parse_instants(runs, "start_time")
    return stamped.filter(F.col("started_at") >= F.lit(as_of - dt.timedelta(days=days)))


def newest(runs: DataFrame, n: int) -> DataFrame:
    return runs.orderBy(F.col("started_at").desc(), F.col("run_id").desc()).limit(n)


def success_rate(runs: DataFrame) -> DataFrame:
    """Every status other than SUCCESS counts as a failure."""
    ok = F.count_if(F.col("status") == "SUCCESS")
    return runs.agg(F.count("*").alias("runs"), ok.alias("successes")).select(
        "runs",
        "successes",
        (F.col("runs") - F.col("successes")).alias("failures"),
        F.round(F.try_divide(F.col("successes") * 100.0, F.col("runs")), 4).alias("success_rate"),
    )


def _steps_with(status: str) -> Column:
    values = F.coalesce(F.map_values("steps"), F.array())
    return F.size(F.filter(values, lambda s: s["status"] == status))


def _length(array: str) -> Column:
    return F.coalesce(F.size(F.coalesce(F.col(array), F.array().cast("array<string>"))), F.lit(0))


def run_metrics(runs: DataFrame) -> DataFrame:
    """Nine-column metrics table, one row per run; duration is null for runs without an end."""
    minutes = dates.minutes_between(
        dates.to_instant(F.col("start_time")), dates.to_instant(F.col("end_time"))
    )
    return runs.select(
        "run_id",
        "status",
        "start_time",
        "end_time",
        minutes.alias("duration_minutes"),
        _steps_with("SUCCESS").alias("successful_steps"),
        _steps_with("FAILED").alias("failed_steps"),
        _length("errors").alias("total_errors"),
        _length("output_files").alias("output_files"),
    )


def error_heads(runs: DataFrame, first: int = 2, chars: int = 80) -> DataFrame:
    """First errors of each run, shortened."""
    shown = F.slice(F.coalesce("errors", F.array().cast("array<string>")), 1, first)
    return runs.select("run_id", F.posexplode(shown).alias("pos", "error")).select(
        "run_id", "pos", text.head(F.col("error"), chars).alias("error")
    )


def run_details(runs: DataFrame) -> DataFrame:
    """Steps and output files of the given runs as lines."""
    steps = runs.select("run_id", "status", "started_at", F.explode("steps").alias("name", "step")).select(
        "run_id", "status", "started_at", F.lit("step").alias("kind"), "name", F.col("step.status").alias("state")
    )
    files = runs.select("run_id", "status", "started_at", F.explode("output_files").alias("path")).select(
        "run_id", "status", "started_at", F.lit("file").alias("kind"),
        text.file_name(F.col("path")).alias("name"), F.lit(None).cast("string").alias("state"),
    )
    return steps.unionByName(files)


def _section(title: str, lines: Column) -> Column:
    return F.when(F.size(lines) > 0, F.concat(F.array(F.lit(title)), lines)).otherwise(
        F.array().cast("array<string>")
    )


def summary_text(runs: DataFrame) -> DataFrame:
    """One readable text per run: status, times, steps, output files, errors."""
    none = F.array().cast("array<string>")
    steps = F.transform(
        F.array_sort(F.coalesce(F.map_entries("steps"), F.array())),
        lambda e: F.concat(F.lit("- "), e["key"], F.lit(": "), e["value"]["status"]),
    )
    files = F.transform(F.coalesce("output_files", none), lambda p: F.concat(F.lit("- "), text.file_name(p)))
    errors = F.transform(F.coalesce("errors", none), lambda e: F.concat(F.lit("- "), e))
    top = F.array(
        F.concat(F.lit("Status: "), "status"),
        F.concat(F.lit("Run: "), "run_id"),
        F.concat(F.lit("Start: "), "start_time"),
        F.concat(F.lit("End: "), F.coalesce("end_time", F.lit("Running..."))),
    )
    body = F.concat(
        top, _section("Steps:", steps), _section("Output files:", files), _section("Errors:", errors)
    )
    return runs.select("run_id", F.array_join(body, "\n").alias("summary"))


# -- quality reports ----------------------------------------------------------


def recent_reports(reports: DataFrame, as_of: dt.datetime, days: int = 7) -> DataFrame:
    stamped = reports.withColumn("reported_at", dates.to_instant(F.col("processing_timestamp")))
    return stamped.filter(F.col("reported_at") >= F.lit(as_of - dt.timedelta(days=days)))


def latest_report(reports: DataFrame, as_of: dt.datetime, days: int = 7) -> DataFrame:
    """The newest report; of several at one instant, the last by its texts."""
    newest = [F.col("reported_at").desc(), F.col("processing_timestamp").desc(), F.to_json("summary_statistics").desc()]
    return recent_reports(reports, as_of, days).orderBy(*newest).limit(1)


def issue_rows(reports: DataFrame, *keys: str) -> DataFrame:
    """Issues of each report as rows, the count read whether it was text or number."""
    return reports.select(*keys, F.posexplode("data_quality_issues").alias("pos", "i")).select(
        *keys, "pos", "i.severity", "i.message", casts.to_count(F.col("i.count")).alias("issue_count")
    )


def issue_counts(issues: DataFrame, *keys: str) -> DataFrame:
    return issues.groupBy(*keys).agg(
        F.count_if(F.col("severity") == "ERROR").alias("errors"),
        F.count_if(F.col("severity") == "WARNING").alias("warnings"),
        F.count("*").alias("issues"),
    )


def last_issues(reports: DataFrame, n: int = 5, chars: int = 60) -> DataFrame:
    """Last few issues of each report, message shortened."""
    size = F.size("data_quality_issues")
    tail = F.slice("data_quality_issues", F.greatest(size - (n - 1), F.lit(1)), F.lit(n))
    return reports.withColumn("data_quality_issues", F.when(size > 0, tail)).transform(issue_rows).withColumn(
        "message", text.head(F.col("message"), chars)
    )


def incomplete_columns(reports: DataFrame, n: int = 5) -> DataFrame:
    """Columns with most nulls in the given report, with their completeness."""
    stats = F.col("summary_statistics")
    cells = reports.select(
        stats["total_rows"].alias("total_rows"),
        F.explode(stats["null_counts"]).alias("column_name", "null_count"),
    )
    share = (F.col("total_rows") - F.col("null_count")) * 100.0 / F.col("total_rows")
    return (
        cells.orderBy(F.col("null_count").desc(), "column_name")
        .limit(n)
        .filter("null_count > 0")
        .select("column_name", "null_count", F.round(share, 4).alias("completeness"))
    )
