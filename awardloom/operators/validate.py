"""Validation rules and the issue log. Rules count rows; they never drop any."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import EngineConfig
from ..functions import casts
from ..schema import q
from .conform import missing_columns
from .filters import keep_predicate, mark_listed

# Message formats of the issue log.
REQUIRED_MESSAGE = "Required field '%s' has %s null values"
YEAR_MESSAGE = "Found %s records with invalid fiscal years"
FLOOR_MESSAGE = "Found %s records below minimum dollar threshold"
FILTER_MESSAGE = "Applied filters: %s -> %s rows"
DATE_MESSAGE = "Column '%s': %s invalid dates converted to null"
NUMERIC_MESSAGE = "Column '%s': %s invalid numeric values converted to null"
MISSING_MESSAGE = "Missing column: %s -> %s"
NOTHING_MESSAGE = "No required columns found in dataset"
DUPLICATE_MESSAGE = "Removed %s duplicate rows"
# Message of our own for the ceiling rule, which has no published wording.
CEILING_MESSAGE = "Found %s records above maximum dollar threshold"


def required_rules(df: DataFrame, cfg: EngineConfig) -> dict[str, Column]:
    return {f: q(f).isNull() for f in cfg.required_fields if f in df.columns}


def year_out_of_range(cfg: EngineConfig) -> Column:
    first, last = cfg.fiscal_year_limits
    year = casts.to_amount(q("Fiscal Year").cast("string"))
    return (year < first) | (year > last)


def dollars_below(minimum) -> Column:
    return casts.to_amount(q("Dollars Obligated").cast("string")) < F.lit(minimum)


def dollars_above(maximum) -> Column:
    return casts.to_amount(q("Dollars Obligated").cast("string")) > F.lit(maximum)


def lost_date(column: str) -> Column:
    """Null after parsing, whether it was null before or not."""
    return casts.to_date(q(column).cast("string")).isNull()


def lost_number(column: str) -> Column:
    """Null after parsing although there was a value."""
    return q(column).isNotNull() & casts.to_amount(q(column).cast("string")).isNull()


def validate_required(df: DataFrame, cfg: EngineConfig, by: Sequence[str]) -> DataFrame:
    rules = required_rules(df, cfg)
    counts = df.groupBy(*by).agg(*[F.count_if(c).alias(f) for f, c in rules.items()])
    return counts.unpivot(list(by), [q(f) for f in rules], "field", "null_count")


def validate_fiscal_year(df: DataFrame, cfg: EngineConfig, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count_if(year_out_of_range(cfg)).alias("invalid_count"))


def validate_min_dollars(df: DataFrame, minimum, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count_if(dollars_below(minimum)).alias("below_count"))


def validate_max_dollars(df: DataFrame, maximum, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count_if(dollars_above(maximum)).alias("above_count"))


def coercion_loss_dates(df: DataFrame, cfg: EngineConfig, by: Sequence[str]) -> DataFrame:
    counts = df.groupBy(*by).agg(*[F.count_if(lost_date(c)).alias(c) for c in cfg.date_columns])
    return counts.unpivot(list(by), [q(c) for c in cfg.date_columns], "column_name", "invalid_count")


def coercion_loss_numeric(df: DataFrame, cfg: EngineConfig, by: Sequence[str]) -> DataFrame:
    counts = df.groupBy(*by).agg(*[F.count_if(lost_number(c)).alias(c) for c in cfg.numeric_columns])
    return counts.unpivot(list(by), [q(c) for c in cfg.numeric_columns], "column_name", "invalid_count")


@dataclass(frozen=True)
class Rule:
    """A condition on conformed rows, and the issue that tells how many rows meet it."""

    name: str
    severity: str
    template: str
    words: tuple[str, ...]
    condition: Column


#: Column of the rule marks, and its bit for rows that the filters keep; rule number i has bit i + 1.
MARKS = "rule_marks"
KEPT = 0


def _rules(columns: Sequence[str], cfg: EngineConfig, keep: Column) -> tuple[list[Rule], int]:
    """The rules in the order of the log, at most 62, and how many of them come before the issue of the filters.

    Validation looks at every row; coercion losses only at rows the filters keep, because typing happens after filtering.
    """
    first = [Rule("required", "WARNING", REQUIRED_MESSAGE, (f,), q(f).isNull()) for f in cfg.required_fields if f in columns]
    if cfg.fiscal_year_limits and "Fiscal Year" in columns:
        first.append(Rule("fiscal_year", "WARNING", YEAR_MESSAGE, (), year_out_of_range(cfg)))
    if "Dollars Obligated" in columns:
        if cfg.min_dollars_limit is not None:
            first.append(Rule("min_dollars", "INFO", FLOOR_MESSAGE, (), dollars_below(cfg.min_dollars_limit)))
        if cfg.max_dollars_limit is not None:
            first.append(Rule("max_dollars", "INFO", CEILING_MESSAGE, (), dollars_above(cfg.max_dollars_limit)))
    then = [Rule("dates", "WARNING", DATE_MESSAGE, (c,), keep & lost_date(c)) for c in cfg.date_columns if c in columns]
    then += [Rule("numerics", "WARNING", NUMERIC_MESSAGE, (c,), keep & lost_number(c)) for c in cfg.numeric_columns if c in columns]
    return first + then, len(first)


def with_marks(df: DataFrame, cfg: EngineConfig, filters: Mapping[str, Any]) -> DataFrame:
    """Conformed rows with one 64-bit number of marks: whether the filters keep the row, and each rule that it meets."""
    marked = mark_listed(df, filters)
    keep = keep_predicate(marked.columns, filters)
    conditions = [keep, *[r.condition for r in _rules(df.columns, cfg, keep)[0]]]
    if len(conditions) > 63:
        raise ValueError(f"{len(conditions) - 1} rules; a row has marks for 62")
    bits = [F.when(c, F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for i, c in enumerate(conditions)]
    return marked.select(*[q(c) for c in df.columns], reduce(lambda x, y: x.bitwiseOR(y), bits).alias(MARKS))


def marked(bit: int) -> Column:
    return F.col(MARKS).bitwiseAND(F.lit(1 << bit).cast("bigint")) != 0


def mark_counts(rows: DataFrame, cfg: EngineConfig, by: str) -> DataFrame:
    """Rows (n0), kept rows (n1) and the rows of each rule (an array), by ``by``: reads that column and the marks only."""
    rules, _ = _rules(rows.columns, cfg, F.lit(True))
    found = [F.count_if(marked(i + 1)) for i in range(len(rules))]
    return rows.groupBy(by).agg(
        F.count("*").alias("n0"), F.count_if(marked(KEPT)).alias("n1"), (F.array(*found) if found else F.array().cast("array<bigint>")).alias("found")
    )


def issues_of_marks(counts: DataFrame, columns: Sequence[str], cfg: EngineConfig, by: str, absent: Column) -> DataFrame:
    """The issue log from ``mark_counts``, a group after the other: missing columns, then rules in order.

    ``absent`` is an array of (severity, rule, message) of issues without a count, which come first.
    """
    rules, before_filters = _rules(columns, cfg, F.lit(True))
    removed = F.col("n0") - F.col("n1")
    found = [(n, r) for n, r in zip((F.get("found", F.lit(i)) for i in range(len(rules))), rules)]
    cells = [F.when(n > 0, F.struct(F.lit(r.severity).alias("severity"), F.lit(r.name).alias("rule"), F.format_string(r.template, *[F.lit(w) for w in r.words], n).alias("message"), n.alias("issue_count"), F.lit(i + (i >= before_filters)).alias("place"))) for i, (n, r) in enumerate(found)]
    filtered = F.struct(F.lit("INFO").alias("severity"), F.lit("filters").alias("rule"), F.format_string(FILTER_MESSAGE, F.col("n0"), F.col("n1")).alias("message"), removed.alias("issue_count"), F.lit(before_filters).alias("place"))
    cells.insert(before_filters, F.when(removed > 0, filtered))
    first = F.transform(
        absent,
        lambda x, i: F.struct(x["severity"].alias("severity"), x["rule"].alias("rule"), x["message"].alias("message"), F.lit(None).cast("bigint").alias("issue_count"), (i - F.size(absent)).cast("int").alias("place")),
    )
    every = counts.select(by, F.size(absent).alias("n"), F.explode(F.concat(first, F.array_compact(F.array(*cells)))).alias("i"))
    return every.select(by, (F.col("n") + F.col("i.place")).cast("int").alias("ord"), "i.severity", "i.rule", "i.message", "i.issue_count")


def absent_issues(missing: Sequence[tuple[str, str, str]]) -> Column:
    """The array that ``issues_of_marks`` takes, of missing columns as ``conform.missing_columns`` gives them."""
    cells = [F.struct(F.lit(s).alias("severity"), F.lit("missing_column").alias("rule"), F.lit(MISSING_MESSAGE % (src, dst)).alias("message")) for src, dst, s in missing]
    return F.array(*cells) if cells else F.array().cast("array<struct<severity:string,rule:string,message:string>>")


def issue_log(
    df: DataFrame, cfg: EngineConfig, filters: Mapping[str, Any], by: str = "source_file", absent: Sequence[tuple[str, str, str]] = ()
) -> DataFrame:
    """All issues per source file from one pass over the conformed, unfiltered rows.

    ``absent`` lists missing columns as given by :func:`~awardloom.operators.conform.missing_columns`; their issues carry no count.
    """
    counts = mark_counts(with_marks(df, cfg, filters), cfg, by)
    return issues_of_marks(counts, df.columns, cfg, by, absent_issues(absent))


def duplicate_issue(accounting: DataFrame) -> DataFrame:
    """Issue row for removed duplicates (run level, so no source file)."""
    removed = F.col("rows_removed")
    return accounting.filter(removed > 0).select(
        F.lit(None).cast("string").alias("source_file"),
        F.lit(2**31 - 1).alias("ord"),
        F.lit("INFO").alias("severity"),
        F.lit("duplicates").alias("rule"),
        F.format_string(DUPLICATE_MESSAGE, removed).alias("message"),
        removed.alias("issue_count"),
    )


def absent_columns(df: DataFrame, cfg: EngineConfig) -> list[tuple[str, str, str]]:
    return missing_columns(df.columns, cfg)
