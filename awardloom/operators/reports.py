"""Fixed aggregate reports over the processed award table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import flag_label
from ..schema import FLAG_PREFIX, q, quoted, text_literal
from .dedup import union_all
from .medians import exact_medians

AGENCY, VENDOR, TYPE = "Funding Agency Name", "Legal Business Name", "Instrument Type"
DOLLARS, YEAR, SIGNED = "Dollars Obligated", "Fiscal Year", "Date Signed"


def _exact_sum(amount: Column) -> Column:
    """Exact decimal sum as double; no amounts at all sum to zero."""
    return F.coalesce(F.sum(amount), F.lit(0)).cast("double")


def _percent(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part * 100.0, whole), 4)


def _flags(df: DataFrame) -> list[str]:
    return [c for c in df.columns if FLAG_PREFIX.strip(" -") in c]


def facts(df: DataFrame) -> DataFrame:
    """One row with every ungrouped measure of the reports, from a single scan.

    A report that selects a few of them makes Spark drop the other aggregates and their columns.
    SQL text keeps the many small expressions cheap to build.
    """
    flags, names = _flags(df), df.columns
    money = quoted(DOLLARS) if DOLLARS in names else None
    total = "cast(coalesce(sum({}), 0) AS double)"
    aggs = ["count(*) AS total_records"]
    kept = ["total_records"]
    if SIGNED in names:
        aggs += [f"min({quoted(SIGNED)}) AS first_date", f"max({quoted(SIGNED)}) AS last_date"]
        kept += ["first_date", "last_date"]
    if money:
        aggs += [
            f"{total.format(money)} AS total",
            f"count({money}) AS present",
            f"cast(min({money}) AS double) AS min",
            f"cast(max({money}) AS double) AS max",
        ]
        kept += ["total", "present", "min", "max"]
    aggs += [f"count({quoted(c)}) AS filled_{i}" for i, c in enumerate(names)]
    flag_cells = []
    for i, c in enumerate(flags):
        aggs.append(f"count_if({quoted(c)}) AS true_{i}")
        dollars = "cast(null AS double)"
        if money:
            aggs.append(f"{total.format(f'CASE WHEN {quoted(c)} THEN {money} END')} AS dollars_{i}")
            dollars = f"dollars_{i}"
        flag_cells.append(
            f"named_struct('business_type', {text_literal(flag_label(c))}, 'true_count', true_{i}, "
            f"'present', filled_{names.index(c)}, 'dollars', {dollars})"
        )
    null_cells = ", ".join(
        f"named_struct('column_name', {text_literal(c)}, 'null_count', total_records - filled_{i})"
        for i, c in enumerate(names)
    )
    filled = " + ".join(f"filled_{i}" for i in range(len(names)))
    cells = f"(total_records * {len(names)})"
    return df.selectExpr(*aggs).selectExpr(
        *kept,
        f"{len(names)} AS total_columns",
        f"{cells} AS total_cells",
        f"{cells} - ({filled}) AS missing_cells",
        f"round(try_divide(({filled}) * double(100), {cells}), 4) AS completeness",
        f"array({null_cells}) AS nulls",
        *([f"array({', '.join(flag_cells)}) AS flags"] if flags else []),
    )


def basic_stats(df: DataFrame) -> DataFrame:
    return facts(df).select("total_records", "first_date", "last_date", "total_columns")


def _mean() -> Column:
    return F.round(F.try_divide(F.col("total"), F.col("present")), 4)


def _median(df: DataFrame) -> Column:
    return exact_medians(df, [DOLLARS]).select("median").scalar()


def dollar_stats(df: DataFrame) -> DataFrame:
    return facts(df).select("total", _mean().alias("mean"), _median(df).alias("median"), "min", "max")


def missing_data_ranked(df: DataFrame) -> DataFrame:
    return (
        facts(df)
        .select("total_records", F.inline("nulls"))
        .filter("null_count > 0")
        .select(
            "column_name",
            "null_count",
            _percent(F.col("null_count"), F.col("total_records")).alias("null_percentage"),
        )
        .orderBy(F.col("null_count").desc(), "column_name")
    )


def completeness(df: DataFrame) -> DataFrame:
    """Share of filled cells in the whole table."""
    return facts(df).select("total_cells", "missing_cells", "completeness")


def small_business_participation(df: DataFrame) -> DataFrame:
    """True count and share of the non-null values per vendor-type flag."""
    return (
        facts(df)
        .select(F.inline("flags"))
        .filter("present > 0")
        .select(
            "business_type", "true_count", _percent(F.col("true_count"), F.col("present")).alias("percentage")
        )
    )


def small_business_dollars(df: DataFrame, first: int = 3) -> DataFrame:
    """Dollars under a true flag and their share of all dollars, for the first few flags."""
    share = F.when(F.col("total") > 0, _percent(F.col("dollars"), F.col("total"))).otherwise(0.0)
    return (
        facts(df)
        .select("total", F.inline(F.slice("flags", 1, first)))
        .select("business_type", "dollars", share.alias("percentage"))
    )


def fiscal_year_distribution(df: DataFrame) -> DataFrame:
    counts = df.filter(q(YEAR).isNotNull()).groupBy(q(YEAR).alias("fiscal_year"))
    return counts.agg(F.count("*").alias("records")).orderBy("fiscal_year")


def top_by_count(df: DataFrame, column: str, n: int) -> DataFrame:
    """Most frequent values; ties go by name."""
    counts = df.filter(q(column).isNotNull()).groupBy(q(column).alias("name"))
    return counts.agg(F.count("*").alias("records")).orderBy(F.col("records").desc(), "name").limit(n)


def top_by_dollars(df: DataFrame, column: str, n: int) -> DataFrame:
    sums = df.filter(q(column).isNotNull()).groupBy(q(column).alias("name"))
    return sums.agg(_exact_sum(q(DOLLARS)).alias("dollars")).orderBy(F.col("dollars").desc(), "name").limit(n)


def contract_type_distribution(df: DataFrame) -> DataFrame:
    """Share of each type among all rows, rows without a type included in the whole."""
    counts = df.groupBy(q(TYPE).alias("instrument_type")).agg(F.count("*").alias("records"))
    total = counts.agg(F.sum("records").alias("n")).scalar()
    return (
        counts.withColumn("percentage", _percent(F.col("records"), total))
        .filter(F.col("instrument_type").isNotNull())
        .orderBy(F.col("records").desc(), "instrument_type")
    )


def contract_type_value(df: DataFrame) -> DataFrame:
    sums = df.filter(q(TYPE).isNotNull()).groupBy(q(TYPE).alias("instrument_type"))
    return (
        sums.agg(F.count(q(DOLLARS)).alias("records"), _exact_sum(q(DOLLARS)).alias("total"))
        .withColumn("mean", F.round(F.try_divide(F.col("total"), F.col("records")), 4))
        .orderBy(F.col("total").desc(), "instrument_type")
    )


# -- report lines ---------------------------------------------------------------
#
# Lines are (section, ord, label, value); ord is the sort key inside a section, so a section of
# any length is ordered without numbering its rows in one task.


@dataclass
class Section:
    """Lines of one section: arrays built from the facts row, and frames of lines."""

    from_facts: list[Column] = field(default_factory=list)
    frames: list[DataFrame] = field(default_factory=list)


def _line(section: str, ord_: Column, label: Column, value: Column) -> Column:
    return F.struct(
        F.lit(section).alias("section"),
        ord_.cast("double").alias("ord"),
        label.cast("string").alias("label"),
        value.cast("double").alias("value"),
    )


def _listed(section: str, lines: list[tuple[Column, Column]]) -> Column:
    return F.array(*[_line(section, F.lit(i), label, value) for i, (label, value) in enumerate(lines, 1)])


def _named(section: str, names: list[str]) -> Column:
    return _listed(section, [(F.lit(n), F.col(n)) for n in names])


def _ranked_cells(
    section: str, array: Column, label: str, value: str, shown: Callable[[Column], Column] | None = None
) -> Column:
    """Lines in falling order of ``value``, which they show unless told otherwise."""
    return F.transform(array, lambda x: _line(section, -x[value], x[label], shown(x) if shown else x[value]))


def _ranked(section: str, rows: DataFrame, label: str, value: str, shown: str | None = None) -> DataFrame:
    line = _line(section, -F.col(value), F.col(label), F.col(shown or value))
    return rows.select(line.alias("l")).select("l.*")


def _years(df: DataFrame) -> DataFrame:
    year = F.col("fiscal_year")
    line = _line("fiscal_years", year, year, F.col("records"))
    return fiscal_year_distribution(df).select(line.alias("l")).select("l.*")


def section_basic(df: DataFrame) -> Section:
    out = Section([_named("basic", ["total_records", "total_columns"])])
    if SIGNED in df.columns:
        out.from_facts.append(
            _listed(
                "date_range",
                [
                    (F.concat(F.lit("from "), F.col("first_date").cast("string")), F.lit(None)),
                    (F.concat(F.lit("to "), F.col("last_date").cast("string")), F.lit(None)),
                ],
            )
        )
    if YEAR in df.columns:
        out.frames.append(_years(df))
    if DOLLARS in df.columns:
        values = {
            "total": F.col("total"), "mean": _mean(), "median": _median(df), "min": F.col("min"), "max": F.col("max"),
        }
        out.from_facts.append(_listed("dollars", [(F.lit(k), v) for k, v in values.items()]))
    return out


def _top_section(df: DataFrame, column: str, name: str) -> Section:
    out = Section(frames=[_ranked(f"{name}_by_count", top_by_count(df, column, 10), "name", "records")])
    if DOLLARS in df.columns:
        out.frames.append(_ranked(f"{name}_by_dollars", top_by_dollars(df, column, 10), "name", "dollars"))
    return out


def section_agency(df: DataFrame) -> Section:
    return _top_section(df, AGENCY, "agencies")


def section_vendors(df: DataFrame) -> Section:
    return _top_section(df, VENDOR, "vendors")


def section_contracts(df: DataFrame) -> Section:
    types, values = contract_type_distribution(df), ("total", "records", "mean")
    out = Section(
        frames=[
            _ranked("types_by_count", types, "instrument_type", "records"),
            _ranked("types_percentage", types, "instrument_type", "records", "percentage"),
        ]
    )
    if DOLLARS in df.columns:
        names = ("types_by_dollars", "types_by_dollars_records", "types_by_dollars_mean")
        worth = contract_type_value(df)
        out.frames += [_ranked(n, worth, "instrument_type", "total", v) for n, v in zip(names, values)]
    return out


def section_small_business(df: DataFrame) -> Section:
    if not _flags(df):
        return Section()
    with_values = F.filter("flags", lambda x: x["present"] > 0)
    share = lambda x: _percent(x["true_count"], x["present"])
    out = Section(
        [
            _ranked_cells("flag_participation", with_values, "business_type", "true_count"),
            _ranked_cells("flag_percentage", with_values, "business_type", "true_count", share),
        ]
    )
    if DOLLARS in df.columns:
        first = F.slice("flags", 1, 3)
        worth = lambda x: F.when(F.col("total") > 0, _percent(x["dollars"], F.col("total"))).otherwise(0.0)
        out.from_facts += [
            _ranked_cells("flag_dollars", first, "business_type", "dollars"),
            _ranked_cells("flag_dollars_percentage", first, "business_type", "dollars", worth),
        ]
    return out


def section_quality(df: DataFrame) -> Section:
    missing = F.filter("nulls", lambda x: x["null_count"] > 0)
    return Section(
        [
            _ranked_cells("missing_data", missing, "column_name", "null_count"),
            _ranked_cells(
                "missing_percentage", missing, "column_name", "null_count",
                lambda x: _percent(x["null_count"], F.col("total_records")),
            ),
            _named("completeness", ["completeness"]),
        ]
    )


# Needed column per section: a section is left out when its column is absent.
SECTIONS: dict[str, tuple[str | None, Callable[[DataFrame], Section]]] = {
    "basic": (None, section_basic),
    "agency": (AGENCY, section_agency),
    "contracts": (TYPE, section_contracts),
    "small-business": (None, section_small_business),
    "vendors": (VENDOR, section_vendors),
    "quality": (None, section_quality),
}


def report(df: DataFrame, analysis: str = "full") -> DataFrame:
    """Long-form report of one section, or of all of them.

    ``df`` should be the stored processed table: all ungrouped measures of all sections share one
    scan, and each grouping reads only its own columns.
    """
    if analysis != "full" and analysis not in SECTIONS:
        raise ValueError(f"unknown analysis: {analysis}")
    chosen = list(SECTIONS) if analysis == "full" else [analysis]
    parts = [build(df) for need, build in (SECTIONS[s] for s in chosen) if need is None or need in df.columns]
    arrays = [a for p in parts for a in p.from_facts]
    frames = [f for p in parts for f in p.frames]
    if arrays:
        frames.insert(0, facts(df).select(F.inline(F.concat(*arrays))))
    return union_all(frames)


def run_summary(df: DataFrame, issues: DataFrame) -> DataFrame:
    """End-of-run summary: size, issue count, last five issues, top agencies, fiscal years."""
    newest = [F.col("source_file").desc_nulls_first(), F.col("ord").desc()]
    # Numbering happens on the five kept rows only.
    last = issues.orderBy(*newest).limit(5)
    last = last.withColumn("pos", F.row_number().over(Window.orderBy(*newest)))
    shown = _line("last_issues", F.col("pos"), F.concat_ws(": ", "severity", "message"), F.col("issue_count"))
    size = F.array(
        _line("records", F.lit(1), F.lit("records"), F.col("total_records")),
        _line("columns", F.lit(1), F.lit("columns"), F.col("total_columns")),
    )
    count = _line("issues", F.lit(1), F.lit("issues"), F.col("n"))
    frames = [
        facts(df).select(F.inline(size)),
        issues.agg(F.count("*").alias("n")).select(count.alias("l")).select("l.*"),
        last.select(shown.alias("l")).select("l.*"),
    ]
    if AGENCY in df.columns:
        frames.append(_ranked("top_agencies", top_by_count(df, AGENCY, 5), "name", "records"))
    if YEAR in df.columns:
        frames.append(_years(df))
    return union_all(frames)
