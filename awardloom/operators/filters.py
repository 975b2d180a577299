"""Row filters: award filters, request predicates, agency specs and award-type groups."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import casts, dates
from ..functions.text import agency_spec
from ..schema import AWARD_TYPE_GROUPS, SEARCH_PAGE_SIZE, q
from ..session import put_text, stored

AGENCY = "Funding Agency Name"

# Marks rows whose funding agency is listed.
LISTED = "_agency_listed"

#: Listed agencies up to which they are a condition too.
FEW_NAMES = 100


def fiscal_year_between(first: int, last: int) -> Column:
    return casts.to_amount(q("Fiscal Year").cast("string")).between(first, last)


def dollars_at_least(minimum) -> Column:
    return casts.to_amount(q("Dollars Obligated").cast("string")) >= F.lit(minimum)


def member_of(column: str, values: Sequence[str]) -> Column:
    return q(column).isin(*values)


def merge_filters(defaults: Mapping[str, Any] | None, custom: Mapping[str, Any] | None) -> dict[str, Any]:
    """Defaults overridden key by key; null entries mean "no filter"."""
    merged = {**(defaults or {}), **(custom or {})}
    return {k: v for k, v in merged.items() if v is not None}


def local_names(spark: SparkSession, names: Sequence[str], column: str) -> DataFrame:
    """Distinct names as a local relation: Spark knows its size and broadcasts it only if that is small."""
    return spark.createDataFrame(pa.table({column: pa.array(list(dict.fromkeys(names)), pa.string())}))


def mark_listed(df: DataFrame, filters: Mapping[str, Any]) -> DataFrame:
    """Add the mark that ``keep_predicate`` looks at, if the filters list agencies.

    A list of any length is joined, by equality on distinct names, so no row is multiplied.
    """
    agencies = filters.get("agencies")
    if agencies is None or AGENCY not in df.columns:
        return df
    names = local_names(df.sparkSession, agencies, AGENCY).withColumn(LISTED, F.lit(True))
    return df.join(names, AGENCY, "left").select(*[q(c) for c in df.columns], LISTED)


def _conditions(columns: Sequence[str], filters: Mapping[str, Any]) -> list[Column]:
    found = []
    if "fiscal_year_range" in filters and "Fiscal Year" in columns:
        found.append(fiscal_year_between(*filters["fiscal_year_range"]))
    if "min_dollars_obligated" in filters and "Dollars Obligated" in columns:
        found.append(dollars_at_least(filters["min_dollars_obligated"]))
    if "instrument_types" in filters and "Instrument Type" in columns:
        found.append(member_of("Instrument Type", filters["instrument_types"]))
    if LISTED in columns:
        found.append(F.col(LISTED))
    return found


def keep_predicate(columns: Sequence[str], filters: Mapping[str, Any]) -> Column:
    """Conjunction of the filters whose column exists; true or false, never null. Takes marked rows."""
    found = _conditions(columns, filters)
    if not found:
        return F.lit(True)
    return F.coalesce(reduce(lambda a, b: a & b, found), F.lit(False))


def apply_filters(df: DataFrame, filters: Mapping[str, Any]) -> DataFrame:
    """Filter conformed (still untyped) rows; listed agencies are a semi join.

    Spark moves that join no further than to where the agency is named, but a condition below joins and to scans: a few names
    are one as well.
    """
    found = _conditions(df.columns, filters)
    out = df.filter(reduce(lambda a, b: a & b, found)) if found else df
    if filters.get("agencies") is None or AGENCY not in df.columns:
        return out
    if len(filters["agencies"]) <= FEW_NAMES:
        out = out.filter(member_of(AGENCY, filters["agencies"]))
    names = local_names(df.sparkSession, filters["agencies"], AGENCY)
    return out.join(names, AGENCY, "left_semi").select(*[q(c) for c in df.columns])


def filter_accounting(df: DataFrame, filters: Mapping[str, Any], by: Sequence[str] = ()) -> DataFrame:
    """Rows before and after the filters, from one pass."""
    df = mark_listed(df, filters)
    keep = keep_predicate(df.columns, filters)
    counts = df.groupBy(*by).agg(
        F.count("*").alias("rows_before"), F.count_if(keep).alias("rows_after")
    )
    return counts.withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def recent(df: DataFrame, column: str, as_of: dt.datetime, days: int) -> DataFrame:
    """Rows stamped at or after ``as_of`` minus ``days``."""
    return df.filter(q(column) >= F.lit(as_of - dt.timedelta(days=days)))


def relative_window(
    df: DataFrame, column: str, mode: str, as_of: dt.date, backfill_days: int = 30
) -> DataFrame:
    return df.filter(dates.in_days(q(column), *dates.window_bounds(mode, as_of, backfill_days)))


# -- request predicates -----------------------------------------------------


def award_groups(spark: SparkSession) -> DataFrame:
    """The fixed group/code table (a few dozen rows)."""
    rows = [(g, code) for g, codes in AWARD_TYPE_GROUPS.items() for code in codes]
    return spark.createDataFrame(rows, "award_group string, award_type_code string")


def codes_of(groups: Sequence[str]) -> list[str]:
    """Codes of the known groups; unknown names are skipped."""
    return [code for g in groups for code in AWARD_TYPE_GROUPS.get(g, ())]


def with_award_group(df: DataFrame, code_column: str = "award_type_code") -> DataFrame:
    """Attach the group of each award type code; rows of no group drop out.

    The broadcast side is the fixed code table, so its size does not grow with the data.
    """
    groups = award_groups(df.sparkSession).withColumnRenamed("award_type_code", code_column)
    return df.join(F.broadcast(groups), code_column, "inner")


def unknown_codes(df: DataFrame, code_column: str = "award_type_code") -> DataFrame:
    """Codes that belong to no group, with their row counts (counted before the anti join)."""
    groups = award_groups(df.sparkSession).withColumnRenamed("award_type_code", code_column)
    counts = df.groupBy(code_column).agg(F.count("*").alias("row_count"))
    return counts.join(F.broadcast(groups), code_column, "left_anti")


def parse_agency_specs(specs: DataFrame, column: str = "spec", default_type: str = "awarding") -> DataFrame:
    return specs.withColumn("agency", agency_spec(q(column), default_type)).select("*", "agency.*").drop("agency")


def agency_filter(
    df: DataFrame, specs: Sequence[str] | DataFrame, default_type: str = "awarding"
) -> DataFrame:
    """Rows that meet at least one agency spec; no spec, as a list or a frame, means no filter.

    ``df`` has awarding/funding toptier and subtier columns. Their different combinations, of which there are few, are
    found once; all specs, whether a list or a frame of parsed ones, are decided on those; and the rows meet the
    combinations that pass in one join. Specs are joined to combinations by type and tier on equality. The passing
    combinations are a stored table, so Spark knows its size: it is sent to the rows if small, and a hot combination
    of a shuffled join is split otherwise.
    """
    if not isinstance(specs, DataFrame):
        if not specs:
            return df
        specs = parse_agency_specs(local_names(df.sparkSession, specs, "spec"), default_type=default_type)
    else:
        specs = stored(specs.select("type", "tier", "name", "toptier_name").distinct(), "agency-specs")
        if specs.isEmpty():
            return df
    hits = stored(passing_combinations(df.select(*AGENCY_COLUMNS).distinct(), specs), "agency-combinations")
    there = reduce(lambda x, y: x & y, [F.col(f"r.{c}").eqNullSafe(F.col(f"h.{c}")) for c in AGENCY_COLUMNS])
    return df.alias("r").join(hits.alias("h"), there, "left_semi")


#: The columns that agency specs are about.
AGENCY_COLUMNS = ("awarding_toptier", "awarding_subtier", "funding_toptier", "funding_subtier")


def passing_combinations(combinations: DataFrame, specs: DataFrame) -> DataFrame:
    """The combinations of ``AGENCY_COLUMNS`` that meet at least one parsed spec."""
    marks, out = [], combinations
    for kind in ("awarding", "funding"):
        for tier, keys in (("toptier", [f"{kind}_toptier"]), ("subtier", [f"{kind}_subtier", f"{kind}_toptier"])):
            chosen = specs.filter((F.col("type") == kind) & (F.col("tier") == tier))
            names = chosen.select(*[F.col(n).alias(k) for n, k in zip(("name", "toptier_name"), keys)]).distinct()
            marks.append(f"_{kind}_{tier}")
            out = out.join(names.withColumn(marks[-1], F.lit(True)), keys, "left")
    return out.filter(F.coalesce(*[F.col(m) for m in marks], F.lit(False))).select(*combinations.columns)


def bulk_request(
    df: DataFrame,
    groups: Sequence[str],
    first: dt.date,
    last: dt.date,
    date_type: str = "action_date",
    specs: Sequence[str] | DataFrame = (),
) -> DataFrame:
    """Bulk-download predicate: award codes, one chosen date column in range, optional agencies."""
    if date_type not in ("action_date", "last_modified_date"):
        raise ValueError(f"unknown date type: {date_type}")
    rows = df.filter(F.col("award_type_code").isin(*codes_of(groups or ["contracts"]))).filter(
        dates.in_days(F.col(date_type), first, last)
    )
    return agency_filter(rows, specs)


def search_request(
    df: DataFrame, codes: Sequence[str], first: dt.date, last: dt.date, awarding_agency: str | None = None
) -> DataFrame:
    """Search predicate: codes, period and optionally one awarding top-tier agency."""
    rows = df.filter(F.col("award_type_code").isin(*codes)).filter(
        dates.in_days(F.col("action_date"), first, last)
    )
    return rows.filter(F.col("awarding_toptier") == awarding_agency) if awarding_agency else rows


def search_page(
    rows: DataFrame, page: int, tie_break: Sequence[str], page_size: int = SEARCH_PAGE_SIZE
) -> DataFrame:
    """One page, largest amount first, with the page number and a has-next flag.

    One row more than the page is fetched, and tells whether there is a next page: no second scan.
    """
    order = [F.col("amount").desc(), *[q(c) for c in tie_break]]
    found = rows.orderBy(*order).offset(page_size * (page - 1)).limit(page_size + 1)
    all_found = Window.orderBy(*order)  # over at most a page and a row
    ranked = found.withColumn("_rank", F.row_number().over(all_found)).withColumn(
        "has_next", F.count("*").over(Window.partitionBy(F.lit(1))) > page_size
    )
    return ranked.filter(F.col("_rank") <= page_size).withColumn("page", F.lit(page)).select(
        *[q(c) for c in rows.columns], "page", "has_next"
    )


def index_pages(rows: DataFrame, stage: str, tie_break: Sequence[str]) -> str:
    """Write the sorted result to ``stage`` once, so that any page is a seek: the rows in folders by part, each with its line
    there, and beside them a small table of the parts with their bounds, rows and the rows before them.

    The rows are range-partitioned, so no task sorts the whole result; ``tie_break`` should make the order unique.
    """
    spark = rows.sparkSession
    order = [F.col("amount").desc(), *[q(c) for c in tie_break]]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # The generated id holds the partition in its upper bits and the row in the lower 33.
    fresh = F.monotonically_increasing_id()
    numbered = ordered.withColumn("_id", fresh).select(*[q(c) for c in rows.columns], F.shiftright("_id", 33).cast("int").alias("_part"), F.col("_id").bitwiseAND(F.lit(2**33 - 1)).alias("_line"))
    numbered.write.partitionBy("_part").parquet(f"{stage}/rows")
    put_text(spark, f"{stage}/schema", numbered.schema.json())  # a result without rows leaves no file to take it from
    kept = _indexed_rows(spark, stage)
    largest = F.struct("amount", *[q(c) for c in tie_break])
    sizes = kept.groupBy("_part").agg(F.count("*").alias("rows"), F.min_by(largest, "_line").alias("first"), F.max_by(largest, "_line").alias("last"))
    before = F.sum("rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))  # a row a part
    sizes.withColumn("before", F.coalesce(before, F.lit(0))).write.parquet(f"{stage}/index")
    return stage


def _indexed_rows(spark: SparkSession, stage: str) -> DataFrame:
    schema = spark.read.text(f"{stage}/schema", wholetext=True).first().value
    return spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(f"{stage}/rows")


def indexed_page(spark: SparkSession, stage: str, page: int, page_size: int = SEARCH_PAGE_SIZE) -> DataFrame:
    """One page of an indexed result, with its number and a has-next flag: reads the parts and lines it lies in only.

    The index has a row a part; the parts of the page are looked up in it first. A page beyond the end has no rows.
    """
    start, end = page_size * (page - 1), page_size * page
    parts = spark.read.parquet(f"{stage}/index").select("_part", "rows", "before").collect()
    total = sum(r.rows for r in parts)
    met = [r for r in parts if r.before < end and r.before + r.rows > start]
    lines = [(F.col("_part") == r["_part"]) & F.col("_line").between(max(0, start - r.before), end - r.before - 1) for r in met]
    rows = _indexed_rows(spark, stage)
    found = rows.filter(reduce(lambda x, y: x | y, lines)) if lines else rows.filter(F.lit(False))
    return found.drop("_part", "_line").withColumns({"page": F.lit(page), "has_next": F.lit(total > end)})


def number_pages(
    rows: DataFrame, stage: str, tie_break: Sequence[str], page_size: int = SEARCH_PAGE_SIZE
) -> DataFrame:
    """Every row with its page, as a full drain of the pages would return them.

    A rank over the whole result would sort it in one task. Instead the rows are range-partitioned
    once, numbered inside their partition and written to ``stage`` (a path in the shared folder, so
    the partitioning is fixed even when executors are lost). A row's rank is then its local number
    plus the sizes of the partitions before it, of which there are only as many as partitions.
    ``tie_break`` should make the order unique; many rows of one amount then still spread.
    """
    spark = rows.sparkSession
    order = [F.col("amount").desc(), *[q(c) for c in tie_break]]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # The generated id holds the partition in its upper bits and the row in the lower 33.
    ordered.withColumn("_id", F.monotonically_increasing_id()).write.parquet(stage)
    kept = spark.read.parquet(stage).withColumn("_part", F.shiftright("_id", 33))
    sizes = kept.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    rank = F.col("_before") + F.col("_id").bitwiseAND(F.lit(2**33 - 1))
    return (
        kept.join(F.broadcast(offsets), "_part")
        .withColumn("page", F.floor(rank / page_size) + 1)
        .select(*[q(c) for c in rows.columns], "page")
    )
