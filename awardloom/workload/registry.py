"""Registered queries, one or more per operator. Each reads its whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import EngineConfig
from ..functions import casts, dates, text
from ..operators import conform, dedup, filters, monitor, planning, profile, reports, sketches, validate
from ..plans import incremental, transform
from ..schema import AWARD_KEYS, AWARD_TYPE_GROUPS, BOOLEAN_COLUMNS, DATE_COLUMNS, TEXT_COLUMNS, q
from ..session import fresh_dir, put_text, size_of, stored
from ..sources import documents, history, landing, manifest, sinks
from ..streaming import pages as pages_stream
from . import bindings
from . import staging as S

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters shared by the queries and their SQL.
AS_OF_DATE = dt.date(2001, 8, 2)
AS_OF_TIME = dt.datetime(2024, 1, 31)
FIRST_DAY, LAST_DAY = dt.date(1995, 1, 1), dt.date(2001, 8, 1)
STRICT = EngineConfig(
    fiscal_year_limits=(1996, 2000), min_dollars_limit=-50000, max_dollars_limit=100000
)
FILTERS = {
    "fiscal_year_range": (1996, 2000),
    "min_dollars_obligated": 1000,
    "instrument_types": ["DELIVERY ORDER", "DEFINITIVE CONTRACT"],
    "agencies": ["NATION_1", "NATION_2", "NATION_3", "NATION_5", "NATION_8"],
}
LIGHT_FILTERS = {k: FILTERS[k] for k in ("fiscal_year_range", "min_dollars_obligated")}
KEEP = ("source_file", "row_order")
SPECS = ["ASIA", "funding:EUROPE", "NATION_3|AMERICA", " Funding: NATION_7 | AFRICA "]
SHARD_GROUPS = ["contracts", "loans", "no_such_group"]
SPLIT_WINDOWS, SPLIT_ROWS = (3, 28, 92, 400), 170
REPULL_DAYS = 90
#: A shard's first day, from which on everything is pulled again.
REPULL_FROM = FIRST_DAY + dt.timedelta(days=20 * REPULL_DAYS)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles in the result, so that every engine prints them alike."""
    return df.select(
        *[
            q(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else q(f.name)
            for f in df.schema.fields
        ]
    )


def conformed(spark: SparkSession, sf: str) -> DataFrame:
    return conform.conform(S.awards_raw(spark, sf), S.CONFIG, keep=KEEP)


def conformed_once(spark: SparkSession, sf: str) -> DataFrame:
    """For a query that passes over some of the columns once."""
    return conform.conform(S.awards_raw_once(spark, sf), S.CONFIG, keep=KEEP)


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return conform.clean(conformed(spark, sf), S.CONFIG)


def cleaned_once(spark: SparkSession, sf: str) -> DataFrame:
    return conform.clean(conformed_once(spark, sf), S.CONFIG)


def _source_columns(raw: DataFrame) -> list[str]:
    return [c for c in raw.columns if c not in KEEP]


# -- sources and sinks --------------------------------------------------------


def _two_orders(raw: DataFrame) -> list[DataFrame]:
    """The raw rows in two parts whose files order their columns differently."""
    columns = [*_source_columns(raw), "row_key"]
    raw = raw.withColumnRenamed("row_order", "row_key")
    low = F.col("modification_number") <= "3"
    return [raw.filter(low).select(*columns), raw.filter(~low).select(*reversed(columns))]


def landed(spark: SparkSession, sf: str, fmt: str) -> str:
    def write(path: str) -> None:
        with S.awards_raw_passing(spark, sf) as raw:
            for name, part in zip(("low", "high"), _two_orders(raw)):
                sinks.write_table(part, f"{path}/{name}", fmt, packed=True)

    return S.staged(spark, sf, f"landed_{fmt}", write)


def _scan_back(spark: SparkSession, sf: str, fmt: str) -> DataFrame:
    found = landing.scan_landing(spark, landed(spark, sf, fmt), (fmt,))
    rows = dedup.union_all(found.groups)
    return rows.drop(*landing_keys())


def landing_keys() -> tuple[str, str]:
    return landing.SOURCE_FILE, landing.ROW_ORDER


@query
def scan_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return _scan_back(spark, sf, "csv")


@query
def scan_tsv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return _scan_back(spark, sf, "tsv")


@query
def scan_parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return _scan_back(spark, sf, "parquet")


@query
def landing_to_parquet(spark: SparkSession, sf: str) -> DataFrame:
    out = fresh_dir(spark, "converted")
    sinks.landing_to_parquet(spark, landed(spark, sf, "tsv"), out)
    return spark.read.parquet(out).drop(*landing_keys())


def hostile_landing(spark: SparkSession, sf: str) -> str:
    """A landing as they come: odd file names, two column orders, a typed Parquet file beside text, line breaks
    and quotes in text, rows landed twice, and files that are empty, ragged, foreign or no files of their kind.

    Every award has a key of its own, so rows landed twice are the only duplicates.
    """

    def write(path: str) -> None:
        with S.awards_raw_passing(spark, sf) as raw:
            rows(path, raw)

    def rows(path: str, raw: DataFrame) -> None:
        text, mod = F.col("transaction_description"), F.col("modification_number")
        raw = raw.withColumn("award_id_piid", F.concat(F.lit("PIID-"), "row_order"))
        raw = raw.withColumn(
            "transaction_description",
            F.when(mod == "2", F.concat(text, F.lit('\nsecond "line", end'))).when(mod == "3", F.concat(text, F.lit(' 5" pipe'))).otherwise(text),
        )
        columns = _source_columns(raw)
        part = lambda *mods: raw.filter(mod.isin(*mods)).select(*columns)
        sinks.write_table(part("1", "2"), f"{path}/low [0]", "csv", packed=True)
        sinks.write_table(part("3", "4").select(*reversed(columns)), f"{path}/high 50%25 off", "csv", packed=True)
        sinks.write_table(part("6", "7"), f"{path}/with space (1)", "csv", packed=True)
        sinks.write_table(part("7"), f"{path}/{{again}}", "csv", packed=True)
        sinks.write_table(part("5").withColumn("modification_number", F.lit(5).cast("bigint")), f"{path}/typed+", "parquet")
        head = ",".join(columns)
        for name, content in {
            "empty.csv": "", "header only.csv": head + "\n", "ragged.csv": head + "\n" + "," * len(columns) + "\n",
            "other.csv": "x,y\n1,2\n", "broken [1].parquet": "this is not parquet",
        }.items():
            put_text(spark, f"{path}/odd/{name}", content)

    return S.staged(spark, sf, "landed_hostile", write)


def _hostile_run(spark: SparkSession, sf: str, fmt: str) -> transform.Outcome:
    cfg = EngineConfig(output_format=fmt)
    return transform.process_landing(spark, hostile_landing(spark, sf), fresh_dir(spark, "processed"), "run", cfg)


@query
def process_landing_run(spark: SparkSession, sf: str) -> DataFrame:
    return plain(landing.read_processed(spark, _hostile_run(spark, sf, "parquet").awards_path))


@query
def process_landing_csv(spark: SparkSession, sf: str) -> DataFrame:
    return plain(landing.read_processed(spark, _hostile_run(spark, sf, "csv").awards_path))


@query
def process_landing_issues(spark: SparkSession, sf: str) -> DataFrame:
    """Records by rule, and the files that could not be used."""
    report = _hostile_run(spark, sf, "parquet").report_path
    issues = spark.read.schema("severity string, rule string, issue_count bigint").json(f"{report}/issues")
    return issues.filter("rule <> 'missing_column'").groupBy("severity", "rule").agg(
        F.sum("issue_count").alias("records"), F.count_if(F.col("rule") == "load").alias("files")
    )


@query
def process_landing_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Every different issue of a folder's files, or of an odd file, with # for numbers."""
    report = _hostile_run(spark, sf, "parquet").report_path
    issues = spark.read.schema("source_file string, severity string, rule string, message string").json(f"{report}/issues")
    steps = F.split("source_file", "/")
    folder, name = F.element_at(steps, -2), F.element_at(steps, -1)
    message = F.regexp_replace("message", "[0-9]+", "#")
    # What a Parquet reader says of a file that is none is its own.
    message = F.regexp_replace(message, r"(Failed to load file [^:]*\.parquet:).*", "$1")
    return issues.select(F.when(folder == "odd", name).otherwise(folder).alias("place"), "severity", "rule", message.alias("message")).distinct()


@query
def awards_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Files of two column orders, taken in one at a time."""
    out, progress = fresh_dir(spark, "awards-stream"), fresh_dir(spark, "progress")
    rows = pages_stream.ingest_awards(spark, landed(spark, sf, "csv"), out, progress, files_per_batch=1)
    return plain(rows.drop(*landing_keys()))


@query
def landed_file_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """The odd landing as it is: line breaks, empty, ragged and broken files, other headers."""
    files = landing.inventory(landing.scan_landing(spark, hostile_landing(spark, sf)))
    return files.groupBy(
        F.element_at(F.split("path", "/"), -2).alias("folder"), "format", "column_count"
    ).agg(
        F.sum("row_count").alias("rows"),
        F.count_if(~F.col("readable")).alias("unreadable_files"),
        F.count_if(F.col("is_empty")).alias("empty_files"),
    )


@query
def processed_csv_analysis(spark: SparkSession, sf: str) -> DataFrame:
    path = S.staged(
        spark, sf, "processed.csv", lambda p: sinks.write_table(S.awards(spark, sf), p + ".csv", "csv", packed=True)
    )
    return plain(landing.read_processed(spark, path + ".csv"))


@query
def quality_report_json(spark: SparkSession, sf: str) -> DataFrame:
    awards = S.awards(spark, sf)
    issues = transform.prepare([S.awards_raw(spark, sf)], S.CONFIG).issues
    out = sinks.write_quality_report(
        profile.column_profiles(awards), issues, profile.summary_stats(awards), fresh_dir(spark, "quality")
    )
    wanted = (
        "ord int, column_name string, data_type string, null_count bigint, null_percentage double, "
        "unique_count bigint, unique_percentage double, min double, max double, mean double, "
        "median double, avg_length double, max_length bigint"
    )
    return spark.read.schema(wanted).json(f"{out}/profiles")


@query
def quality_report_issues(spark: SparkSession, sf: str) -> DataFrame:
    """The issues and the summary of the same report, read back."""
    awards = S.awards(spark, sf)
    issues = transform.prepare([S.awards_raw(spark, sf)], S.CONFIG).issues
    summary = profile.summary_stats(awards)
    out = sinks.write_quality_report(summary.select("column_name"), issues, summary, fresh_dir(spark, "quality"))
    found = spark.read.schema("severity string, rule string, issue_count bigint").json(f"{out}/issues")
    columns = spark.read.schema("column_name string, data_type string, null_count bigint, total_rows bigint").json(f"{out}/summary")
    counted = found.groupBy("rule", "severity").agg(F.sum("issue_count").alias("n"), F.count("*").alias("of"))
    return columns.select(F.lit("summary").alias("part"), F.col("column_name").alias("name"), F.col("data_type").alias("kind"), F.col("null_count").alias("n"), F.col("total_rows").alias("of")).unionByName(
        counted.select(F.lit("issues").alias("part"), F.col("rule").alias("name"), F.col("severity").alias("kind"), "n", "of")
    )


@query
def search_pages_explode(spark: SparkSession, sf: str) -> DataFrame:
    return documents.flatten_pages(S.search_pages(spark, sf))


@query
def search_pages_stream(spark: SparkSession, sf: str) -> DataFrame:
    pages = S.staged_path(spark, sf, "search_pages", S.search_pages)
    return pages_stream.ingest_pages(spark, pages, fresh_dir(spark, "ingested"), fresh_dir(spark, "progress"))


@query
def incremental_partitions(spark: SparkSession, sf: str) -> DataFrame:
    rows = incremental.shard_rows(
        S.awards_predicate(spark, sf), SHARD_GROUPS, FIRST_DAY, LAST_DAY, "awarding_toptier", chunk_days=90
    )
    out = incremental.write_shards(rows, fresh_dir(spark, "shards"))
    # Partition values are read as text; otherwise labels that look like dates would be typed.
    back = spark.read.schema(
        "order_key bigint, amount decimal(20,2), award_group string, shard string, agency_slug string"
    ).parquet(out)
    return plain(
        back.groupBy("award_group", "shard", "agency_slug").agg(
            F.count("*").alias("row_count"), F.sum("amount").alias("amount")
        )
    )


def _repull_rows(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.shard_rows(S.awards_predicate(spark, sf), SHARD_GROUPS, FIRST_DAY, LAST_DAY, "awarding_toptier", REPULL_DAYS)


@query
def incremental_repull(spark: SparkSession, sf: str) -> DataFrame:
    """Shards after a pull of everything, a later one of the newest shards, in which rows have changed, gone, or all gone from
    a shard, and one that was never committed."""
    path, keys = fresh_dir(spark, "shard-table"), list(incremental.PARTITION_KEYS)
    kinds = "order_key bigint, part_key bigint, action_date date, awarding_toptier string, amount decimal(20,2)"
    rows = _repull_rows(spark, sf).select(*[c.split()[0] for c in kinds.split(", ")], *keys)
    agencies = [r.r_name for r in S.table(spark, sf, "region").select("r_name").collect()]
    bounds = spark.createDataFrame([(FIRST_DAY, LAST_DAY)], "first_day date, last_day date")
    planned = incremental.planned_shards(bounds, ["contracts", "loans"], agencies, REPULL_DAYS)
    manifest.pull_shards(rows, planned, path, keys)
    late = rows.filter((F.col("action_date") >= F.lit(REPULL_FROM)) & (F.col("part_key") % 5 != 0) & (F.col("awarding_toptier") != "ASIA"))
    late = late.withColumn("amount", F.when(F.col("order_key") % 3 == 0, F.col("amount") + 1).otherwise(F.col("amount")).cast("decimal(20,2)"))
    again = planned.filter(F.col("shard_start") >= F.lit(REPULL_FROM))
    manifest.pull_shards(late, again, path, keys)
    manifest.write_pull(late.filter("order_key % 2 = 0"), again, path, keys)  # cut short
    back = manifest.read_shards(spark, path, keys, kinds).groupBy(*keys).agg(F.count("*").alias("row_count"), F.sum("amount").alias("amount"))
    shards = manifest.current_shards(spark, path, keys)
    return plain(shards.join(back, keys, "left").select(*keys, F.col("rows").alias("logged_rows"), F.coalesce("row_count", F.lit(0)).alias("row_count"), "amount"))


@query
def awards_merge(spark: SparkSession, sf: str) -> DataFrame:
    """The history after two pulls that overlap: of an award that both have, the later pull's row."""
    rows = conform.clean(conform.conform(dedup.placed(S.awards_raw(spark, sf)), S.CONFIG, keep=(*KEEP, *dedup.PLACE)), S.CONFIG)
    mod = q("Modification Number")
    later = rows.filter(mod >= "4").withColumn("Dollars Obligated", (q("Dollars Obligated") * 2).cast("decimal(20,2)"))
    size = size_of(spark, S.staged_path(spark, sf, "awards_raw", S.awards_raw))
    buckets, order = history.buckets_for(size, 8), ["row_order"]
    first = history.create([rows.filter(mod <= "5")], fresh_dir(spark, "history"), AWARD_KEYS, order, buckets)
    schema = spark.read.parquet(first).schema.toDDL()
    out = history.merge(spark, first, schema, [later], fresh_dir(spark, "history"), AWARD_KEYS, order, buckets)
    return plain(spark.read.parquet(out).drop(history.KEY, "source_file"))


@query
def profile_merged(spark: SparkSession, sf: str) -> DataFrame:
    """The profile of all rows from sketches kept for every file, and whether the estimates are within their stated errors."""
    rows = cleaned(spark, sf).drop("row_order")
    kept = stored(sketches.column_sketches(rows, ["source_file"]), "sketches")
    merged = stored(sketches.estimates(sketches.merge_sketches(kept)), "profile")
    rows = rows.drop("source_file")
    medians = {r.column_name: r.median_estimate for r in merged.filter("median_estimate is not null").select("column_name", "median_estimate").collect()}
    value = lambda c: q(c).cast("double")
    share = lambda c, x: F.count_if(x) / F.count(q(c))
    met = lambda c, m: (share(c, value(c) < m) <= 0.5 + sketches.RANK_ERROR) & (share(c, value(c) <= m) >= 0.5 - sketches.RANK_ERROR)
    near = rows.agg(F.array(*[F.struct(F.lit(c).alias("column_name"), met(c, m).alias("median_near")) for c, m in medians.items()]).alias("x")).select(F.inline("x"))
    distinct = profile.profile_distinct(rows).select("column_name", "unique_count")
    error = F.abs(F.col("distinct_estimate") - F.col("unique_count")) <= 1 + sketches.DISTINCT_ERROR * F.col("unique_count")
    out = merged.join(distinct, "column_name").join(near, "column_name", "left")
    return plain(out.select("column_name", "row_count", "null_count", "total", "least", "most", "text_length", F.col("longest").cast("bigint").alias("longest"), error.alias("distinct_near"), "median_near"))


# -- projection and typing ----------------------------------------------------


@query
def conform_columns(spark: SparkSession, sf: str) -> DataFrame:
    return conformed(spark, sf)


@query
def conform_missing_columns(spark: SparkSession, sf: str) -> DataFrame:
    raw = S.awards_raw_once(spark, sf).drop("award_type", "women_owned_small_business")
    rows = conform.clean(conform.conform(raw, S.CONFIG, keep=KEEP), S.CONFIG)
    return rows.select(
        "row_order", "Instrument Type", "Last Date to Order",
        q(BOOLEAN_COLUMNS[-1]).alias("women_owned"), "Modification Number",
    )


@query
def missing_column_issues(spark: SparkSession, sf: str) -> DataFrame:
    return conform.missing_column_issues(S.awards_raw_once(spark, sf).drop("award_type"), S.CONFIG)


@query
def select_fields(spark: SparkSession, sf: str) -> DataFrame:
    wanted = ["Award ID", "Recipient Name", "Award Amount", "Start Date", "Not A Field"]
    return conform.select_fields(S.awards_search(spark, sf), wanted)


@query
def clean_dates(spark: SparkSession, sf: str) -> DataFrame:
    return cleaned_once(spark, sf).select("row_order", *[q(c) for c in DATE_COLUMNS])


@query
def clean_numerics(spark: SparkSession, sf: str) -> DataFrame:
    rows = cleaned_once(spark, sf)
    return plain(rows.select("row_order", *[q(c) for c in S.CONFIG.numeric_columns]))


@query
def clean_booleans(spark: SparkSession, sf: str) -> DataFrame:
    return cleaned_once(spark, sf).select("row_order", *[q(c) for c in BOOLEAN_COLUMNS])


@query
def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    return cleaned_once(spark, sf).select("row_order", *[q(c) for c in TEXT_COLUMNS])


@query
def safe_slug(spark: SparkSession, sf: str) -> DataFrame:
    label = F.concat_ws(" / ", "recipient_name", "funding_agency_name", F.concat(F.lit("("), "transaction_description", F.lit(")")))
    return S.awards_raw_once(spark, sf).select("row_order", text.safe_slug(label).alias("slug"))


@query
def compact_ts(spark: SparkSession, sf: str) -> DataFrame:
    return S.table(spark, sf, "events").select("event_id", dates.compact_ts(F.col("ts")).alias("run_id"))


@query
def agency_spec_parse(spark: SparkSession, sf: str) -> DataFrame:
    return filters.parse_agency_specs(S.view(spark, sf, bindings.AGENCY_SPECS))


# -- filters ------------------------------------------------------------------

FILTER_COLUMNS = ["row_order", "PIID", "Fiscal Year", "Dollars Obligated", "Instrument Type", "Funding Agency Name"]


def _filtered(spark: SparkSession, sf: str, names: Sequence[str]) -> DataFrame:
    chosen = {k: FILTERS[k] for k in names}
    return filters.apply_filters(conformed_once(spark, sf), chosen).select(*[q(c) for c in FILTER_COLUMNS])


@query
def filter_fiscal_year(spark: SparkSession, sf: str) -> DataFrame:
    return _filtered(spark, sf, ["fiscal_year_range"])


@query
def filter_min_dollars(spark: SparkSession, sf: str) -> DataFrame:
    return _filtered(spark, sf, ["min_dollars_obligated"])


@query
def filter_instrument_type(spark: SparkSession, sf: str) -> DataFrame:
    return _filtered(spark, sf, ["instrument_types"])


@query
def filter_agency(spark: SparkSession, sf: str) -> DataFrame:
    return _filtered(spark, sf, ["agencies"])


@query
def filter_combined(spark: SparkSession, sf: str) -> DataFrame:
    merged = filters.merge_filters({**FILTERS, "min_dollars_obligated": 5}, {"min_dollars_obligated": 1000})
    return filters.apply_filters(conformed_once(spark, sf), merged).select(*[q(c) for c in FILTER_COLUMNS])


@query
def filter_typed_pushdown(spark: SparkSession, sf: str) -> DataFrame:
    """The same filters on the processed table, where they reach the Parquet scan."""
    rows = S.awards(spark, sf).filter(
        q("Fiscal Year").between(*FILTERS["fiscal_year_range"])
        & (q("Dollars Obligated") >= FILTERS["min_dollars_obligated"])
        & q("Instrument Type").isin(*FILTERS["instrument_types"])
        & q("Funding Agency Name").isin(*FILTERS["agencies"])
    )
    return plain(rows.select("PIID", "Modification Number", "Date Signed", "Fiscal Year", "Dollars Obligated"))


@query
def filter_accounting(spark: SparkSession, sf: str) -> DataFrame:
    return filters.filter_accounting(conformed_once(spark, sf), FILTERS, by=["source_file"])


@query
def bulk_predicate(spark: SparkSession, sf: str) -> DataFrame:
    rows = filters.bulk_request(
        S.awards_predicate(spark, sf), ["contracts", "loans"], dt.date(1996, 3, 1), dt.date(1999, 6, 30),
        "last_modified_date", SPECS,
    )
    return plain(rows)


@query
def award_group_lookup(spark: SparkSession, sf: str) -> DataFrame:
    rows = filters.with_award_group(S.awards_predicate(spark, sf))
    return rows.select("order_key", "line_number", "part_key", "supplier_key", "award_type_code", "award_group")


@query
def unknown_groups(spark: SparkSession, sf: str) -> DataFrame:
    return filters.unknown_codes(S.awards_predicate(spark, sf))


@query
def agency_semi_filter(spark: SparkSession, sf: str) -> DataFrame:
    return plain(filters.agency_filter(S.awards_predicate(spark, sf), SPECS))


@query
def agency_filter_specs(spark: SparkSession, sf: str) -> DataFrame:
    """The same with a frame of specs, a spec for every supplier and customer."""
    specs = filters.parse_agency_specs(S.view(spark, sf, bindings.AGENCY_SPECS))
    return plain(filters.agency_filter(S.awards_predicate(spark, sf), specs))


@query
def search_page(spark: SparkSession, sf: str) -> DataFrame:
    rows = filters.search_request(
        S.awards_predicate(spark, sf), filters.codes_of(["contracts"]), dt.date(1995, 6, 1), dt.date(2000, 12, 31), "ASIA"
    )
    return plain(filters.search_page(rows, 2, ["order_key", "line_number", "part_key", "supplier_key"]))


@query
def search_drain(spark: SparkSession, sf: str) -> DataFrame:
    rows = filters.search_request(
        S.awards_predicate(spark, sf), filters.codes_of(["contracts"]), FIRST_DAY, LAST_DAY
    ).select("order_key", "line_number", "part_key", "supplier_key", "amount")
    ties = ["order_key", "line_number", "part_key", "supplier_key"]
    return plain(filters.number_pages(rows, fresh_dir(spark, "drain"), ties))


@query
def search_page_deep(spark: SparkSession, sf: str) -> DataFrame:
    """A late page by way of the page index."""
    ties = ["order_key", "line_number", "part_key", "supplier_key"]
    rows = filters.search_request(S.awards_predicate(spark, sf), filters.codes_of(["contracts"]), FIRST_DAY, LAST_DAY).select(*ties, "amount")
    stage = filters.index_pages(rows, fresh_dir(spark, "pages"), ties)
    return plain(filters.indexed_page(spark, stage, 11, 100))


def _window(spark: SparkSession, sf: str, mode: str, days: int = 30) -> DataFrame:
    orders = S.table(spark, sf, "orders")
    picked = filters.relative_window(orders, "o_orderdate", mode, AS_OF_DATE, days)
    return picked.select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_orderstatus")


@query
def window_daily(spark: SparkSession, sf: str) -> DataFrame:
    return _window(spark, sf, "daily")


@query
def window_weekly(spark: SparkSession, sf: str) -> DataFrame:
    return _window(spark, sf, "weekly")


@query
def window_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return _window(spark, sf, "monthly")


@query
def window_backfill(spark: SparkSession, sf: str) -> DataFrame:
    return _window(spark, sf, "backfill", 365)


# -- validation ---------------------------------------------------------------


@query
def validate_required(spark: SparkSession, sf: str) -> DataFrame:
    return validate.validate_required(conformed_once(spark, sf), STRICT, ["source_file"])


@query
def validate_fiscal_year(spark: SparkSession, sf: str) -> DataFrame:
    return validate.validate_fiscal_year(conformed_once(spark, sf), STRICT, ["source_file"])


@query
def validate_min_dollars(spark: SparkSession, sf: str) -> DataFrame:
    return validate.validate_min_dollars(conformed_once(spark, sf), STRICT.min_dollars_limit, ["source_file"])


@query
def validate_max_dollars(spark: SparkSession, sf: str) -> DataFrame:
    return validate.validate_max_dollars(conformed_once(spark, sf), STRICT.max_dollars_limit, ["source_file"])


@query
def coercion_loss_dates(spark: SparkSession, sf: str) -> DataFrame:
    kept = filters.apply_filters(conformed_once(spark, sf), LIGHT_FILTERS)
    return validate.coercion_loss_dates(kept, STRICT, ["source_file"])


@query
def coercion_loss_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return validate.coercion_loss_numeric(conformed_once(spark, sf), STRICT, ["source_file"])


def _issues(spark: SparkSession, sf: str) -> DataFrame:
    return validate.issue_log(
        conformed(spark, sf), STRICT, LIGHT_FILTERS, "source_file",
        validate.absent_columns(S.awards_raw(spark, sf), STRICT),
    )


@query
def issue_log(spark: SparkSession, sf: str) -> DataFrame:
    return _issues(spark, sf)


# -- union and dedup ----------------------------------------------------------


@query
def union_files(spark: SparkSession, sf: str) -> DataFrame:
    first, second = _two_orders(S.awards_raw(spark, sf))
    return dedup.union_all([first.drop("award_type"), second])


@query
def dedup_awards(spark: SparkSession, sf: str) -> DataFrame:
    return plain(dedup.dedup_awards(cleaned(spark, sf), ["row_order"]).drop("source_file"))


@query
def dedup_minimal(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.dedup_search(S.awards_search(spark, sf), ["row_order"])


@query
def dedup_partial_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Duplicates by those keys of the list that the rows have."""
    return dedup.dedup_search(S.awards_search(spark, sf).drop("Last Modified Date"), ["row_order"])


@query
def write_guard(spark: SparkSession, sf: str) -> DataFrame:
    """What a run writes for each of two selections: nothing, not even a folder, where no row is left."""
    rows, out = S.awards(spark, sf), fresh_dir(spark, "guarded")
    found = []
    for name, years in (("orders", "`Fiscal Year` <= 2000"), ("future", "`Fiscal Year` > 2100")):
        path = sinks.write_run_table(rows.filter(years), out, name, "run")
        n = spark.read.parquet(path).agg(F.count("*").alias("n")) if path else spark.range(1).select(F.lit(0).cast("bigint").alias("n"))
        found.append(n.select(F.lit(name).alias("selection"), F.lit(path is not None).alias("written"), "n"))
    return dedup.union_all(found)


@query
def ledger_append(spark: SparkSession, sf: str) -> DataFrame:
    """Runs by status after one run, still open, was appended to the ledger."""
    path = fresh_dir(spark, "ledger")
    S.run_ledger(spark, sf).select("run_id", "status").write.json(path)
    step = sinks.step_entry("SUCCESS", "2024-02-01T00:00:00", {"rows": 1})
    sinks.append_run(
        spark, path,
        {"run_id": "appended", "start_time": "2024-02-01T00:00:00", "status": "RUNNING", "steps": {"download": step}, "errors": [], "output_files": []},
    )
    runs = documents.good(documents.read_runs(spark, path))
    return runs.groupBy("status").agg(F.count("*").alias("runs"), F.count("end_time").alias("with_end"), F.count_if(F.col("run_id") == "appended").alias("appended"))


@query
def dedup_accounting(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.dedup_accounting(cleaned(spark, sf), AWARD_KEYS)


# -- profiles and reports -----------------------------------------------------


def _on_awards(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf: plain(build(S.awards(spark, sf)))


_on_awards("summary_stats", profile.summary_stats)
_on_awards("profile_nulls", profile.profile_nulls)
_on_awards("profile_distinct", profile.profile_distinct)
_on_awards("profile_numeric", profile.profile_numeric)
_on_awards("profile_text", profile.profile_text)
_on_awards("missing_data_ranked", reports.missing_data_ranked)
_on_awards("completeness_score", reports.completeness)
_on_awards("basic_stats", reports.basic_stats)
_on_awards("fiscal_year_distribution", reports.fiscal_year_distribution)
_on_awards("dollar_stats", reports.dollar_stats)
_on_awards("top_agencies_count", lambda df: reports.top_by_count(df, reports.AGENCY, 10))
_on_awards("top_agencies_dollars", lambda df: reports.top_by_dollars(df, reports.AGENCY, 10))
_on_awards("contract_type_distribution", reports.contract_type_distribution)
_on_awards("contract_type_value", reports.contract_type_value)
_on_awards("small_business_participation", reports.small_business_participation)
_on_awards("small_business_dollars", reports.small_business_dollars)
_on_awards("top_vendors_count", lambda df: reports.top_by_count(df, reports.VENDOR, 10))
_on_awards("top_vendors_dollars", lambda df: reports.top_by_dollars(df, reports.VENDOR, 10))
_on_awards("report_long", reports.report)


@query
def report_text(spark: SparkSession, sf: str) -> DataFrame:
    """The written report, read back line by line."""
    path = sinks.write_report_text(reports.report(S.awards(spark, sf)), fresh_dir(spark, "report"))
    return spark.read.text(path).withColumnRenamed("value", "line")


@query
def etl_summary(spark: SparkSession, sf: str) -> DataFrame:
    issues = dedup.union_all(
        [_issues(spark, sf), validate.duplicate_issue(dedup.dedup_accounting(cleaned(spark, sf), AWARD_KEYS))]
    )
    return reports.run_summary(S.awards(spark, sf), issues)


# -- planning -----------------------------------------------------------------


def _order_span(spark: SparkSession, sf: str) -> DataFrame:
    return S.table(spark, sf, "orders").agg(
        F.to_date(F.min("o_orderdate")).alias("first_day"), F.to_date(F.max("o_orderdate")).alias("last_day")
    )


@query
def plan_shards(spark: SparkSession, sf: str) -> DataFrame:
    return planning.plan_shards(_order_span(spark, sf), list(AWARD_TYPE_GROUPS), ["ASIA", "EUROPE"])


@query
def split_ranges(spark: SparkSession, sf: str) -> DataFrame:
    daily = planning.daily_counts(S.table(spark, sf, "orders"), "o_orderdate")
    # Ranges of mixed length, which overlap.
    whole = dedup.union_all([planning.windows(_order_span(spark, sf), days) for days in SPLIT_WINDOWS]).select(
        F.col("shard_start").alias("range_start"), F.col("shard_end").alias("range_end")
    )
    return planning.split_until(whole, daily, SPLIT_ROWS)


@query
def shard_counts(spark: SparkSession, sf: str) -> DataFrame:
    rows = filters.with_award_group(S.awards_predicate(spark, sf))
    return planning.shard_counts(planning.with_shard(rows, "action_date", FIRST_DAY, LAST_DAY), ["award_group"])


@query
def period_availability(spark: SparkSession, sf: str) -> DataFrame:
    rows = S.awards_predicate(spark, sf).filter(F.col("award_type_code").isin(*filters.codes_of(["contracts"])))
    periods = spark.createDataFrame(bindings.PERIODS, "period string, range_start date, range_end date")
    return planning.period_availability(periods, planning.daily_counts(rows, "action_date"))


@query
def date_gaps(spark: SparkSession, sf: str) -> DataFrame:
    first, last = dates.window_bounds("backfill", AS_OF_DATE, (AS_OF_DATE - FIRST_DAY).days)
    return planning.date_gaps(S.table(spark, sf, "orders"), "o_orderdate", first, last)


@query
def missing_shards(spark: SparkSession, sf: str) -> DataFrame:
    """What is to be pulled again, from the labels of landed shards of two lengths, which overlap."""
    rows = S.awards_predicate(spark, sf)
    month = F.month("action_date")
    short = rows.filter((F.col("part_key") % 3 != 0) & ~month.isin(2, 7))
    long = rows.filter((month == 7) & (F.col("supplier_key") % 2 == 0))
    parts = [incremental.shard_rows(r, SHARD_GROUPS, FIRST_DAY, LAST_DAY, "awarding_toptier", n) for r, n in ((short, 7), (long, 28))]
    keys = ["award_group", "agency_slug"]
    landed = planning.parse_spans(dedup.union_all([p.select(*keys, "shard").distinct() for p in parts]))
    regions = S.table(spark, sf, "region").select(text.safe_slug(F.col("r_name")).alias("agency_slug"))
    wanted = regions.select("agency_slug", F.explode(F.array(F.lit("contracts"), F.lit("loans"))).alias("award_group")).withColumns(
        {"first_day": F.lit(FIRST_DAY), "last_day": F.lit(LAST_DAY)}
    )
    return planning.repull_list(planning.missing_spans(wanted, landed, keys), keys)


@query
def range_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of every range from an order's date to a month, a quarter, a year and ten years later: as many ranges as orders."""
    orders = S.table(spark, sf, "orders")
    day = F.to_date("o_orderdate")
    lengths = F.element_at(F.array(*[F.lit(n) for n in (29, 89, 364, 3651)]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    ranges = orders.select("o_orderkey", F.date_sub(day, 400).alias("range_start"), F.date_add(F.date_sub(day, 400), lengths).alias("range_end"))
    return planning.count_ranges(ranges, planning.daily_counts(orders, "o_orderdate"))


@query
def month_bucket(spark: SparkSession, sf: str) -> DataFrame:
    orders = planning.month_buckets(S.table(spark, sf, "orders"), "o_orderdate")
    out = sinks.write_partitions(orders.select("o_orderkey", "o_totalprice", "month"), fresh_dir(spark, "months"), ["month"])
    back = spark.read.schema("o_orderkey bigint, o_totalprice double, month string").parquet(out)
    return plain(
        back.groupBy("month").agg(
            F.count("*").alias("row_count"),
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"),
        )
    )


# -- monitoring ---------------------------------------------------------------


def _recent(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.recent_runs(S.run_ledger(spark, sf), AS_OF_TIME, 7)


@query
def runs_recent(spark: SparkSession, sf: str) -> DataFrame:
    return _recent(spark, sf).select("run_id", "status", "start_time", "end_time")


@query
def runs_newest(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.newest(_recent(spark, sf), 10).select("run_id", "status", "start_time")


@query
def run_success_rate(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.success_rate(_recent(spark, sf))


@query
def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    out = sinks.export_metrics(monitor.run_metrics(S.run_ledger(spark, sf)), fresh_dir(spark, "metrics"))
    kinds = (
        "run_id string, status string, start_time string, end_time string, duration_minutes double, "
        "successful_steps int, failed_steps int, total_errors int, output_files int"
    )
    return spark.read.schema(kinds).option("header", True).csv(out)


@query
def run_errors_head(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.error_heads(_recent(spark, sf))


@query
def run_steps_detail(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.run_details(monitor.newest(_recent(spark, sf), 3)).drop("started_at")


@query
def run_summary_text(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.summary_text(S.run_ledger(spark, sf))


@query
def dq_latest(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.latest_report(S.quality_reports(spark, sf), AS_OF_TIME).select(
        "processing_timestamp",
        F.col("summary_statistics.total_rows").alias("total_rows"),
        F.col("summary_statistics.total_columns").alias("total_columns"),
        F.size("data_quality_issues").alias("issues"),
    )


@query
def dq_issue_counts(spark: SparkSession, sf: str) -> DataFrame:
    recent = monitor.recent_reports(S.quality_reports(spark, sf), AS_OF_TIME)
    return monitor.issue_counts(monitor.issue_rows(recent, "processing_timestamp"), "processing_timestamp")


@query
def dq_issue_rows(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.issue_rows(S.quality_reports(spark, sf), "processing_timestamp")


@query
def dq_last_issues(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.last_issues(monitor.latest_report(S.quality_reports(spark, sf), AS_OF_TIME))


@query
def dq_column_completeness(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.incomplete_columns(monitor.latest_report(S.quality_reports(spark, sf), AS_OF_TIME))
