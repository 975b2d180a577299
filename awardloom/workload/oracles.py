"""The registered queries as plain SQL over the driver tables, written on their own.

Each text starts from the same fixture views as the Spark side and states the result directly
(windows, exact medians, recursive unions), sharing no operator code with it.
"""

from __future__ import annotations

import re

from ..config import EngineConfig
from . import bindings
from .bindings import ansi

CONFIG = EngineConfig()

ORACLES: dict[str, str] = {}

RAW = f"awards_raw AS ({ansi(bindings.AWARDS_RAW)})"
SEARCH = f"{RAW}, awards_search AS ({ansi(bindings.AWARDS_SEARCH)})"
PREDICATE = f"awards_predicate AS ({ansi(bindings.AWARDS_PREDICATE)})"
RUNS = f"runs_raw AS ({ansi(bindings.RUNS_RAW)})"

FLAG = "Is Vendor Business Type - "
FLAG_SOURCES = {
    "8A Program Participant": "c8a_program_participant",
    "Economically Disadvantaged Women-Owned Small Business": "economically_disadvantaged_women_owned_small_business",
    "HUBZone Firm": "historically_underutilized_business_zone_hubzone_firm",
    "Self-Certified Small Disadvantaged Business": "self_certified_small_disadvantaged_business",
    "Service-Disabled Veteran-Owned Business": "service_disabled_veteran_owned_business",
    "Veteran-Owned Business": "veteran_owned_business",
    "Women-Owned Small Business": "women_owned_small_business",
}
BASE = "Base and All Options Value (Total Contract Value)"
SIZE = "Contracting Officers Business Size Determination"
TEXTS = {
    "PIID": "award_id_piid",
    "AAC": "awarding_agency_code",
    "Legal Business Name": "recipient_name",
    "Contracting Office Name": "awarding_office_name",
    "Funding Agency Name": "funding_agency_name",
    "Description of Requirement": "transaction_description",
}
UNTOUCHED = {
    "Instrument Type": "award_type",
    "Referenced IDV PIID": "parent_award_id_piid",
    "Modification Number": "modification_number",
    SIZE: "contracting_officers_determination_of_business_size",
}
NUMBER = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"


def amount(x: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({x}), '{NUMBER}') THEN CAST(trim({x}) AS DECIMAL(20,2)) END"


def flag(x: str) -> str:
    return (
        f"CASE WHEN {x} IN ('Y','YES','True','1','t','T') THEN true "
        f"WHEN {x} IN ('N','NO','False','0','f','F') THEN false END"
    )


def strip(x: str) -> str:
    return f"nullif(regexp_replace({x}, '^\\s+|\\s+$', '', 'g'), 'nan')"


def percent(part: str, whole: str) -> str:
    return f"round(({part}) * 100.0 / ({whole}), 4)"


def register(name: str, body: str, *views: str) -> None:
    ctes = ",\n".join(views)
    ORACLES[name] = (f"WITH {ctes}\n" if ctes else "") + body.strip()


# The conformed rows (text, business headers).
_conformed = [f'action_date_fiscal_year AS "Fiscal Year"']
_conformed += [f'{src} AS "{dst}"' for dst, src in {**TEXTS, **UNTOUCHED}.items()]
_conformed += [
    'action_date AS "Date Signed"',
    'period_of_performance_current_end_date AS "Est. Ultimate Completion Date"',
    'CAST(NULL AS VARCHAR) AS "Last Date to Order"',
    'federal_action_obligation AS "Dollars Obligated"',
    f'base_and_all_options_value AS "{BASE}"',
]
_conformed += [f'{src} AS "{FLAG}{short}"' for short, src in FLAG_SOURCES.items()]
CONFORMED = f"{RAW}, conformed AS (SELECT {', '.join(_conformed)}, source_file, row_order FROM awards_raw)"

_typed = [f'CAST({amount(chr(34) + "Fiscal Year" + chr(34))} AS INTEGER) AS "Fiscal Year"']
_typed += [f"""{strip(f'"{c}"')} AS "{c}" """ for c in TEXTS]
_typed += [f'"{c}"' for c in UNTOUCHED]
_typed += [
    f'TRY_CAST("{c}" AS DATE) AS "{c}"'
    for c in ("Date Signed", "Est. Ultimate Completion Date", "Last Date to Order")
]
_typed += [f"""{amount(f'"{c}"')} AS "{c}" """ for c in ("Dollars Obligated", BASE)]
_typed += [f"""{flag(f'"{FLAG}{s}"')} AS "{FLAG}{s}" """ for s in FLAG_SOURCES]
CLEANED = f"{CONFORMED}, cleaned AS (SELECT {', '.join(_typed)}, source_file, row_order FROM conformed)"

AWARDS = f"""{CLEANED}, awards AS (
  SELECT * EXCLUDE (source_file, row_order) FROM cleaned
  QUALIFY row_number() OVER (PARTITION BY "PIID", "Modification Number", "Date Signed" ORDER BY row_order) = 1)"""

AS_DOUBLE = f'"Dollars Obligated"::DOUBLE AS "Dollars Obligated", "{BASE}"::DOUBLE AS "{BASE}"'

# -- sources and sinks --------------------------------------------------------

# A text file cannot tell these spellings of "missing" from a real null.
ROUND_TRIP = """
SELECT * EXCLUDE (source_file, row_order, federal_action_obligation),
  CASE WHEN federal_action_obligation NOT IN ('N/A', 'nan') THEN federal_action_obligation END AS federal_action_obligation,
  row_order AS row_key
FROM awards_raw"""
for _name in ("scan_csv_roundtrip", "scan_tsv_roundtrip", "landing_to_parquet"):
    register(_name, ROUND_TRIP, RAW)
register("scan_parquet_roundtrip", "SELECT * EXCLUDE (source_file, row_order), row_order AS row_key FROM awards_raw", RAW)
# The landing of odd files: keys of their own, line breaks and quotes in text. Text files lose two spellings of "missing".
HOSTILE = """hostile AS (SELECT * REPLACE (
  'PIID-' || row_order AS award_id_piid,
  transaction_description || CASE modification_number WHEN '2' THEN chr(10) || 'second "line", end' WHEN '3' THEN ' 5" pipe' ELSE '' END AS transaction_description,
  CASE WHEN modification_number = '5' OR federal_action_obligation NOT IN ('N/A', 'nan') THEN federal_action_obligation END AS federal_action_obligation
) FROM awards_raw)"""
HOSTILE_CLEANED = CLEANED.replace(RAW, f"{RAW}, {HOSTILE}", 1).replace("row_order FROM awards_raw)", "row_order FROM hostile)", 1)
for _name in ("process_landing_run", "process_landing_csv"):
    register(_name, f'SELECT * EXCLUDE (source_file, row_order, "Dollars Obligated", "{BASE}"), {AS_DOUBLE} FROM cleaned', HOSTILE_CLEANED)
register("awards_stream", f'SELECT * EXCLUDE (source_file, row_order, "Dollars Obligated", "{BASE}"), {AS_DOUBLE} FROM cleaned', CLEANED)
register(
    "landed_file_inventory",
    """
SELECT folder, CASE folder WHEN 'typed+' THEN 'parquet' ELSE 'csv' END AS format, 22 AS column_count, count(*)::BIGINT AS "rows",
  0::BIGINT AS unreadable_files, 0::BIGINT AS empty_files
FROM awards_raw, (VALUES ('low [0]', '1'), ('low [0]', '2'), ('high 50%25 off', '3'), ('high 50%25 off', '4'), ('typed+', '5'),
  ('with space (1)', '6'), ('with space (1)', '7'), ('{again}', '7')) f(folder, modification) WHERE modification_number = modification GROUP BY folder
UNION ALL SELECT * FROM (VALUES ('odd', 'csv', 0, NULL, 1, 1), ('odd', 'csv', 22, 0, 1, 0), ('odd', 'csv', 2, 1, 0, 0), ('odd', 'parquet', 0, NULL, 1, 0))""",
    RAW,
)
register(
    "processed_csv_analysis",
    f'SELECT * EXCLUDE ("Dollars Obligated", "{BASE}"), {AS_DOUBLE} FROM awards',
    AWARDS,
)
for _name in ("search_pages_explode", "search_pages_stream"):
    register(_name, "SELECT * EXCLUDE (row_order) FROM awards_search", SEARCH)

GROUPS = """award_groups(award_group, award_type_code) AS (VALUES
  ('contracts','A'), ('contracts','B'), ('contracts','C'), ('contracts','D'), ('loans','07'), ('loans','08'),
  ('idvs','IDV_A'), ('idvs','IDV_B'), ('idvs','IDV_B_A'), ('idvs','IDV_B_B'), ('idvs','IDV_B_C'),
  ('idvs','IDV_C'), ('idvs','IDV_D'), ('idvs','IDV_E'), ('grants','02'), ('grants','03'), ('grants','04'),
  ('grants','05'), ('other_fin_ast','06'), ('other_fin_ast','10'), ('direct_payments','09'),
  ('direct_payments','11'), ('direct_payments','-1'))"""


def shard_start(days: int) -> str:
    return f"(DATE '1995-01-01' + CAST(floor((action_date - DATE '1995-01-01') / {days}.0) * {days} AS INTEGER))"


register(
    "incremental_partitions",
    f"""
SELECT award_group,
  strftime({shard_start(90)}, '%Y-%m-%d') || '_to_' ||
    strftime(least({shard_start(90)} + 89, DATE '2001-08-01'), '%Y-%m-%d') AS shard,
  replace(awarding_toptier, ' ', '_') AS agency_slug,
  count(*) AS row_count, CAST(sum(amount) AS DOUBLE) AS amount
FROM awards_predicate JOIN award_groups USING (award_type_code)
WHERE award_group IN ('contracts', 'loans') AND action_date BETWEEN DATE '1995-01-01' AND DATE '2001-08-01'
GROUP BY ALL""",
    PREDICATE,
    GROUPS,
)

_repull_shard = f"""strftime({shard_start(90)}, '%Y-%m-%d') || '_to_' || strftime(least({shard_start(90)} + 89, DATE '2001-08-01'), '%Y-%m-%d')"""
REPULLED = "DATE '1995-01-01' + 1800"
register(
    "incremental_repull",
    f"""
SELECT award_group, shard, agency_slug, count(amount) AS logged_rows, count(amount) AS row_count, CAST(sum(amount) AS DOUBLE) AS amount
FROM planned LEFT JOIN (
  SELECT award_group, {_repull_shard} AS shard, replace(awarding_toptier, ' ', '_') AS agency_slug,
    CASE WHEN action_date >= {REPULLED} AND order_key % 3 = 0 THEN amount + 1 ELSE amount END AS amount
  FROM awards_predicate JOIN award_groups USING (award_type_code)
  WHERE action_date BETWEEN DATE '1995-01-01' AND DATE '2001-08-01' AND NOT (action_date >= {REPULLED} AND (part_key % 5 = 0 OR awarding_toptier = 'ASIA'))
) USING (award_group, shard, agency_slug) GROUP BY ALL""",
    PREDICATE,
    GROUPS,
    """planned AS (
  SELECT g AS award_group, replace(r_name, ' ', '_') AS agency_slug,
    strftime(d, '%Y-%m-%d') || '_to_' || strftime(least(d + 89, DATE '2001-08-01'), '%Y-%m-%d') AS shard
  FROM (SELECT DATE '1995-01-01' + CAST(90 * i AS INTEGER) AS d FROM range(0, (DATE '2001-08-01' - DATE '1995-01-01') // 90 + 1) r(i)), (VALUES ('contracts'), ('loans')) t(g), region)""",
)
register(
    "awards_merge",
    f"""
SELECT * EXCLUDE (pull, source_file, "Dollars Obligated", "{BASE}"), {AS_DOUBLE} FROM (
  SELECT *, 1 AS pull FROM cleaned WHERE "Modification Number" <= '5'
  UNION ALL SELECT * REPLACE ("Dollars Obligated" * 2 AS "Dollars Obligated"), 2 FROM cleaned WHERE "Modification Number" >= '4'
) QUALIFY row_number() OVER (PARTITION BY "PIID", "Modification Number", "Date Signed" ORDER BY pull DESC, row_order) = 1""",
    CLEANED,
)

# -- projection and typing ----------------------------------------------------

register("conform_columns", "SELECT * FROM conformed", CONFORMED)
register(
    "conform_missing_columns",
    """
SELECT row_order, CAST(NULL AS VARCHAR) AS "Instrument Type", CAST(NULL AS DATE) AS "Last Date to Order",
  CAST(NULL AS BOOLEAN) AS women_owned, modification_number AS "Modification Number"
FROM awards_raw""",
    RAW,
)
register(
    "missing_column_issues",
    """
SELECT source_file, m.severity, m.source_column, m.target_column,
  'Missing column: ' || m.source_column || ' -> ' || m.target_column AS message
FROM (SELECT DISTINCT source_file FROM awards_raw) f,
  (VALUES ('ERROR', 'award_type', 'Instrument Type'),
          ('WARNING', 'ordering_period_end_date', 'Last Date to Order')) m(severity, source_column, target_column)""",
    RAW,
)
register("select_fields", 'SELECT "Award ID", "Recipient Name", "Award Amount", "Start Date" FROM awards_search', SEARCH)
register(
    "clean_dates",
    'SELECT row_order, "Date Signed", "Est. Ultimate Completion Date", "Last Date to Order" FROM cleaned',
    CLEANED,
)
register("clean_numerics", f'SELECT row_order, "Fiscal Year", {AS_DOUBLE} FROM cleaned', CLEANED)
register("clean_booleans", f"SELECT row_order, COLUMNS('{FLAG}.*') FROM cleaned", CLEANED)
register("clean_text", "SELECT row_order, " + ", ".join(f'"{c}"' for c in TEXTS) + " FROM cleaned", CLEANED)
register(
    "safe_slug",
    r"""
SELECT row_order, trim(regexp_replace(
  concat_ws(' / ', recipient_name, funding_agency_name, '(' || transaction_description || ')'),
  '[^A-Za-z0-9_.-]+', '_', 'g'), '_') AS slug
FROM awards_raw""",
    RAW,
)
register("compact_ts", "SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS run_id FROM events")
register(
    "agency_spec_parse",
    r"""
SELECT spec_id, spec, type, CASE WHEN contains(body, '|') THEN 'subtier' ELSE 'toptier' END AS tier,
  CASE WHEN contains(body, '|') THEN trim(regexp_extract(body, '^([^|]*)\|', 1)) ELSE body END AS name,
  CASE WHEN contains(body, '|') THEN trim(regexp_extract(body, '^[^|]*\|(.*)$', 1)) END AS toptier_name
FROM (SELECT spec_id, spec,
    CASE WHEN regexp_matches(trim(spec), '^(?i)funding:') THEN 'funding' ELSE 'awarding' END AS type,
    trim(regexp_replace(trim(spec), '^(?i)(funding|awarding):', '')) AS body FROM specs)""",
    f"specs AS ({ansi(bindings.AGENCY_SPECS)})",
)

# -- filters ------------------------------------------------------------------

FY, DOLLARS = amount('"Fiscal Year"'), amount('"Dollars Obligated"')
CONDITIONS = {
    "filter_fiscal_year": f"{FY} BETWEEN 1996 AND 2000",
    "filter_min_dollars": f"{DOLLARS} >= 1000",
    "filter_instrument_type": "\"Instrument Type\" IN ('DELIVERY ORDER', 'DEFINITIVE CONTRACT')",
    "filter_agency": "\"Funding Agency Name\" IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_5', 'NATION_8')",
}
ALL_FILTERS = " AND ".join(f"({c})" for c in CONDITIONS.values())
FILTER_COLUMNS = 'row_order, "PIID", "Fiscal Year", "Dollars Obligated", "Instrument Type", "Funding Agency Name"'
for _name, _condition in {**CONDITIONS, "filter_combined": ALL_FILTERS}.items():
    register(_name, f"SELECT {FILTER_COLUMNS} FROM conformed WHERE {_condition}", CONFORMED)
register(
    "filter_typed_pushdown",
    """
SELECT "PIID", "Modification Number", "Date Signed", "Fiscal Year", "Dollars Obligated"::DOUBLE AS "Dollars Obligated"
FROM awards WHERE "Fiscal Year" BETWEEN 1996 AND 2000 AND "Dollars Obligated" >= 1000
  AND "Instrument Type" IN ('DELIVERY ORDER', 'DEFINITIVE CONTRACT')
  AND "Funding Agency Name" IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_5', 'NATION_8')""",
    AWARDS,
)
register(
    "filter_accounting",
    f"""
SELECT source_file, count(*) AS rows_before, count(*) FILTER (WHERE {ALL_FILTERS}) AS rows_after,
  count(*) - count(*) FILTER (WHERE {ALL_FILTERS}) AS rows_removed
FROM conformed GROUP BY source_file""",
    CONFORMED,
)

AGENCY_MATCH = """(awarding_toptier = 'ASIA' OR funding_toptier = 'EUROPE'
  OR (awarding_subtier = 'NATION_3' AND awarding_toptier = 'AMERICA')
  OR (funding_subtier = 'NATION_7' AND funding_toptier = 'AFRICA'))"""
PREDICATE_ROWS = "SELECT * EXCLUDE (amount), CAST(amount AS DOUBLE) AS amount FROM awards_predicate"
register(
    "bulk_predicate",
    f"""{PREDICATE_ROWS} WHERE award_type_code IN ('A', 'B', 'C', 'D', '07', '08')
  AND last_modified_date BETWEEN DATE '1996-03-01' AND DATE '1999-06-30' AND {AGENCY_MATCH}""",
    PREDICATE,
)
register("agency_semi_filter", f"{PREDICATE_ROWS} WHERE {AGENCY_MATCH}", PREDICATE)
register(
    "agency_filter_specs",
    f"""{PREDICATE_ROWS} WHERE EXISTS (FROM parsed WHERE
  (tier = 'toptier' AND name = CASE type WHEN 'funding' THEN funding_toptier ELSE awarding_toptier END) OR
  (tier = 'subtier' AND name = CASE type WHEN 'funding' THEN funding_subtier ELSE awarding_subtier END AND toptier_name = CASE type WHEN 'funding' THEN funding_toptier ELSE awarding_toptier END))""",
    PREDICATE,
    ORACLES["agency_spec_parse"].replace("WITH ", "", 1).replace("SELECT spec_id, spec, type,", "parsed AS (SELECT DISTINCT type,", 1).replace(")\nparsed", "),\nparsed", 1) + ")",
)
register(
    "award_group_lookup",
    """
SELECT order_key, line_number, part_key, supplier_key, award_type_code, award_group
FROM awards_predicate JOIN award_groups USING (award_type_code)""",
    PREDICATE,
    GROUPS,
)
register(
    "unknown_groups",
    """
SELECT award_type_code, count(*) AS row_count FROM awards_predicate
WHERE award_type_code NOT IN (SELECT award_type_code FROM award_groups) GROUP BY 1""",
    PREDICATE,
    GROUPS,
)
register(
    "search_page",
    """
SELECT * EXCLUDE (amount), CAST(amount AS DOUBLE) AS amount, 2 AS page, (SELECT count(*) FROM found) > 1000 AS has_next
FROM (SELECT * FROM found ORDER BY found.amount DESC, order_key, line_number, part_key, supplier_key LIMIT 500 OFFSET 500)""",
    PREDICATE,
    """found AS (SELECT * FROM awards_predicate WHERE award_type_code IN ('A', 'B', 'C', 'D')
  AND action_date BETWEEN DATE '1995-06-01' AND DATE '2000-12-31' AND awarding_toptier = 'ASIA')""",
)
register(
    "search_drain",
    """
SELECT order_key, line_number, part_key, supplier_key, CAST(amount AS DOUBLE) AS amount,
  (row_number() OVER (ORDER BY awards_predicate.amount DESC, order_key, line_number, part_key, supplier_key) - 1) // 500 + 1 AS page
FROM awards_predicate WHERE award_type_code IN ('A', 'B', 'C', 'D')
  AND action_date BETWEEN DATE '1995-01-01' AND DATE '2001-08-01'""",
    PREDICATE,
)
register(
    "search_page_deep",
    """
SELECT * EXCLUDE (amount), CAST(amount AS DOUBLE) AS amount, 11 AS page, (SELECT count(*) FROM found) > 1100 AS has_next
FROM (SELECT order_key, line_number, part_key, supplier_key, amount FROM found ORDER BY found.amount DESC, order_key, line_number, part_key, supplier_key LIMIT 100 OFFSET 1000)""",
    PREDICATE,
    """found AS (SELECT * FROM awards_predicate WHERE award_type_code IN ('A', 'B', 'C', 'D') AND action_date BETWEEN DATE '1995-01-01' AND DATE '2001-08-01')""",
)
for _name, _first in {
    "window_daily": "2001-08-01",
    "window_weekly": "2001-07-26",
    "window_monthly": "2001-07-03",
    "window_backfill": "2000-08-02",
}.items():
    register(
        _name,
        f"""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderstatus FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{_first}' AND DATE '2001-08-01'""",
    )

# -- validation ---------------------------------------------------------------

register(
    "validate_required",
    """
SELECT source_file, field, null_count FROM (
  SELECT source_file, count(*) FILTER (WHERE "PIID" IS NULL) AS "PIID",
    count(*) FILTER (WHERE "Fiscal Year" IS NULL) AS "Fiscal Year",
    count(*) FILTER (WHERE "Legal Business Name" IS NULL) AS "Legal Business Name"
  FROM conformed GROUP BY source_file)
UNPIVOT (null_count FOR field IN ("PIID", "Fiscal Year", "Legal Business Name"))""",
    CONFORMED,
)


def per_file(alias: str, condition: str) -> str:
    return f"SELECT source_file, count(*) FILTER (WHERE {condition}) AS {alias} FROM conformed GROUP BY source_file"


YEAR_OUT = f"({FY} < 1996 OR {FY} > 2000)"
register("validate_fiscal_year", per_file("invalid_count", YEAR_OUT), CONFORMED)
register("validate_min_dollars", per_file("below_count", f"{DOLLARS} < -50000"), CONFORMED)
register("validate_max_dollars", per_file("above_count", f"{DOLLARS} > 100000"), CONFORMED)

KEPT = f"(coalesce({FY} BETWEEN 1996 AND 2000, false) AND coalesce({DOLLARS} >= 1000, false))"
DATES = ("Date Signed", "Est. Ultimate Completion Date", "Last Date to Order")
NUMBERS = ("Fiscal Year", "Dollars Obligated", BASE)


def lost(c: str) -> str:
    return f"""("{c}" IS NOT NULL AND ({amount(f'"{c}"')}) IS NULL)"""


register(
    "coercion_loss_dates",
    "\nUNION ALL\n".join(
        f"""SELECT source_file, '{c}' AS column_name, count(*) FILTER (WHERE TRY_CAST("{c}" AS DATE) IS NULL) AS invalid_count
FROM conformed WHERE {KEPT} GROUP BY source_file"""
        for c in DATES
    ),
    CONFORMED,
)
register(
    "coercion_loss_numeric",
    "\nUNION ALL\n".join(
        f"""SELECT source_file, '{c}' AS column_name, count(*) FILTER (WHERE {lost(c)}) AS invalid_count
FROM conformed GROUP BY source_file"""
        for c in NUMBERS
    ),
    CONFORMED,
)

_rules = [
    ("WARNING", "required", f"\"{c}\" IS NULL", f"'Required field ''{c}'' has ' || n || ' null values'")
    for c in ("PIID", "Fiscal Year", "Legal Business Name")
]
_rules += [
    ("WARNING", "fiscal_year", YEAR_OUT, "'Found ' || n || ' records with invalid fiscal years'"),
    ("INFO", "min_dollars", f"{DOLLARS} < -50000", "'Found ' || n || ' records below minimum dollar threshold'"),
    ("INFO", "max_dollars", f"{DOLLARS} > 100000", "'Found ' || n || ' records above maximum dollar threshold'"),
    ("INFO", "filters", f"NOT {KEPT}", "'Applied filters: ' || total || ' -> ' || (total - n) || ' rows'"),
]
_rules += [
    ("WARNING", "dates", f"{KEPT} AND TRY_CAST(\"{c}\" AS DATE) IS NULL",
     f"'Column ''{c}'': ' || n || ' invalid dates converted to null'")
    for c in DATES
]
_rules += [
    ("WARNING", "numerics", f"{KEPT} AND {lost(c)}",
     f"'Column ''{c}'': ' || n || ' invalid numeric values converted to null'")
    for c in NUMBERS
]
ISSUES = (
    "issues AS (SELECT DISTINCT source_file, 0 AS ord, 'WARNING' AS severity, 'missing_column' AS rule,\n"
    "  'Missing column: ordering_period_end_date -> Last Date to Order' AS message, CAST(NULL AS BIGINT) AS issue_count\n"
    "FROM conformed"
    + "".join(
        f"""
UNION ALL SELECT source_file, {i} AS ord, '{severity}', '{rule}', {message}, n
FROM (SELECT source_file, count(*) AS total, count(*) FILTER (WHERE {condition}) AS n FROM conformed GROUP BY source_file)
WHERE n > 0"""
        for i, (severity, rule, condition, message) in enumerate(_rules, start=1)
    )
    + ")"
)
register("issue_log", "SELECT * FROM issues", CONFORMED, ISSUES)

# Under the default settings, with the rows of one file landed twice.
_landed = [
    ("WARNING", "required", f'"{c}" IS NULL') for c in ("PIID", "Fiscal Year", "Legal Business Name")
] + [
    ("WARNING", "fiscal_year", YEAR_OUT.replace("1996", "1990").replace("2000", "2030")),
    ("INFO", "min_dollars", f"{DOLLARS} < -999999999"),
]
_landed += [("WARNING", "dates", f'TRY_CAST("{c}" AS DATE) IS NULL') for c in DATES]
_landed += [("WARNING", "numerics", lost(c)) for c in NUMBERS]
register(
    "process_landing_issues",
    "SELECT severity, rule, CAST(sum(n) AS BIGINT) AS records, 0 AS files FROM ("
    + " UNION ALL ".join(f"SELECT '{s}' AS severity, '{r}' AS rule, count(*) FILTER (WHERE {c}) AS n FROM twice" for s, r, c in _landed)
    + ") WHERE n > 0 GROUP BY ALL"
    + " UNION ALL SELECT 'ERROR', 'load', NULL, 4"
    + " UNION ALL SELECT 'INFO', 'duplicates', count(*), 0 FROM hostile WHERE modification_number = '7'",
    CONFORMED.replace(RAW, f"{RAW}, {HOSTILE}", 1).replace("row_order FROM awards_raw)", "row_order FROM hostile)", 1),
    'twice AS (SELECT * FROM conformed UNION ALL SELECT * FROM conformed WHERE "Modification Number" = \'7\')',
)

_texts = {"required": "Required field '{}' has # null values", "fiscal_year": "Found # records with invalid fiscal years",
          "min_dollars": "Found # records below minimum dollar threshold", "dates": "Column '{}': # invalid dates converted to null",
          "numerics": "Column '{}': # invalid numeric values converted to null"}
_of = [*("PIID", "Fiscal Year", "Legal Business Name"), "", "", *DATES, *NUMBERS]
_quoted = lambda x: "'" + x.replace("'", "''") + "'"
_odd = [("other.csv", "ERROR" if src not in CONFIG.optional_columns else "WARNING", "missing_column", f"Missing column: {src} -> {dst}") for src, dst in CONFIG.column_mapping.items()]
_odd = [(p, s, r, re.sub("[0-9]+", "#", m)) for p, s, r, m in _odd] + [
    ("other.csv", "ERROR", "load", "No required columns found in dataset"),
    ("header only.csv", "WARNING", "missing_column", "Missing column: ordering_period_end_date -> Last Date to Order"),
    ("empty.csv", "ERROR", "load", "Failed to load file empty.csv: file is empty"),
    ("ragged.csv", "ERROR", "load", "Failed to load file ragged.csv: expected # fields, saw #"),
    ("broken [1].parquet", "ERROR", "load", "Failed to load file broken [#].parquet:"),
]
register(
    "process_landing_messages",
    "SELECT place, severity, rule, message FROM ("
    + " UNION ALL ".join(
        f"SELECT folder AS place, '{s}' AS severity, '{r}' AS rule, {_quoted(_texts[r].format(c))} AS message, count(*) FILTER (WHERE {x}) AS n FROM placed GROUP BY folder"
        for (s, r, x), c in zip(_landed, _of)
    )
    + ") WHERE n > 0 UNION ALL SELECT DISTINCT folder, 'WARNING', 'missing_column', 'Missing column: ordering_period_end_date -> Last Date to Order' FROM placed"
    + " UNION ALL SELECT NULL, 'INFO', 'duplicates', 'Removed # duplicate rows'"
    + "".join(f" UNION ALL SELECT {', '.join(map(_quoted, x))}" for x in _odd),
    CONFORMED.replace(RAW, f"{RAW}, {HOSTILE}", 1).replace("row_order FROM awards_raw)", "row_order FROM hostile)", 1),
    """placed AS (SELECT * FROM conformed JOIN (VALUES ('low [0]', '1'), ('low [0]', '2'), ('high 50%25 off', '3'), ('high 50%25 off', '4'), ('typed+', '5'),
  ('with space (1)', '6'), ('with space (1)', '7'), ('{again}', '7')) f(folder, modification) ON "Modification Number" = modification)""",
)

# -- union and dedup ----------------------------------------------------------

register(
    "union_files",
    """SELECT * EXCLUDE (source_file, row_order, award_type), row_order AS row_key,
  CASE WHEN modification_number <= '3' THEN NULL ELSE award_type END AS award_type FROM awards_raw""",
    RAW,
)
register(
    "dedup_awards",
    f"""
SELECT * EXCLUDE (source_file, "Dollars Obligated", "{BASE}"), {AS_DOUBLE} FROM cleaned
QUALIFY row_number() OVER (PARTITION BY "PIID", "Modification Number", "Date Signed" ORDER BY row_order) = 1""",
    CLEANED,
)
register(
    "dedup_minimal",
    """
SELECT * FROM awards_search QUALIFY row_number() OVER (
  PARTITION BY "Award ID", "Start Date", "End Date", "Last Modified Date" ORDER BY row_order) = 1""",
    SEARCH,
)
register(
    "dedup_partial_keys",
    """
SELECT * EXCLUDE ("Last Modified Date") FROM awards_search QUALIFY row_number() OVER (
  PARTITION BY "Award ID", "Start Date", "End Date" ORDER BY row_order) = 1""",
    SEARCH,
)
register(
    "write_guard",
    """
SELECT 'orders' AS selection, true AS written, count(*) AS n FROM awards WHERE "Fiscal Year" <= 2000
UNION ALL SELECT 'future', false, 0""",
    AWARDS,
)
register(
    "ledger_append",
    """
SELECT status, count(*) AS runs, 0 AS with_end, sum(a)::BIGINT AS appended
FROM (SELECT status, 0 AS a FROM runs_raw UNION ALL SELECT 'RUNNING', 1) GROUP BY 1""",
    RUNS,
)
register(
    "dedup_accounting",
    """
SELECT CAST(sum(n) AS BIGINT) AS rows_before, count(*) AS rows_after, CAST(sum(n) - count(*) AS BIGINT) AS rows_removed
FROM (SELECT count(*) AS n FROM cleaned GROUP BY "PIID", "Modification Number", "Date Signed")""",
    CLEANED,
)

# -- profiles -----------------------------------------------------------------

# Business headers in published order, with the stored type of each.
COLUMNS = {
    "Fiscal Year": "int", "PIID": "string", "AAC": "string", "Instrument Type": "string",
    "Referenced IDV PIID": "string", "Modification Number": "string", "Date Signed": "date",
    "Est. Ultimate Completion Date": "date", "Last Date to Order": "date", "Dollars Obligated": "decimal(20,2)",
    BASE: "decimal(20,2)", "Legal Business Name": "string", "Contracting Office Name": "string",
    "Funding Agency Name": "string", "Description of Requirement": "string", SIZE: "string",
    **{FLAG + s: "boolean" for s in FLAG_SOURCES},
}


def each(make, kinds: tuple[str, ...] = ()) -> str:
    chosen = [(i, c, t) for i, (c, t) in enumerate(COLUMNS.items()) if not kinds or t in kinds]
    return "\nUNION ALL\n".join(f"SELECT '{c}' AS column_name, {make(i, c, t)} FROM awards" for i, c, t in chosen)


NUMERIC_KINDS = ("int", "decimal(20,2)", "boolean")


def numeric_part(c: str) -> str:
    x = f'CAST("{c}" AS INTEGER)' if COLUMNS[c] == "boolean" else f'"{c}"'
    return (
        f'CAST(min({x}) AS DOUBLE) AS min, CAST(max({x}) AS DOUBLE) AS max, '
        f'round(CAST(sum({x}) AS DOUBLE) / count("{c}"), 4) AS mean, median(CAST({x} AS DOUBLE)) AS median'
    )


def text_part(c: str) -> str:
    return (
        f'round(CAST(sum(length("{c}")) AS DOUBLE) / count("{c}"), 4) AS avg_length, '
        f'CAST(max(length("{c}")) AS BIGINT) AS max_length'
    )


NONE = "CAST(NULL AS DOUBLE)"
NO_NUMBERS = f"{NONE} AS min, {NONE} AS max, {NONE} AS mean, {NONE} AS median"
NO_TEXT = f"{NONE} AS avg_length, CAST(NULL AS BIGINT) AS max_length"


def nulls(c: str) -> str:
    return f'count(*) - count("{c}")'


register(
    "summary_stats",
    each(lambda i, c, t: f"'{t}' AS data_type, {nulls(c)} AS null_count, count(*) AS total_rows, 23 AS total_columns"),
    AWARDS,
)
register(
    "profile_nulls",
    each(lambda i, c, t: f"{nulls(c)} AS null_count, {percent(nulls(c), 'count(*)')} AS null_percentage"),
    AWARDS,
)
register(
    "profile_distinct",
    each(
        lambda i, c, t: f'count(DISTINCT "{c}") AS unique_count, '
        + percent(f'count(DISTINCT "{c}")', "count(*)") + " AS unique_percentage"
    ),
    AWARDS,
)
register("profile_numeric", each(lambda i, c, t: numeric_part(c), NUMERIC_KINDS), AWARDS)
register("profile_text", each(lambda i, c, t: text_part(c), ("string",)), AWARDS)
register(
    "quality_report_json",
    each(
        lambda i, c, t: f"{i} AS ord, '{t}' AS data_type, {nulls(c)} AS null_count, "
        f"{percent(nulls(c), 'count(*)')} AS null_percentage, count(DISTINCT \"{c}\") AS unique_count, "
        + percent(f'count(DISTINCT "{c}")', "count(*)") + " AS unique_percentage, "
        + (numeric_part(c) if t in NUMERIC_KINDS else NO_NUMBERS) + ", "
        + (text_part(c) if t == "string" else NO_TEXT)
    ),
    AWARDS,
)
_exact_kinds = ("int", "decimal(20,2)")
register(
    "profile_merged",
    each(
        lambda i, c, t: f"count(*) AS row_count, {nulls(c)} AS null_count, "
        + (f'CAST(sum("{c}") AS DOUBLE) AS total, CAST(min("{c}") AS DOUBLE) AS least, CAST(max("{c}") AS DOUBLE) AS most, ' if t in _exact_kinds else "CAST(NULL AS DOUBLE) AS total, CAST(NULL AS DOUBLE) AS least, CAST(NULL AS DOUBLE) AS most, ")
        + (f'CAST(sum(length("{c}")) AS BIGINT) AS text_length, CAST(max(length("{c}")) AS BIGINT) AS longest, ' if t == "string" else "CAST(NULL AS BIGINT) AS text_length, CAST(NULL AS BIGINT) AS longest, ")
        + "true AS distinct_near, " + ("true AS median_near" if t in _exact_kinds else "CAST(NULL AS BOOLEAN) AS median_near")
    ).replace("FROM awards", "FROM cleaned"),
    CLEANED,
)
register(
    "quality_report_issues",
    "SELECT 'summary' AS part, column_name AS name, data_type AS kind, null_count AS n, total_rows AS \"of\" FROM ("
    + each(lambda i, c, t: f"'{t}' AS data_type, {nulls(c)} AS null_count, count(*) AS total_rows")
    + ") UNION ALL SELECT 'issues', rule, severity, CAST(sum(n) AS BIGINT), count(*) FROM ("
    + " UNION ALL ".join(f"SELECT '{s}' AS severity, '{r}' AS rule, count(*) FILTER (WHERE {x}) AS n FROM conformed GROUP BY source_file" for s, r, x in _landed)
    + ") WHERE n > 0 GROUP BY ALL UNION ALL SELECT 'issues', 'missing_column', 'WARNING', NULL, count(DISTINCT source_file) FROM conformed",
    AWARDS,
)
MISSING = f"""SELECT * FROM ({each(lambda i, c, t: f"{nulls(c)} AS null_count, {percent(nulls(c), 'count(*)')} AS null_percentage")})
WHERE null_count > 0"""
register("missing_data_ranked", MISSING, AWARDS)
FILLED = " + ".join(f'count("{c}")' for c in COLUMNS)
COMPLETENESS = f"""SELECT 23 * count(*) AS total_cells, 23 * count(*) - ({FILLED}) AS missing_cells,
  {percent(FILLED, '23 * count(*)')} AS completeness FROM awards"""
register("completeness_score", COMPLETENESS, AWARDS)

# -- reports ------------------------------------------------------------------

D = '"Dollars Obligated"'
BASIC = f"""SELECT count(*) AS total_records, min("Date Signed") AS first_date, max("Date Signed") AS last_date,
  23 AS total_columns FROM awards"""
YEARS = """SELECT "Fiscal Year" AS fiscal_year, count(*) AS records FROM awards
WHERE "Fiscal Year" IS NOT NULL GROUP BY 1"""
DOLLAR_STATS = f"""SELECT CAST(sum({D}) AS DOUBLE) AS total, round(CAST(sum({D}) AS DOUBLE) / count({D}), 4) AS mean,
  median(CAST({D} AS DOUBLE)) AS median, CAST(min({D}) AS DOUBLE) AS min, CAST(max({D}) AS DOUBLE) AS max FROM awards"""


def top_count(column: str, n: int) -> str:
    return f"""SELECT "{column}" AS name, count(*) AS records FROM awards WHERE "{column}" IS NOT NULL
GROUP BY 1 ORDER BY records DESC, name LIMIT {n}"""


def top_dollars(column: str, n: int) -> str:
    return f"""SELECT "{column}" AS name, CAST(coalesce(sum({D}), 0) AS DOUBLE) AS dollars FROM awards
WHERE "{column}" IS NOT NULL GROUP BY 1 ORDER BY dollars DESC, name LIMIT {n}"""


TYPES = f"""SELECT "Instrument Type" AS instrument_type, count(*) AS records,
  {percent('count(*)', '(SELECT count(*) FROM awards)')} AS percentage
FROM awards WHERE "Instrument Type" IS NOT NULL GROUP BY 1"""
TYPE_VALUES = f"""SELECT "Instrument Type" AS instrument_type, count({D}) AS records,
  CAST(coalesce(sum({D}), 0) AS DOUBLE) AS total, round(CAST(sum({D}) AS DOUBLE) / count({D}), 4) AS mean
FROM awards WHERE "Instrument Type" IS NOT NULL GROUP BY 1"""
PARTICIPATION = "\nUNION ALL\n".join(
    f"""SELECT '{s}' AS business_type, count(*) FILTER (WHERE "{FLAG}{s}") AS true_count,
  round(count(*) FILTER (WHERE "{FLAG}{s}") * 100.0 / count("{FLAG}{s}"), 4) AS percentage
FROM awards HAVING count("{FLAG}{s}") > 0"""
    for s in FLAG_SOURCES
)
FLAG_DOLLARS = "\nUNION ALL\n".join(
    f"""SELECT '{s}' AS business_type, CAST(coalesce(sum({D}) FILTER (WHERE "{FLAG}{s}"), 0) AS DOUBLE) AS dollars,
  round(CAST(coalesce(sum({D}) FILTER (WHERE "{FLAG}{s}"), 0) AS DOUBLE) * 100.0 / CAST(sum({D}) AS DOUBLE), 4) AS percentage
FROM awards"""
    for s in list(FLAG_SOURCES)[:3]
)
AGENCY, VENDOR = "Funding Agency Name", "Legal Business Name"
register("basic_stats", BASIC, AWARDS)
register("fiscal_year_distribution", YEARS, AWARDS)
register("dollar_stats", DOLLAR_STATS, AWARDS)
register("top_agencies_count", top_count(AGENCY, 10), AWARDS)
register("top_agencies_dollars", top_dollars(AGENCY, 10), AWARDS)
register("top_vendors_count", top_count(VENDOR, 10), AWARDS)
register("top_vendors_dollars", top_dollars(VENDOR, 10), AWARDS)
register("contract_type_distribution", TYPES, AWARDS)
register("contract_type_value", TYPE_VALUES, AWARDS)
register("small_business_participation", PARTICIPATION, AWARDS)
register("small_business_dollars", FLAG_DOLLARS, AWARDS)


def line(section: str, rows: str, label: str, value: str, ord_: str) -> str:
    return f"""SELECT '{section}' AS section, CAST({ord_} AS DOUBLE) AS ord, CAST({label} AS VARCHAR) AS label,
  CAST({value} AS DOUBLE) AS value FROM ({rows})"""


def ranked(section: str, rows: str, label: str, value: str) -> str:
    return line(section, rows, label, value, f"-{value}")


def cells(section: str, rows: str, names: tuple[str, ...]) -> list[str]:
    return [line(section, rows, f"'{n}'", n, str(i)) for i, n in enumerate(names, start=1)]


register(
    "report_long",
    "\nUNION ALL\n".join(
        [
            *cells("basic", BASIC, ("total_records", "total_columns")),
            line("date_range", BASIC, "'from ' || first_date", "NULL", "1"),
            line("date_range", BASIC, "'to ' || last_date", "NULL", "2"),
            line("fiscal_years", YEARS, "fiscal_year", "records", "fiscal_year"),
            *cells("dollars", DOLLAR_STATS, ("total", "mean", "median", "min", "max")),
            ranked("agencies_by_count", top_count(AGENCY, 10), "name", "records"),
            ranked("agencies_by_dollars", top_dollars(AGENCY, 10), "name", "dollars"),
            ranked("types_by_count", TYPES, "instrument_type", "records"),
            line("types_percentage", TYPES, "instrument_type", "percentage", "-records"),
            ranked("types_by_dollars", TYPE_VALUES, "instrument_type", "total"),
            line("types_by_dollars_records", TYPE_VALUES, "instrument_type", "records", "-total"),
            line("types_by_dollars_mean", TYPE_VALUES, "instrument_type", "mean", "-total"),
            ranked("flag_participation", PARTICIPATION, "business_type", "true_count"),
            line("flag_percentage", PARTICIPATION, "business_type", "percentage", "-true_count"),
            ranked("flag_dollars", FLAG_DOLLARS, "business_type", "dollars"),
            line("flag_dollars_percentage", FLAG_DOLLARS, "business_type", "percentage", "-dollars"),
            ranked("vendors_by_count", top_count(VENDOR, 10), "name", "records"),
            ranked("vendors_by_dollars", top_dollars(VENDOR, 10), "name", "dollars"),
            ranked("missing_data", MISSING, "column_name", "null_count"),
            line("missing_percentage", MISSING, "column_name", "null_percentage", "-null_count"),
            line("completeness", COMPLETENESS, "'completeness'", "completeness", "1"),
        ]
    ),
    AWARDS,
)
_long = ORACLES["report_long"]
register(
    "report_text",
    f"""SELECT '[' || section || '] ' || coalesce(label, '') || coalesce(': ' || format('{{:,.2f}}', value), '') AS line FROM long""",
    AWARDS,
    "long AS (" + _long[len("WITH " + AWARDS) :] + ")",
)
ALL_ISSUES = """all_issues AS (SELECT * FROM issues UNION ALL
SELECT NULL, 2147483647, 'INFO', 'duplicates', 'Removed ' || removed || ' duplicate rows', removed
FROM (SELECT (SELECT count(*) FROM cleaned) - (SELECT count(*) FROM awards) AS removed) WHERE removed > 0)"""
register(
    "etl_summary",
    "\nUNION ALL\n".join(
        [
            line("records", "SELECT count(*) AS n FROM awards", "'records'", "n", "1"),
            line("columns", "SELECT 23 AS n", "'columns'", "n", "1"),
            line("issues", "SELECT count(*) AS n FROM all_issues", "'issues'", "n", "1"),
            line(
                "last_issues",
                """SELECT *, row_number() OVER (ORDER BY source_file DESC NULLS FIRST, ord DESC) AS pos
FROM all_issues QUALIFY pos <= 5""",
                "severity || ': ' || message",
                "issue_count",
                "pos",
            ),
            ranked("top_agencies", top_count(AGENCY, 5), "name", "records"),
            line("fiscal_years", YEARS, "fiscal_year", "records", "fiscal_year"),
        ]
    ),
    AWARDS,
    ISSUES,
    ALL_ISSUES,
)

# -- planning -----------------------------------------------------------------

SPAN = "span AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders)"


WINDOW_SQL = (
    "SELECT CAST(a + CAST(i * {n} AS INTEGER) AS DATE) AS s, "
    "CAST(least(a + CAST(i * {n} + {n} - 1 AS INTEGER), b) AS DATE) AS e "
    "FROM (SELECT a, b, unnest(range(0, (b - a) // {n} + 1)) AS i FROM span)"
)
register(
    "plan_shards",
    f"""
SELECT g.award_group, w.s AS shard_start, w.e AS shard_end, y.agency
FROM ({WINDOW_SQL.format(n=7)}) w, (SELECT DISTINCT award_group FROM award_groups) g,
  (VALUES ('ASIA'), ('EUROPE')) y(agency)""",
    SPAN,
    GROUPS,
)
register(
    "split_ranges",
    """
SELECT DISTINCT s AS range_start, e AS range_end, n AS row_count, CAST(e - s + 1 AS INTEGER) AS days, n <= 170 AS within_limit
FROM sized WHERE NOT (n > 170 AND e - s + 1 > 7)""",
    f"RECURSIVE {SPAN}",
    "daily AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1)",
    f"""sized(s, e, n) AS (
  SELECT s, e, (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM daily WHERE d BETWEEN s AND e)
  FROM ({' UNION '.join('SELECT s, e FROM (' + WINDOW_SQL.format(n=n) + ')' for n in (3, 28, 92, 400))})
  UNION ALL
  SELECT h.s, h.e, (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM daily WHERE d BETWEEN h.s AND h.e)
  FROM (SELECT unnest([{{'s': s, 'e': s + CAST((e - s) // 2 AS INTEGER)}}, {{'s': s + CAST((e - s) // 2 + 1 AS INTEGER), 'e': e}}]) AS h
        FROM sized WHERE n > 170 AND e - s + 1 > 7))""",
)
register(
    "shard_counts",
    f"""
SELECT award_group, {shard_start(7)} AS shard_start, least({shard_start(7)} + 6, DATE '2001-08-01') AS shard_end,
  count(*) AS row_count
FROM awards_predicate JOIN award_groups USING (award_type_code)
WHERE action_date BETWEEN DATE '1995-01-01' AND DATE '2001-08-01' GROUP BY ALL""",
    PREDICATE,
    GROUPS,
)
register(
    "period_availability",
    f"""
SELECT p.period, p.range_start, p.range_end, count(x.order_key) AS row_count, count(x.order_key) > 0 AS has_data
FROM (VALUES {', '.join(f"('{n}', DATE '{a}', DATE '{b}')" for n, a, b in bindings.PERIODS)}) p(period, range_start, range_end)
LEFT JOIN awards_predicate x ON x.action_date BETWEEN p.range_start AND p.range_end AND x.award_type_code IN ('A', 'B', 'C', 'D')
GROUP BY ALL""",
    PREDICATE,
)
register(
    "date_gaps",
    """
SELECT min(d) AS gap_start, max(d) AS gap_end, count(*) AS days
FROM (SELECT d, d - CAST(row_number() OVER (ORDER BY d) AS INTEGER) AS island
  FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-08-01', INTERVAL 1 DAY)) AS DATE) AS d)
  WHERE d NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders))
GROUP BY island""",
)
register(
    "missing_shards",
    """
SELECT award_group, agency_slug, a + CAST(7 * i AS INTEGER) AS shard_start, least(a + CAST(7 * i + 6 AS INTEGER), b) AS shard_end
FROM (SELECT award_group, agency_slug, min(d) AS a, max(d) AS b, unnest(range(0, (max(d) - min(d)) // 7 + 1)) AS i FROM (
  SELECT award_group, agency_slug, d, d - CAST(row_number() OVER (PARTITION BY award_group, agency_slug ORDER BY d) AS INTEGER) AS island
  FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-08-01', INTERVAL 1 DAY)) AS DATE) AS d), (VALUES ('contracts'), ('loans')) t(award_group),
    (SELECT replace(r_name, ' ', '_') AS agency_slug FROM region)
  WHERE (award_group, agency_slug, d) NOT IN (SELECT award_group, agency_slug, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) FROM landed)
) GROUP BY award_group, agency_slug, island)""",
    PREDICATE,
    GROUPS,
    f"""landed AS (
  SELECT DISTINCT award_group, replace(awarding_toptier, ' ', '_') AS agency_slug, {shard_start(7)} AS a, least({shard_start(7)} + 6, DATE '2001-08-01') AS b
  FROM awards_predicate JOIN award_groups USING (award_type_code)
  WHERE award_group IN ('contracts', 'loans') AND action_date BETWEEN DATE '1995-01-01' AND DATE '2001-08-01' AND part_key % 3 <> 0 AND month(action_date) NOT IN (2, 7)
  UNION SELECT DISTINCT award_group, replace(awarding_toptier, ' ', '_'), {shard_start(28)}, least({shard_start(28)} + 27, DATE '2001-08-01')
  FROM awards_predicate JOIN award_groups USING (award_type_code)
  WHERE award_group IN ('contracts', 'loans') AND action_date BETWEEN DATE '1995-01-01' AND DATE '2001-08-01' AND month(action_date) = 7 AND supplier_key % 2 = 0)""",
)
register(
    "range_counts",
    """
SELECT r.o_orderkey, r.a AS range_start, r.b AS range_end, (coalesce(u.t, 0) - coalesce(v.t, 0))::BIGINT AS row_count
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) - 400 AS a, CAST(o_orderdate AS DATE) - 400 + [29, 89, 364, 3651][CAST(o_orderkey % 4 + 1 AS INTEGER)] AS b FROM orders) r
ASOF LEFT JOIN running u ON r.b >= u.d
ASOF LEFT JOIN running v ON r.a > v.d""",
    "running AS (SELECT CAST(o_orderdate AS DATE) AS d, sum(count(*)) OVER (ORDER BY CAST(o_orderdate AS DATE)) AS t FROM orders GROUP BY 1)",
)
register(
    "month_bucket",
    """
SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS row_count,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders GROUP BY 1""",
)

# -- monitoring ---------------------------------------------------------------

ISO = "'%Y-%m-%dT%H:%M:%S.%f'"
RECENT = f"""recent AS (SELECT *, strftime(start_ts, {ISO}) AS start_time, strftime(end_ts, {ISO}) AS end_time
FROM runs_raw WHERE start_ts >= TIMESTAMP '2024-01-24 00:00:00')"""
ERROR_TEXT = (
    "'Data processing error ' || k || ' of ' || run_id || "
    "': the step did not finish, see the log of the run for the stack trace and all details'"
)
STEP_STATE = (
    "CASE WHEN status <> 'FAILED' OR k < event_id % 4 + 1 THEN 'SUCCESS' "
    "WHEN k = event_id % 4 + 1 THEN 'FAILED' ELSE 'SKIPPED' END"
)
STEPS = "(VALUES (1, 'data_download'), (2, 'data_processing'), (3, 'analysis'), (4, 'cleanup')) t(k, step_name)"

register("runs_recent", "SELECT run_id, status, start_time, end_time FROM recent", RUNS, RECENT)
register(
    "runs_newest",
    "SELECT run_id, status, start_time FROM recent ORDER BY start_ts DESC, run_id DESC LIMIT 10",
    RUNS,
    RECENT,
)
register(
    "run_success_rate",
    f"""
SELECT count(*) AS runs, count(*) FILTER (WHERE status = 'SUCCESS') AS successes,
  count(*) FILTER (WHERE status <> 'SUCCESS') AS failures,
  {percent("count(*) FILTER (WHERE status = 'SUCCESS')", 'count(*)')} AS success_rate FROM recent""",
    RUNS,
    RECENT,
)
register(
    "run_metrics",
    f"""
SELECT run_id, status, strftime(start_ts, {ISO}) AS start_time, strftime(end_ts, {ISO}) AS end_time,
  (epoch_us(end_ts) - epoch_us(start_ts)) / 60000000.0::DOUBLE AS duration_minutes,
  CAST(CASE WHEN status = 'FAILED' THEN event_id % 4 ELSE 4 END AS INTEGER) AS successful_steps,
  CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END AS failed_steps,
  CAST(n_errors AS INTEGER) AS total_errors, n_output_files AS output_files FROM runs_raw""",
    RUNS,
)
register(
    "run_errors_head",
    f"""
SELECT run_id, k - 1 AS pos, substr({ERROR_TEXT}, 1, 80) AS error
FROM recent, (VALUES (1), (2)) t(k) WHERE k <= n_errors""",
    RUNS,
    RECENT,
)
register(
    "run_steps_detail",
    f"""
SELECT run_id, status, 'step' AS kind, step_name AS name, {STEP_STATE} AS state FROM newest, {STEPS}
UNION ALL
SELECT run_id, status, 'file', f, NULL FROM newest, (VALUES ('awards.parquet'), ('report.txt')) t(f) WHERE n_output_files > 0""",
    RUNS,
    RECENT,
    "newest AS (SELECT * FROM recent ORDER BY start_ts DESC, run_id DESC LIMIT 3)",
)
register(
    "run_summary_text",
    f"""
SELECT run_id, 'Status: ' || status || chr(10) || 'Run: ' || run_id || chr(10) || 'Start: ' || strftime(start_ts, {ISO})
  || chr(10) || 'End: ' || coalesce(strftime(end_ts, {ISO}), 'Running...') || chr(10) || 'Steps:'
  || (SELECT string_agg(chr(10) || '- ' || step_name || ': ' || {STEP_STATE}, '' ORDER BY step_name) FROM {STEPS})
  || CASE WHEN n_output_files > 0 THEN chr(10) || 'Output files:' || chr(10) || '- awards.parquet' || chr(10) || '- report.txt' ELSE '' END
  || CASE WHEN n_errors > 0 THEN chr(10) || 'Errors:' || (SELECT string_agg(chr(10) || '- ' || {ERROR_TEXT}, '' ORDER BY k)
      FROM (VALUES (1), (2), (3), (4)) t(k) WHERE k <= n_errors) ELSE '' END AS summary
FROM runs_raw""",
    RUNS,
)

REPORTS = f"""reports AS (SELECT *, strftime(ts, {ISO}) AS processing_timestamp, event_id % 7 + 1 AS n_issues FROM events),
report_issues AS (SELECT r.*, k - 1 AS pos,
  CASE (event_id + k) % 3 WHEN 0 THEN 'ERROR' WHEN 1 THEN 'WARNING' ELSE 'INFO' END AS severity,
  'issue ' || k || ' of report ' || event_id || ' found while loading a landed file of kind ' || event_type AS message,
  CASE WHEN k % 2 = 0 THEN user_id % 50 + k END AS issue_count
  FROM reports r, (VALUES (1), (2), (3), (4), (5), (6), (7)) t(k) WHERE k <= n_issues),
latest AS (SELECT * FROM reports WHERE ts >= TIMESTAMP '2024-01-24 00:00:00' ORDER BY ts DESC LIMIT 1)"""
register(
    "dq_latest",
    "SELECT processing_timestamp, user_id + 100 AS total_rows, 7 AS total_columns, CAST(n_issues AS INTEGER) AS issues FROM latest",
    REPORTS,
)
register(
    "dq_issue_counts",
    """
SELECT processing_timestamp, count(*) FILTER (WHERE severity = 'ERROR') AS errors,
  count(*) FILTER (WHERE severity = 'WARNING') AS warnings, count(*) AS issues
FROM report_issues WHERE ts >= TIMESTAMP '2024-01-24 00:00:00' GROUP BY 1""",
    REPORTS,
)
register("dq_issue_rows", "SELECT processing_timestamp, pos, severity, message, issue_count FROM report_issues", REPORTS)
register(
    "dq_last_issues",
    """
SELECT CAST(pos - greatest(n_issues - 5, 0) AS INTEGER) AS pos, severity, substr(message, 1, 60) AS message, issue_count
FROM report_issues WHERE event_id = (SELECT event_id FROM latest) AND pos >= n_issues - 5""",
    REPORTS,
)
register(
    "dq_column_completeness",
    f"""
SELECT column_name, null_count, {percent('user_id + 100 - null_count', 'user_id + 100')} AS completeness
FROM (SELECT * FROM (SELECT user_id, unnest([
    {{'column_name': 'PIID', 'null_count': event_id % 11}}, {{'column_name': 'AAC', 'null_count': 0}},
    {{'column_name': 'Fiscal Year', 'null_count': event_id % 13}}, {{'column_name': 'Date Signed', 'null_count': event_id % 17}},
    {{'column_name': 'Dollars Obligated', 'null_count': event_id % 19}},
    {{'column_name': 'Instrument Type', 'null_count': event_id % 23}},
    {{'column_name': 'Last Date to Order', 'null_count': user_id + 100}}], recursive := true) FROM latest)
  ORDER BY null_count DESC, column_name LIMIT 5)
WHERE null_count > 0""",
    REPORTS,
)
