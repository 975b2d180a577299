"""Column names, code lists and record schemas of the award data model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These names, codes and limits must equal the published award
# data layout for results to agree, so they are stated as plain tables.
# ---------------------------------------------------------------------------

FLAG_PREFIX = "Is Vendor Business Type - "

COLUMN_MAPPING = {
    "action_date_fiscal_year": "Fiscal Year",
    "award_id_piid": "PIID",
    "awarding_agency_code": "AAC",
    "award_type": "Instrument Type",
    "parent_award_id_piid": "Referenced IDV PIID",
    "modification_number": "Modification Number",
    "action_date": "Date Signed",
    "period_of_performance_current_end_date": "Est. Ultimate Completion Date",
    "ordering_period_end_date": "Last Date to Order",
    "federal_action_obligation": "Dollars Obligated",
    "base_and_all_options_value": "Base and All Options Value (Total Contract Value)",
    "recipient_name": "Legal Business Name",
    "awarding_office_name": "Contracting Office Name",
    "funding_agency_name": "Funding Agency Name",
    "transaction_description": "Description of Requirement",
    "contracting_officers_determination_of_business_size": "Contracting Officers Business Size Determination",
    "c8a_program_participant": "Is Vendor Business Type - 8A Program Participant",
    "economically_disadvantaged_women_owned_small_business": "Is Vendor Business Type - Economically Disadvantaged Women-Owned Small Business",
    "historically_underutilized_business_zone_hubzone_firm": "Is Vendor Business Type - HUBZone Firm",
    "self_certified_small_disadvantaged_business": "Is Vendor Business Type - Self-Certified Small Disadvantaged Business",
    "service_disabled_veteran_owned_business": "Is Vendor Business Type - Service-Disabled Veteran-Owned Business",
    "veteran_owned_business": "Is Vendor Business Type - Veteran-Owned Business",
    "women_owned_small_business": "Is Vendor Business Type - Women-Owned Small Business",
}

OPTIONAL_SOURCE_COLUMNS = ("ordering_period_end_date", "parent_award_id_piid")

DATE_COLUMNS = ("Date Signed", "Est. Ultimate Completion Date", "Last Date to Order")
NUMERIC_COLUMNS = (
    "Fiscal Year",
    "Dollars Obligated",
    "Base and All Options Value (Total Contract Value)",
)
BOOLEAN_COLUMNS = tuple(c for c in COLUMN_MAPPING.values() if c.startswith(FLAG_PREFIX))
TEXT_COLUMNS = (
    "PIID",
    "AAC",
    "Legal Business Name",
    "Contracting Office Name",
    "Funding Agency Name",
    "Description of Requirement",
)

REQUIRED_FIELDS = ("PIID", "Fiscal Year", "Legal Business Name")
FISCAL_YEAR_LIMITS = (1990, 2030)
MIN_DOLLARS_LIMIT = -999999999

AWARD_KEYS = ("PIID", "Modification Number", "Date Signed")
SEARCH_KEYS = ("Award ID", "Start Date", "End Date", "Last Modified Date")

AWARD_TYPE_GROUPS = {
    "contracts": ("A", "B", "C", "D"),
    "loans": ("07", "08"),
    "idvs": ("IDV_A", "IDV_B", "IDV_B_A", "IDV_B_B", "IDV_B_C", "IDV_C", "IDV_D", "IDV_E"),
    "grants": ("02", "03", "04", "05"),
    "other_fin_ast": ("06", "10"),
    "direct_payments": ("09", "11", "-1"),
}

SEARCH_FIELDS = (
    "Award ID",
    "Recipient Name",
    "Recipient UEI",
    "Awarding Agency",
    "Funding Agency",
    "Award Amount",
    "Start Date",
    "End Date",
    "Primary Place of Performance",
    "Description",
    "Last Modified Date",
)

SEARCH_PAGE_SIZE = 500
SHARD_DAYS = 7
MIN_SPLIT_DAYS = 7

TRUE_TOKENS = ("Y", "YES", "True", "1", "t", "T")
FALSE_TOKENS = ("N", "NO", "False", "0", "f", "F")

# Values a delimited file uses for "missing" (the default list of pandas.read_csv).
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Characters str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# ---------------------------------------------------------------------------
# Derived schemas
# ---------------------------------------------------------------------------

AMOUNT_TYPE = T.DecimalType(20, 2)
AWARD_COLUMNS = tuple(COLUMN_MAPPING.values())


def award_type_of(column: str) -> T.DataType:
    """Spark type of one processed award column."""
    if column in DATE_COLUMNS:
        return T.DateType()
    if column == "Fiscal Year":
        return T.IntegerType()
    if column in NUMERIC_COLUMNS:
        return AMOUNT_TYPE
    if column in BOOLEAN_COLUMNS:
        return T.BooleanType()
    return T.StringType()


AWARD_SCHEMA = T.StructType([T.StructField(c, award_type_of(c)) for c in AWARD_COLUMNS])

STEP_TYPE = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("details", T.StringType()),
    ]
)

RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("start_time", T.StringType()),
        T.StructField("end_time", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("steps", T.MapType(T.StringType(), STEP_TYPE)),
        T.StructField("errors", T.ArrayType(T.StringType())),
        T.StructField("output_files", T.ArrayType(T.StringType())),
    ]
)

ISSUE_TYPE = T.StructType(
    [
        T.StructField("severity", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        # An integer in some files and a string in others: read as text, cast later.
        T.StructField("count", T.StringType()),
    ]
)

PROFILE_TYPE = T.StructType(
    [
        T.StructField("data_type", T.StringType()),
        T.StructField("null_count", T.LongType()),
        T.StructField("null_percentage", T.DoubleType()),
        T.StructField("unique_count", T.LongType()),
        T.StructField("unique_percentage", T.DoubleType()),
        T.StructField("min", T.DoubleType()),
        T.StructField("max", T.DoubleType()),
        T.StructField("mean", T.DoubleType()),
        T.StructField("median", T.DoubleType()),
        T.StructField("avg_length", T.DoubleType()),
        T.StructField("max_length", T.LongType()),
    ]
)

QUALITY_REPORT_SCHEMA = T.StructType(
    [
        T.StructField("processing_timestamp", T.StringType()),
        T.StructField("data_quality_issues", T.ArrayType(ISSUE_TYPE)),
        T.StructField(
            "summary_statistics",
            T.StructType(
                [
                    T.StructField("total_rows", T.LongType()),
                    T.StructField("total_columns", T.IntegerType()),
                    T.StructField("null_counts", T.MapType(T.StringType(), T.LongType())),
                    T.StructField("data_types", T.MapType(T.StringType(), T.StringType())),
                ]
            ),
        ),
        T.StructField("column_profiles", T.MapType(T.StringType(), PROFILE_TYPE)),
    ]
)


def quoted(name: str) -> str:
    """Column name for SQL text; award headers hold dots and parentheses."""
    return "`" + name.replace("`", "``") + "`"


def text_literal(value: str) -> str:
    """String literal for SQL text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def q(name: str) -> Column:
    """Column by its literal name."""
    return F.col(quoted(name))
