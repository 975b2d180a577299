"""Award-shaped views derived from the driver tables.

Each text is plain SQL that Spark and the checking engine both run; :func:`ansi` swaps the quoting.
"""

from __future__ import annotations

import datetime as dt

AWARDS_RAW = """
SELECT
  CASE WHEN l.l_partkey % 101 = 0 THEN 'FY??'
       ELSE CAST(year(o.o_orderdate) + CASE WHEN month(o.o_orderdate) >= 10 THEN 1 ELSE 0 END AS STRING)
  END AS action_date_fiscal_year,
  CASE WHEN l.l_suppkey % 53 = 0 THEN NULL ELSE concat('PIID-', CAST(l.l_orderkey AS STRING)) END AS award_id_piid,
  CAST(n.n_nationkey AS STRING) AS awarding_agency_code,
  CASE WHEN l.l_partkey % 67 = 0 THEN NULL
       WHEN l.l_returnflag = 'A' THEN 'DELIVERY ORDER'
       WHEN l.l_returnflag = 'N' THEN 'PURCHASE ORDER'
       ELSE 'DEFINITIVE CONTRACT' END AS award_type,
  CASE WHEN l.l_orderkey % 4 = 0 THEN NULL
       ELSE concat('IDV-', CAST(l.l_orderkey % 500 AS STRING)) END AS parent_award_id_piid,
  CAST(l.l_linenumber AS STRING) AS modification_number,
  CASE WHEN l.l_partkey % 59 = 0 THEN 'not a date'
       ELSE CAST(CAST(o.o_orderdate AS DATE) AS STRING) END AS action_date,
  CAST(CAST(l.l_shipdate AS DATE) AS STRING) AS period_of_performance_current_end_date,
  CASE WHEN l.l_partkey % 97 = 0 THEN 'N/A'
       WHEN l.l_partkey % 89 = 0 THEN 'nan'
       WHEN l.l_partkey % 83 = 0 THEN '1,000'
       WHEN l.l_partkey % 79 = 0 THEN '1d'
       WHEN l.l_partkey % 11 = 0 THEN concat(' ', CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS STRING), ' ')
       WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN CAST(CAST(-l.l_extendedprice AS DECIMAL(18,2)) AS STRING)
       ELSE CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS STRING) END AS federal_action_obligation,
  CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) AS STRING) AS base_and_all_options_value,
  CASE WHEN l.l_suppkey % 17 = 0 THEN concat('  ', s.s_name, ' ') ELSE s.s_name END AS recipient_name,
  concat('OFFICE ', CAST(s.s_nationkey AS STRING)) AS awarding_office_name,
  CASE WHEN c.c_custkey % 31 = 0 THEN NULL ELSE n.n_name END AS funding_agency_name,
  o.o_orderpriority AS transaction_description,
  CASE WHEN c.c_acctbal < 1000 THEN 'SMALL BUSINESS'
       ELSE 'OTHER THAN SMALL BUSINESS' END AS contracting_officers_determination_of_business_size,
  CASE WHEN l.l_suppkey % 7 = 0 THEN 't' ELSE 'f' END AS c8a_program_participant,
  CASE l.l_suppkey % 5 WHEN 0 THEN 'T' WHEN 1 THEN 'maybe' ELSE 'F' END AS economically_disadvantaged_women_owned_small_business,
  CASE WHEN l.l_linestatus = 'O' THEN 'Y' ELSE 'N' END AS historically_underutilized_business_zone_hubzone_firm,
  CASE WHEN l.l_suppkey % 3 = 0 THEN '1' ELSE '0' END AS self_certified_small_disadvantaged_business,
  CASE WHEN l.l_suppkey % 13 = 0 THEN 'True' ELSE 'False' END AS service_disabled_veteran_owned_business,
  CASE WHEN l.l_suppkey % 11 = 0 THEN 'YES' ELSE 'NO' END AS veteran_owned_business,
  CASE WHEN l.l_suppkey % 9 = 0 THEN 't' WHEN l.l_suppkey % 9 = 1 THEN NULL ELSE 'f' END AS women_owned_small_business,
  concat('landing_', CAST(l.l_linenumber AS STRING), '.csv') AS source_file,
  concat(lpad(CAST(l.l_partkey AS STRING), 12, '0'), '-', lpad(CAST(l.l_suppkey AS STRING), 12, '0'), '-',
         lpad(CAST(l.l_orderkey AS STRING), 12, '0'), '-',
         CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS STRING), '-',
         CAST(CAST(l.l_shipdate AS DATE) AS STRING)) AS row_order
FROM lineitem l
JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey
JOIN supplier s ON s.s_suppkey = l.l_suppkey
"""

# The same rows, as Spark joins them: what the orders name is joined to the orders, a quarter of the line items or less, so
# that line items are exchanged for their order alone and what a query asks of orders is decided before they meet.
AWARDS_RAW_BY_ORDER = AWARDS_RAW.replace(
    """JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey
""",
    """JOIN (orders o
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation n ON n.n_nationkey = c.c_nationkey) ON o.o_orderkey = l.l_orderkey
""",
)

# Search results over awards_raw; two fields have no counterpart in the driver tables.
AWARDS_SEARCH = """
SELECT award_id_piid AS `Award ID`, recipient_name AS `Recipient Name`,
  CAST(NULL AS STRING) AS `Recipient UEI`, awarding_agency_code AS `Awarding Agency`,
  funding_agency_name AS `Funding Agency`, federal_action_obligation AS `Award Amount`,
  action_date AS `Start Date`, period_of_performance_current_end_date AS `End Date`,
  CAST(NULL AS STRING) AS `Primary Place of Performance`, transaction_description AS `Description`,
  action_date AS `Last Modified Date`, row_order
FROM awards_raw
"""

AWARDS_PREDICATE = """
SELECT l.l_orderkey AS order_key, l.l_linenumber AS line_number, l.l_partkey AS part_key,
  l.l_suppkey AS supplier_key,
  CASE l.l_returnflag WHEN 'A' THEN 'A' WHEN 'N' THEN '07' ELSE 'ZZ' END AS award_type_code,
  CAST(o.o_orderdate AS DATE) AS action_date, CAST(l.l_shipdate AS DATE) AS last_modified_date,
  sn.n_name AS awarding_subtier, sr.r_name AS awarding_toptier,
  cn.n_name AS funding_subtier, cr.r_name AS funding_toptier,
  CAST(l.l_extendedprice AS DECIMAL(20,2)) AS amount
FROM lineitem l
JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation cn ON cn.n_nationkey = c.c_nationkey
JOIN region cr ON cr.r_regionkey = cn.n_regionkey
JOIN supplier s ON s.s_suppkey = l.l_suppkey
JOIN nation sn ON sn.n_nationkey = s.s_nationkey
JOIN region sr ON sr.r_regionkey = sn.n_regionkey
"""

# One agency-spec string per supplier and customer, in every supported form.
AGENCY_SPECS = """
SELECT concat('s', CAST(s.s_suppkey AS STRING)) AS spec_id,
  CASE s.s_suppkey % 4
    WHEN 0 THEN concat(' ', r.r_name, '  ')
    WHEN 1 THEN concat('Funding: ', r.r_name)
    WHEN 2 THEN concat(n.n_name, ' | ', r.r_name)
    ELSE concat('AWARDING:', n.n_name, '|', r.r_name, '|', s.s_name) END AS spec
FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey
UNION ALL
SELECT concat('c', CAST(c.c_custkey AS STRING)) AS spec_id,
  CASE c.c_custkey % 3
    WHEN 0 THEN concat('funding:', n.n_name, '|', r.r_name)
    WHEN 1 THEN n.n_name
    ELSE concat('awarding: ', c.c_mktsegment, ' |', n.n_name) END AS spec
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey
"""

RUNS_RAW = """
SELECT event_id,
  concat('run_', CAST(event_id AS STRING)) AS run_id,
  CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'RUNNING' ELSE 'SUCCESS' END AS status,
  ts AS start_ts,
  CASE WHEN event_type IN ('error', 'signup') THEN NULL
       WHEN event_id % 3 = 0 THEN ts + INTERVAL '15' MINUTE
       WHEN event_id % 3 = 1 THEN ts + INTERVAL '12' MINUTE
       ELSE ts + INTERVAL '20' MINUTE END AS end_ts,
  CASE WHEN event_type = 'error' THEN 1 + event_id % 4 ELSE 0 END AS n_errors,
  CASE WHEN event_type = 'error' THEN 0 ELSE 2 END AS n_output_files
FROM events
"""

STEP_NAMES = ("data_download", "data_processing", "analysis", "cleanup")


def ansi(sql: str) -> str:
    """Same text with double-quoted names."""
    return sql.replace("`", '"').strip()


def _quarters(first_year: int, last_year: int) -> list[tuple[str, dt.date, dt.date]]:
    """Fiscal quarters, October to September."""
    starts = [dt.date(y, m, 1) for y in range(first_year, last_year + 1) for m in (1, 4, 7, 10)]
    named = [(f"FY{d.year + (d.month == 10)} Q{(d.month + 2) // 3 % 4 + 1}", d) for d in starts]
    return [(name, d, end - dt.timedelta(days=1)) for (name, d), end in zip(named, starts[1:])]


# Fiscal quarters over the span of the orders, and some after its end.
PERIODS = _quarters(1992, 2002)
