"""Every registered query against its SQL, and the shape of the plans that matter at scale."""

import os
import re

import pytest

import __spark_entry__ as entry
from awardloom.workload import oracles, registry
from awardloom.workload import staging as S
from check_oracles import compare, duck

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query_equals_sql(spark, con, name):
    ok, note, _ = compare(spark, con, name, SF_DIR)
    assert ok, note


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(oracles.ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["name", "dollars"] and df.count() == 10


def test_no_python_and_no_cross_join(spark, plan_of):
    for name, run in registry.QUERIES.items():
        # The file probe is the one Python step; its result is collected before the scan is planned.
        if name == "landed_file_inventory":
            continue
        plan = plan_of(run(spark, SF_DIR))
        assert not re.search(r"ArrowEvalPython|BatchEvalPython|InPandas|InArrow|CartesianProduct|NestedLoop", plan), name


def test_typed_filters_reach_the_scan(spark, plan_of):
    plan = plan_of(registry.QUERIES["filter_typed_pushdown"](spark, SF_DIR))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan, re.S).group(1)
    for part in ("GreaterThanOrEqual(`Fiscal Year`,1996)", "GreaterThanOrEqual(`Dollars Obligated`", "In(`Instrument Type`"):
        assert part in pushed


def test_window_filter_reaches_the_scan(spark, plan_of):
    plan = plan_of(registry.QUERIES["window_weekly"](spark, SF_DIR))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz>" in plan


def test_top_k_does_not_sort_everything(spark, plan_of):
    plan = plan_of(registry.QUERIES["top_vendors_dollars"](spark, SF_DIR))
    assert "TakeOrderedAndProject" in plan and "Sort " not in plan.replace("TakeOrderedAndProject", "")
    assert "partial_sum" in plan
    assert "ReadSchema: struct<Dollars Obligated:decimal(20,2),Legal Business Name:string>" in plan


def test_dedup_limits_groups_before_the_shuffle(spark, plan_of):
    plan = plan_of(registry.QUERIES["dedup_awards"](spark, SF_DIR))
    before = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before and "Partial" in before
    assert plan.count("Exchange") == 1


def test_dedup_with_a_hot_key_shuffles_few_rows(spark):
    """A key with a third of the rows leaves each task once."""
    from pyspark.sql import functions as F

    from awardloom.operators import dedup

    n, tasks = 60_000, 6
    df = spark.range(0, n, 1, tasks).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("PIID"),
        F.lit("0").alias("Modification Number"), F.col("id").alias("o"),
    )
    out = dedup.dedup_awards(df, ["o"])
    rows = out.collect()
    assert len(rows) == n - n // 3 + 1 and min(r.o for r in rows if r.PIID == "hot") == 0


def test_lookups_do_not_shuffle_the_awards(spark, plan_of):
    for name in ("agency_semi_filter", "bulk_predicate", "award_group_lookup"):
        plan = plan_of(registry.QUERIES[name](spark, SF_DIR))
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        awards = plan[: plan.index("FileScan")]
        assert "Exchange hashpartitioning" not in awards.split("BroadcastExchange")[0], name


def test_basic_stats_reads_one_column(spark, plan_of):
    plan = plan_of(registry.QUERIES["basic_stats"](spark, SF_DIR))
    assert "ReadSchema: struct<Date Signed:date>" in plan


def test_staged_tables_are_written_once(spark):
    S.awards(spark, SF_DIR)
    before = dict(S._staged)
    S.awards(spark, SF_DIR)
    assert S._staged == before


def test_landed_json_is_packed_and_streams_alike(spark):
    """Text of landed JSON repeats itself; packed in files of bounded size it takes a small part of the space."""
    for name, build in (("run_ledger", S.run_ledger), ("quality_reports", S.quality_reports), ("search_pages", S.search_pages)):
        path = S.staged_path(spark, SF_DIR, name, build)
        assert {f.rsplit(".json", 1)[1] for f in os.listdir(path) if f.startswith("part-")} == {".gz"}
    pages, streamed = (entry.queries()[n](spark, SF_DIR) for n in ("search_pages_explode", "search_pages_stream"))
    assert pages.count() == streamed.count() and pages.exceptAll(streamed).isEmpty()


ONE_PASS = [
    "conform_missing_columns", "missing_column_issues", "clean_dates", "clean_numerics", "clean_booleans", "clean_text", "safe_slug",
    "filter_fiscal_year", "filter_min_dollars", "filter_instrument_type", "filter_agency", "filter_combined", "filter_accounting",
    "validate_required", "validate_fiscal_year", "validate_min_dollars", "validate_max_dollars", "coercion_loss_dates", "coercion_loss_numeric",
]


@pytest.mark.parametrize("name", ONE_PASS)
def test_one_pass_stores_no_raw_rows(spark, con, name, monkeypatch):
    """Alone, such a query takes its few columns from the tables, and does not write all columns of all rows before."""
    monkeypatch.setattr(S, "_staged", {})
    ok, note, _ = compare(spark, con, name, SF_DIR)
    assert ok and not S._staged, note


def test_one_pass_reads_raw_rows_that_are_stored(spark, plan_of):
    S.awards_raw(spark, SF_DIR)
    plan = plan_of(registry.QUERIES["filter_agency"](spark, SF_DIR))
    assert plan.count("FileScan") == 1 and "awards_raw-" in plan


def _below(plan: str, node: str) -> str:
    """The part of a plan below its first line with such a node."""
    lines = plan.splitlines()
    depths = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    at = next(i for i, line in enumerate(lines) if node in line)
    end = next((i for i in range(at + 1, len(lines)) if depths[i] <= depths[at]), len(lines))
    return "\n".join(lines[at + 1:end])


def test_line_items_are_not_exchanged_for_what_orders_name(spark, plan_of, monkeypatch):
    """At a size where nothing is broadcast: customers and nations meet the orders, and listed agencies are looked at there."""
    monkeypatch.setattr(S, "_staged", {})
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        asked = plan_of(registry.QUERIES["filter_agency"](spark, SF_DIR))
        stored = plan_of(S.view(spark, SF_DIR, S.bindings.AWARDS_RAW_BY_ORDER))
        for plan in (asked, stored):
            for key in ("o_custkey", "c_nationkey"):
                below = _below(plan, f"Exchange hashpartitioning({key}")
                assert "FileScan" in below and "l_orderkey" not in below
        assert "NATION_3" in _below(asked, "Exchange hashpartitioning(o_orderkey")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_landing_is_packed_and_keeps_no_raw_rows(spark, monkeypatch):
    """Raw rows that only a landing was built of are gone once it is; those that were there before stay."""
    monkeypatch.setattr(S, "_staged", {})
    at = registry.hostile_landing(spark, SF_DIR)
    assert [k[-1] for k in S._staged] == ["landed_hostile"]
    ends = {f.split(".", 1)[1] for d, _, fs in os.walk(at) for f in fs if f.startswith("part-") and "typed" not in d}
    assert ends == {"csv.gz"}
    S.awards_raw(spark, SF_DIR)
    registry.landed(spark, SF_DIR, "tsv")
    assert S.is_staged(spark, SF_DIR, "awards_raw")
