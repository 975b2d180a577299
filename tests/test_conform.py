import datetime as dt
from decimal import Decimal

from awardloom.config import EngineConfig
from awardloom.operators import conform, dedup, filters, validate
from awardloom.schema import AWARD_COLUMNS, AWARD_SCHEMA, COLUMN_MAPPING, q
from awardloom.session import stored
from awardloom.sources import history

CFG = EngineConfig()


def raw(spark, columns, rows):
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns))


def test_all_columns_in_order_with_types(spark):
    df = raw(spark, ["recipient_name", "award_id_piid", "extra"], [("A ", "p1", "x")])
    out = conform.clean(conform.conform(df, CFG), CFG)
    assert out.columns == list(AWARD_COLUMNS)
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in AWARD_SCHEMA.fields]
    row = out.first()
    assert (row["PIID"], row["Legal Business Name"], row["Last Date to Order"]) == ("p1", "A", None)


def test_missing_severities():
    have = [c for c in COLUMN_MAPPING if c not in ("award_type", "ordering_period_end_date")]
    assert conform.missing_columns(have, CFG) == [
        ("award_type", "Instrument Type", "ERROR"),
        ("ordering_period_end_date", "Last Date to Order", "WARNING"),
    ]


def test_no_known_column_gives_empty_typed_frame(spark):
    df = raw(spark, ["x", "y"], [("1", "2")])
    out = conform.clean(conform.conform(df, CFG), CFG)
    assert not conform.has_known_column(df.columns, CFG)
    assert out.columns == list(AWARD_COLUMNS) and out.count() == 0


def test_typed_input_columns_are_kept(spark):
    df = spark.createDataFrame(
        [("p", 2024, 12.345, dt.date(2024, 1, 2), True, 1)],
        "award_id_piid string, action_date_fiscal_year int, federal_action_obligation double, action_date date, "
        "c8a_program_participant boolean, veteran_owned_business int",
    )
    row = conform.clean(conform.conform(df, CFG), CFG).first()
    assert row["Fiscal Year"] == 2024 and row["Date Signed"] == dt.date(2024, 1, 2)
    assert row["Dollars Obligated"] == Decimal("12.35")
    assert row["Is Vendor Business Type - 8A Program Participant"] is True
    assert row["Is Vendor Business Type - Veteran-Owned Business"] is True


def test_clean_is_one_projection(spark, plan_of):
    df = raw(spark, list(COLUMN_MAPPING), [tuple("x" for _ in COLUMN_MAPPING)])
    plan = plan_of(conform.clean(conform.conform(df, CFG), CFG))
    assert "Exchange" not in plan and "Python" not in plan


def test_select_fields_skips_absent(spark):
    df = raw(spark, ["a.b", "c"], [("1", "2")])
    assert conform.select_fields(df, ["c", "a.b", "zz"]).columns == ["c", "a.b"]


# -- filters --------------------------------------------------------------------

COLS = ["Fiscal Year", "Dollars Obligated", "Instrument Type", "Funding Agency Name"]
ROWS = [
    ("2020", "100", "DO", "A"),
    ("2021.0", " 50 ", "PO", "B"),
    ("bad", "nan", "DO", " A"),
    (None, "1d", None, None),
    ("2022", "-5", "DC", "A"),
]


def test_filters_drop_unparsable_and_keep_bounds(spark):
    df = raw(spark, COLS, ROWS)
    pick = lambda f: sorted(str(r[0]) for r in filters.apply_filters(df, f).collect())
    assert pick({"fiscal_year_range": (2020, 2021)}) == ["2020", "2021.0"]
    assert pick({"min_dollars_obligated": 50}) == ["2020", "2021.0"]
    assert pick({"instrument_types": ["DO", "DC"]}) == ["2020", "2022", "bad"]
    # The value is compared as it is, before any trimming.
    assert pick({"agencies": ["A"]}) == ["2020", "2022"]
    assert len(pick({})) == 5


def test_filter_skipped_without_its_column(spark):
    df = raw(spark, ["Fiscal Year"], [("2020",), ("1999",)])
    assert filters.apply_filters(df, {"agencies": ["A"], "fiscal_year_range": (2000, 2030)}).count() == 1


def test_long_agency_list_is_a_join_with_the_same_result(spark, plan_of):
    df = raw(spark, COLS, ROWS)
    names = ["A"] + [f"n{i}" for i in range(100_000)]
    out = filters.apply_filters(df, {"agencies": names, "min_dollars_obligated": 0})
    assert "LeftSemi" in plan_of(out)
    assert out.columns == COLS and [r[0] for r in out.collect()] == ["2020"]
    counted = filters.filter_accounting(df, {"agencies": names, "min_dollars_obligated": 0})
    assert "CartesianProduct" not in plan_of(counted) and counted.first().rows_after == 1
    assert filters.apply_filters(df, {"agencies": []}).count() == 0


def test_merge_filters_by_key():
    assert filters.merge_filters({"a": 1, "b": 2}, {"b": 3, "c": None}) == {"a": 1, "b": 3}
    assert filters.merge_filters(None, None) == {}


def test_accounting_adds_up(spark):
    df = raw(spark, COLS, ROWS)
    wanted = {"min_dollars_obligated": 0, "instrument_types": ["DO", "PO"]}
    r = filters.filter_accounting(df, wanted).first()
    assert (r.rows_before, r.rows_after, r.rows_removed) == (5, 2, 3)
    assert filters.apply_filters(df, wanted).count() == r.rows_after


def test_agency_filter_does_not_multiply_rows(spark):
    rows = [(1, "T1", "S1", "T2", "S2"), (2, "T3", "S3", "T1", "S9"), (3, "T4", "S1", "T4", "S4"), (4, None, None, None, None)]
    df = spark.createDataFrame(
        rows, "id int, awarding_toptier string, awarding_subtier string, funding_toptier string, funding_subtier string"
    )
    specs = ["T1", "T1", "S1|T1", "funding:T1", "funding:S2|T2"]
    parsed = filters.parse_agency_specs(spark.createDataFrame([(s,) for s in specs], "spec string"))
    out = filters.agency_filter(df, parsed)
    assert out.columns == df.columns and sorted(r.id for r in out.collect()) == [1, 2]
    listed = filters.agency_filter(df, specs)
    assert listed.columns == df.columns and sorted(r.id for r in listed.collect()) == [1, 2]
    assert filters.agency_filter(df, []).count() == 4


def test_unknown_date_type_is_refused(spark):
    import pytest

    with pytest.raises(ValueError):
        filters.bulk_request(spark.range(1), ["contracts"], dt.date(2024, 1, 1), dt.date(2024, 1, 2), "signed_on")


def test_codes_skip_unknown_groups():
    assert filters.codes_of(["loans", "nope"]) == ["07", "08"]


# -- validation -----------------------------------------------------------------


def test_counts_by_file(spark):
    rows = [
        ("f1", None, "1980", "1", "x"),
        ("f1", "p", "bad", "nan", "2024-01-01"),
        ("f2", "p", "2040", "-9999999999", None),
    ]
    df = spark.createDataFrame(
        rows, "source_file string, PIID string, `Fiscal Year` string, `Dollars Obligated` string, `Date Signed` string"
    )
    cfg = EngineConfig(required_fields=("PIID",), date_columns=("Date Signed",), numeric_columns=("Fiscal Year", "Dollars Obligated"))
    got = {
        (r.source_file, r.rule, r.issue_count): r.message for r in validate.issue_log(df, cfg, {}, "source_file").collect()
    }
    assert got == {
        ("f1", "required", 1): "Required field 'PIID' has 1 null values",
        ("f1", "fiscal_year", 1): "Found 1 records with invalid fiscal years",
        ("f1", "dates", 1): "Column 'Date Signed': 1 invalid dates converted to null",
        ("f1", "numerics", 1): got["f1", "numerics", 1],
        ("f2", "fiscal_year", 1): "Found 1 records with invalid fiscal years",
        ("f2", "min_dollars", 1): "Found 1 records below minimum dollar threshold",
        ("f2", "dates", 1): "Column 'Date Signed': 1 invalid dates converted to null",
    }
    messages = [r.message for r in validate.issue_log(df, cfg, {}, "source_file").filter("rule = 'numerics'").collect()]
    assert sorted(messages) == [
        "Column 'Dollars Obligated': 1 invalid numeric values converted to null",
        "Column 'Fiscal Year': 1 invalid numeric values converted to null",
    ]


def test_ceiling_is_off_unless_configured(spark):
    df = spark.createDataFrame([("f", "9" * 13)], "source_file string, `Dollars Obligated` string")
    plain = EngineConfig(required_fields=(), date_columns=(), numeric_columns=("Dollars Obligated",))
    assert validate.issue_log(df, plain, {}).count() == 0
    strict = EngineConfig(
        required_fields=(), date_columns=(), numeric_columns=("Dollars Obligated",), max_dollars_limit=999999999999
    )
    assert [r.rule for r in validate.issue_log(df, strict, {}).collect()] == ["max_dollars"]


def test_losses_are_counted_after_filtering(spark):
    df = spark.createDataFrame(
        [("f", "2020", "bad"), ("f", "1999", "bad"), ("f", "2020", "2020-01-01")],
        "source_file string, `Fiscal Year` string, `Date Signed` string",
    )
    cfg = EngineConfig(required_fields=(), date_columns=("Date Signed",), numeric_columns=())
    got = {r.rule: r.issue_count for r in validate.issue_log(df, cfg, {"fiscal_year_range": (2010, 2030)}).collect()}
    assert got == {"filters": 1, "dates": 1}


def test_config_survives_null_sections():
    cfg = EngineConfig.from_dict({"default_filters": None, "data_quality": None, "output": None})
    assert cfg == EngineConfig() and cfg.default_filters == {}
    cfg = EngineConfig.from_dict(
        {"data_quality": {"validation_rules": {"fiscal_year_range": [2000, 2010]}}, "output": {"format": "csv"}}
    )
    assert cfg.fiscal_year_limits == (2000, 2010) and cfg.output_format == "csv"


def test_quoting():
    assert "a.b" in str(q("a.b"))


def test_first_rows_of_a_stored_table_stay_where_they_lie(spark, plan_of):
    keys, order = ["k", "m"], ["o"]
    rows = spark.range(200_000).selectExpr(
        "nullif(id % 30000, 7) AS k", "cast(id % 2 AS string) AS m", "pmod(hash(id), 50) AS o", "id", "repeat('x', 50) AS wide"
    )
    table = stored(rows.repartition(5), "placed")
    got = dedup.keep_first_placed(dedup.placed(table), keys, order)
    assert plan_of(got).count("Exchange") == plan_of(got).count("BroadcastExchange")  # no row moves
    seen = [tuple(r) for r in got.select("k", "m", "o").collect()]
    assert sorted(seen, key=str) == sorted((tuple(r) for r in dedup.keep_first(rows, keys, order).select("k", "m", "o").collect()), key=str)
    assert got.columns == table.columns
    assert dedup.keep_first_placed(dedup.placed(table), ["absent"], order).count() == 200_000


def test_placed_pulls_of_a_history_stay_where_they_lie(spark, plan_of):
    table = stored(spark.range(9_000).selectExpr("id % 5000 AS k", "id AS o", "id % 7 AS v"), "pulls")
    pulls = lambda t: [t.filter("v < 5"), t.filter("v > 2").withColumn("v", q("v") + 100)]
    got = history._latest(pulls(dedup.placed(table)), ["k"], ["o"])
    assert plan_of(got).count("Exchange") == plan_of(got).count("BroadcastExchange")
    want = history._latest(pulls(table), ["k"], ["o"])
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_only_rows_that_may_have_a_like_are_sorted(spark, monkeypatch):
    """A key's hash that no other row has makes its row the first; keys of equal hashes are told apart all the same."""
    table = stored(spark.range(3_000).selectExpr("nullif(if(id < 2900, id, id % 10), 3) AS k", "-id AS o").repartition(3), "placed")
    want = sorted(tuple(r) for r in dedup.keep_first(table.fillna(-1), ["k"], ["o"]).collect())
    first = lambda: sorted(tuple(r) for r in dedup.keep_first_placed(dedup.placed(table), ["k"], ["o"]).fillna(-1).collect())
    sorted_rows, real = [], dedup.keep_first
    monkeypatch.setattr(dedup, "keep_first", lambda df, *a: sorted_rows.append(df.count()) or real(df, *a))
    assert first() == want and sorted_rows == [110]
    monkeypatch.setattr(dedup.F, "xxhash64", lambda *a: dedup.F.lit(1))
    assert first() == want and sorted_rows == [110, 3_000]
