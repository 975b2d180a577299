import random
import statistics
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from awardloom.operators import dedup, filters, medians, profile, reports
from awardloom.session import fresh_dir, shared_dir
from awardloom.sources import sinks

slow = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
CENT = Decimal("0.01")
money = st.integers(-(10**20) + 1, 10**20 - 1).map(lambda c: c * CENT)
small = st.integers(-500, 500).map(lambda c: c * CENT)


def column(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x decimal(20,2)")
    return df


@slow
@given(st.lists(st.one_of(st.none(), small, money), min_size=1, max_size=40))
def test_median_equals_brute_force(spark, values):
    got = medians.exact_medians(column(spark, values), ["x"]).first().median
    present = sorted(v for v in values if v is not None)
    if not present:
        assert got is None
    else:
        n = len(present)
        want = (present[(n - 1) // 2] + present[n // 2]) / 2
        assert got == pytest.approx(float(want), rel=1e-15, abs=1e-9)


def test_median_of_many_equal_values(spark):
    rng = random.Random(7)
    values = [Decimal("100.00")] * 4000 + [Decimal(rng.randrange(10**9)) / 100 for _ in range(8001)]
    df = column(spark, values).repartition(8)
    assert medians.exact_medians(df, ["x"]).first().median == pytest.approx(float(statistics.median(values)))


@slow
@given(st.lists(st.one_of(st.none(), st.booleans()), min_size=1, max_size=12))
def test_flag_median(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "f boolean")
    got = profile.profile_numeric(df).first().median
    present = [int(v) for v in values if v is not None]
    assert got == (statistics.median(present) if present else None)


def test_profile_of_odd_names_and_types(spark):
    df = spark.createDataFrame(
        [(1, "a", True, None), (3, "it's", None, None), (None, None, False, None)], "`a.b` int, `it's (x)` string, f boolean, e string"
    )
    got = {r.column_name: r for r in profile.column_profiles(df).collect()}
    assert (got["a.b"].null_count, got["a.b"].median, got["a.b"].mean, got["a.b"].unique_count) == (1, 2.0, 2.0, 2)
    assert (got["it's (x)"].max_length, got["it's (x)"].avg_length, got["it's (x)"].min) == (4, 2.5, None)
    assert (got["f"].min, got["f"].max, got["f"].median, got["f"].unique_percentage) == (0.0, 1.0, 0.5, 66.6667)
    assert (got["e"].null_percentage, got["e"].avg_length, got["e"].max_length) == (100.0, None, None)
    approx = {r.column_name: r.unique_count for r in profile.profile_distinct(df, approx=True).collect()}
    assert approx == {"a.b": 2, "it's (x)": 2, "f": 2, "e": 0}


AWARDS = "`Fiscal Year` int, `Date Signed` date, `Dollars Obligated` decimal(20,2), `Funding Agency Name` string, `Legal Business Name` string, `Instrument Type` string, `Is Vendor Business Type - A` boolean"


def awards(spark, rows):
    return spark.createDataFrame(rows, AWARDS)


def d(x):
    return None if x is None else Decimal(x)


def test_null_groups_and_ties(spark):
    df = awards(spark, [
        (2020, None, d("5"), "b", "v", "T", True), (2021, None, d("5"), "a", None, None, None),
        (None, None, None, None, "v", "T", False), (2020, None, None, "c", "w", "U", True),
    ])
    assert [tuple(r) for r in reports.top_by_count(df, "Funding Agency Name", 2).collect()] == [("a", 1), ("b", 1)]
    assert [tuple(r) for r in reports.top_by_dollars(df, "Funding Agency Name", 10).collect()] == [("a", 5.0), ("b", 5.0), ("c", 0.0)]
    # The share is of all rows, also those without a type.
    assert [tuple(r) for r in reports.contract_type_distribution(df).collect()] == [("T", 2, 50.0), ("U", 1, 25.0)]
    assert [tuple(r) for r in reports.contract_type_value(df).collect()] == [("T", 1, 5.0, 5.0), ("U", 0, 0.0, None)]
    assert [tuple(r) for r in reports.small_business_participation(df).collect()] == [("A", 2, 66.6667)]
    assert [tuple(r) for r in reports.small_business_dollars(df).collect()] == [("A", 5.0, 50.0)]


def test_share_is_zero_when_total_is_not_positive(spark):
    df = awards(spark, [(2020, None, d("-5"), "b", "v", "T", True)])
    assert reports.small_business_dollars(df).first().percentage == 0.0


def test_report_on_empty_table(spark):
    df = awards(spark, [])
    got = {(r.section, r.label): r.value for r in reports.report(df).collect()}
    assert got["basic", "total_records"] == 0 and got["dollars", "total"] == 0 and got["dollars", "median"] is None
    assert reports.small_business_participation(df).count() == 0


def test_dispatch(spark):
    df = awards(spark, [(2020, None, d("5"), "b", "v", "T", True)])
    sections = {"basic": {"basic", "date_range", "fiscal_years", "dollars"}, "vendors": {"vendors_by_count", "vendors_by_dollars"},
                "quality": {"missing_data", "missing_percentage", "completeness"}, "agency": {"agencies_by_count", "agencies_by_dollars"},
                "contracts": {"types_by_count", "types_percentage", "types_by_dollars", "types_by_dollars_records", "types_by_dollars_mean"},
                "small-business": {"flag_participation", "flag_percentage", "flag_dollars", "flag_dollars_percentage"}}
    for name, want in sections.items():
        assert {r.section for r in reports.report(df, name).collect()} == want
    assert {r.section for r in reports.report(df).collect()} == set().union(*sections.values())
    lacking = df.drop("Legal Business Name", "Dollars Obligated", "Date Signed")
    assert {r.section for r in reports.report(lacking).collect()} == {
        "basic", "fiscal_years", "agencies_by_count", "types_by_count", "types_percentage", "flag_participation", "flag_percentage", "completeness"}
    with pytest.raises(ValueError):
        reports.report(df, "charts")


def test_report_text(spark, tmp_path):
    df = awards(spark, [(2020, None, d("5"), "b", "v", "T", True)])
    out = sinks.write_report_text(reports.report(df, "agency"), str(tmp_path / "r"))
    assert [r.value for r in spark.read.text(out).collect()] == ["[agencies_by_count] b: 1.00", "[agencies_by_dollars] b: 5.00"]


# -- dedup ------------------------------------------------------------------------


def test_null_keys_are_equal_and_first_wins(spark):
    df = spark.createDataFrame(
        [(None, "0", 3, "c"), (None, "0", 1, "a"), ("p", None, 2, "b"), ("p", None, 9, "z"), ("p", "0", 5, "d")],
        "PIID string, `Modification Number` string, o int, v string",
    )
    got = dedup.keep_first(df, ["PIID", "Modification Number", "Date Signed"], ["o"])
    assert sorted(r.v for r in got.collect()) == ["a", "b", "d"] and got.columns == df.columns
    acc = dedup.dedup_accounting(df, ["PIID", "Modification Number"]).first()
    assert tuple(acc) == (5, 3, 2)


def test_no_key_present_is_a_no_op(spark):
    df = spark.createDataFrame([(1,), (1,)], "x int")
    assert dedup.keep_first(df, ["k"], ["x"]).count() == 2
    assert tuple(dedup.dedup_accounting(df, ["k"]).first()) == (2, 2, 0)


@slow
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2)), max_size=30))
def test_union_then_dedup_is_idempotent(spark, pairs):
    df = spark.createDataFrame([(k, m, i) for i, (k, m) in enumerate(pairs)], "k int, m int, o int")
    once = dedup.keep_first(df, ["k", "m"], ["o"])
    twice = dedup.keep_first(dedup.union_all([once, once]), ["k", "m"], ["o"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    first = {}
    for i, key in enumerate(pairs):
        first.setdefault(key, i)
    assert sorted((r.k, r.m, r.o) for r in once.collect()) == sorted((*k, i) for k, i in first.items())


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([(2,), (2,)], "i int")
    assert sorted(map(tuple, dedup.union_all([a, b]).collect()), key=str) == [(1, "x"), (2, None), (2, None)]


# -- paging -------------------------------------------------------------------------


def test_pages_number_every_row(spark):
    rng = random.Random(3)
    rows = [(i, Decimal(7) if i % 3 == 0 else Decimal(rng.randrange(50))) for i in range(1234)]
    df = spark.createDataFrame(rows, "id int, amount decimal(20,2)").repartition(4)
    got = {r.id: r.page for r in filters.number_pages(df, fresh_dir(spark, "t"), ["id"], 100).collect()}
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    assert got == {r[0]: i // 100 + 1 for i, r in enumerate(order)}


def test_one_page(spark):
    df = spark.createDataFrame([(i, Decimal(i)) for i in range(5)], "id int, amount decimal(20,2)")
    pick = lambda p: [(r.id, r.has_next) for r in filters.search_page(df, p, ["id"], 2).collect()]
    assert pick(1) == [(4, True), (3, True)] and pick(3) == [(0, False)] and pick(4) == []


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")


class _Bare:
    """A session without the shared-folder setting."""

    def __init__(self, spark, master):
        self.real, self.made = spark, None
        self.conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})
        self.sparkContext = type(
            "S", (), {
                "master": master,
                "getCheckpointDir": lambda _: self.made,
                "setCheckpointDir": lambda _, p: setattr(self, "made", p),
            },
        )()


def test_own_folder_only_on_a_local_master(spark):
    local = _Bare(spark, "local[2]")
    assert shared_dir(local) == local.made == shared_dir(local)
    with pytest.raises(ValueError):
        shared_dir(_Bare(spark, "yarn"))


@pytest.mark.parametrize(
    "values",
    [
        [0.001, 0.002, 0.0035], [1e20, -1e20, 3.5], [1e-300, 1e300, 1.0, 2.0], [-1.7e308, 1.7e308, 0.1, 0.2], [7.25], [2.0] * 5 + [3.0],
        [0.1 + i * 1e-12 for i in range(50)], [None, float("nan"), 1.5, 2.5], [None], [],
    ],
)
def test_numbers_off_the_grid_profile_exactly(spark, values):
    import math

    df = spark.createDataFrame([(v,) for v in values], "x double")
    real = [v for v in values if v is not None and not math.isnan(v)]
    got = profile.profile_numeric(df).first()
    if not real:
        assert (got.min, got.max, got.median) == (None, None, None)
    else:
        assert (got.min, got.max) == (min(real), max(real))
        assert got.median == pytest.approx(statistics.median(real), rel=1e-15)


def test_large_integers_and_fine_decimals(spark):
    from decimal import Decimal

    big = [2**62 + i for i in range(9)] + [-(2**63), 2**63 - 1]
    fine = [Decimal("0.0001") * i for i in range(11)]
    df = spark.createDataFrame(list(zip(big, fine)), "a bigint, b decimal(30,6)")
    got = {r.column_name: r.median for r in medians.exact_medians(df, ["a", "b"]).collect()}
    assert got == {"a": float(statistics.median(big)), "b": 0.0005}


def test_profiles_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a string, b double, c boolean, d decimal(20,2)")
    for approx in (False, True):
        assert {r.column_name: r.unique_count for r in profile.profile_distinct(df, approx).collect()} == dict.fromkeys("abcd", 0)
        assert profile.column_profiles(df, approx).count() == 4
