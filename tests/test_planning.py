import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from awardloom.operators import planning

D = dt.date
DAY = dt.timedelta(days=1)
slow = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def bounds(spark, first, last):
    return spark.createDataFrame([(first, last)], "first_day date, last_day date")


def ranges(spark, rows):
    return spark.createDataFrame(rows, "range_start date, range_end date")


def test_shards(spark):
    plan = planning.plan_shards(bounds(spark, D(2024, 1, 1), D(2024, 1, 10)), ["g1", "g2"], None)
    got = sorted((r.award_group, r.shard_start, r.shard_end, r.agency) for r in plan.collect())
    assert got == [
        (g, s, e, None)
        for g in ("g1", "g2")
        for s, e in ((D(2024, 1, 1), D(2024, 1, 7)), (D(2024, 1, 8), D(2024, 1, 10)))
    ]


def test_shards_default_group_and_agencies(spark):
    plan = planning.plan_shards(bounds(spark, D(2024, 1, 1), D(2024, 1, 1)), None, ["A", "B"])
    assert sorted((r.award_group, r.agency) for r in plan.collect()) == [("contracts", "A"), ("contracts", "B")]


def test_no_shards_for_an_empty_range(spark):
    assert planning.windows(bounds(spark, D(2024, 1, 2), D(2024, 1, 1))).count() == 0


@slow
@given(st.integers(0, 400), st.integers(1, 40))
def test_shards_cover_each_day_once(spark, length, chunk):
    first = D(2023, 12, 20)
    last = first + length * DAY
    days = (
        planning.windows(bounds(spark, first, last), chunk)
        .select(F.explode(F.sequence("shard_start", "shard_end")).alias("d"))
        .collect()
    )
    assert sorted(r.d for r in days) == [first + i * DAY for i in range(length + 1)]


def test_rows_fall_into_planned_shards(spark):
    first, last = D(2024, 1, 1), D(2024, 1, 10)
    df = spark.createDataFrame([(first + i * DAY,) for i in range(-1, 12)], "day date")
    got = {r.day: (r.shard_start, r.shard_end) for r in planning.with_shard(df, "day", first, last).collect()}
    assert len(got) == 10
    assert got[D(2024, 1, 7)] == (D(2024, 1, 1), D(2024, 1, 7))
    assert got[D(2024, 1, 8)] == (D(2024, 1, 8), D(2024, 1, 10))


def test_split(spark):
    got = planning.split_ranges(ranges(spark, [(D(2024, 1, 1), D(2024, 1, 10)), (D(2024, 2, 1), D(2024, 2, 7))]))
    assert sorted(tuple(r) for r in got.collect()) == [
        (D(2024, 1, 1), D(2024, 1, 5), False, 5),
        (D(2024, 1, 6), D(2024, 1, 10), False, 5),
        (D(2024, 2, 1), D(2024, 2, 7), True, 7),
    ]


@slow
@given(st.integers(1, 300), st.integers(1, 30))
def test_split_keeps_all_days(spark, length, least):
    first = D(2024, 1, 1)
    got = planning.split_ranges(ranges(spark, [(first, first + (length - 1) * DAY)]), least).collect()
    days = sorted(first_ + i * DAY for r in got for first_ in [r.range_start] for i in range(r.days))
    assert days == [first + i * DAY for i in range(length)]
    assert len(got) == (2 if length > least else 1)


def test_repeated_split_stops_at_limit_or_minimum(spark):
    first = D(2024, 1, 1)
    rows = [(first + (i % 28) * DAY,) for i in range(280)] + [(first,)] * 100
    daily = planning.daily_counts(spark.createDataFrame(rows, "day date"), "day")
    got = planning.split_until(ranges(spark, [(first, first + 27 * DAY)]), daily, 100).collect()
    assert sorted((r.range_start, r.days, r.row_count, r.within_limit) for r in got) == [
        (D(2024, 1, 1), 7, 170, False),
        (D(2024, 1, 8), 7, 70, True),
        (D(2024, 1, 15), 7, 70, True),
        (D(2024, 1, 22), 7, 70, True),
    ]
    assert sum(r.row_count for r in got) == 380


def test_ranges_of_any_length_are_split_to_the_limit_or_the_minimum(spark):
    """Also from lengths that take many rounds; equal ranges count once."""
    first = D(2024, 1, 1)
    daily = planning.daily_counts(spark.createDataFrame([(first + (i % 400) * DAY,) for i in range(4000)], "day date"), "day")
    whole = [(first, first + n * DAY) for n in (2, 6, 7, 91, 399)] + [(first, first + 91 * DAY)]
    for limit in (5, 75, 200, 10**6):
        got = planning.split_until(ranges(spark, whole), daily, limit).collect()
        assert all(r.within_limit or r.days <= 7 for r in got)
        assert all(r.row_count == 10 * r.days and r.within_limit == (r.row_count <= limit) for r in got)
        assert {first + i * DAY for i in range(400)} == {r.range_start + i * DAY for r in got for i in range(r.days)}
        assert len({(r.range_start, r.range_end) for r in got}) == len(got)


def test_gaps(spark):
    first = D(2024, 2, 26)
    seen = [first, first + DAY, first + 4 * DAY, first + 4 * DAY, first + 9 * DAY, first - 5 * DAY]
    df = spark.createDataFrame([(d,) for d in seen], "day date")
    got = planning.date_gaps(df, "day", first, first + 10 * DAY).collect()
    assert sorted((r.gap_start, r.days) for r in got) == [
        (first + 2 * DAY, 2), (first + 5 * DAY, 4), (first + 10 * DAY, 1),
    ]


def test_gaps_over_timestamps_and_no_data(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 59),)], "day timestamp_ntz")
    got = planning.date_gaps(df, "day", D(2024, 1, 1), D(2024, 1, 3)).collect()
    assert [(r.gap_start, r.gap_end) for r in got] == [(D(2024, 1, 2), D(2024, 1, 3))]
    none = planning.date_gaps(df.limit(0), "day", D(2024, 1, 1), D(2024, 1, 3)).collect()
    assert [(r.gap_start, r.days) for r in none] == [(D(2024, 1, 1), 3)]


def test_availability(spark):
    daily = planning.daily_counts(spark.createDataFrame([(D(2024, 9, 30),), (D(2024, 9, 30),)], "day date"), "day")
    periods = spark.createDataFrame(
        [("Sep", D(2024, 9, 1), D(2024, 9, 30)), ("Oct", D(2024, 10, 1), D(2024, 10, 31))],
        "period string, range_start date, range_end date",
    )
    got = {r.period: (r.row_count, r.has_data) for r in planning.period_availability(periods, daily).collect()}
    assert got == {"Sep": (2, True), "Oct": (0, False)}
