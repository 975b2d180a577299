"""Ingestion planning: shards, splits, coverage and gaps."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates
from ..schema import MIN_SPLIT_DAYS, SHARD_DAYS, q
from ..session import stored


def windows(bounds: DataFrame, chunk_days: int = SHARD_DAYS) -> DataFrame:
    """Cut ``(first_day, last_day)`` into inclusive windows that do not overlap; the last is clipped."""
    starts = F.sequence("first_day", "last_day", F.expr(f"interval {int(chunk_days)} days"))
    return (
        bounds.filter(F.col("first_day") <= F.col("last_day"))
        .select("last_day", F.explode(starts).alias("shard_start"))
        .select(
            "shard_start",
            F.least(F.date_add("shard_start", chunk_days - 1), "last_day").alias("shard_end"),
        )
    )


def plan_shards(
    bounds: DataFrame,
    groups: Sequence[str] | None,
    agencies: Sequence[str] | None,
    chunk_days: int = SHARD_DAYS,
) -> DataFrame:
    """Every window for every group and agency; no agency list means one null (all) entry."""
    group_list = F.array(*[F.lit(g) for g in (groups or ["contracts"])])
    agency_list = F.array(*[F.lit(a).cast("string") for a in (agencies or [None])])
    return (
        windows(bounds, chunk_days)
        .withColumn("award_group", F.explode(group_list))
        .withColumn("agency", F.explode(agency_list))
        .select("award_group", "shard_start", "shard_end", "agency")
    )


def shard_start_of(day: Column, first: Column, chunk_days: int = SHARD_DAYS) -> Column:
    """First day of the shard that ``day`` falls into."""
    return F.date_add(first, (F.floor(F.date_diff(day, first) / chunk_days) * chunk_days).cast("int"))


def shard_label(start: Column, end: Column) -> Column:
    return F.concat(start.cast("string"), F.lit("_to_"), end.cast("string"))


def with_shard(
    df: DataFrame, day: str, first: dt.date, last: dt.date, chunk_days: int = SHARD_DAYS
) -> DataFrame:
    """Rows inside the planned range, each with the bounds of its shard (arithmetic, no join)."""
    start = shard_start_of(F.to_date(q(day)), F.lit(first), chunk_days)
    return (
        df.filter(dates.in_days(q(day), first, last))
        .withColumn("shard_start", start)
        .withColumn("shard_end", F.least(F.date_add("shard_start", chunk_days - 1), F.lit(last)))
    )


def shard_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, "shard_start", "shard_end").agg(F.count("*").alias("row_count"))


def split_ranges(ranges: DataFrame, min_days: int = MIN_SPLIT_DAYS) -> DataFrame:
    """Halve each failed ``(range_start, range_end)``; ranges at the minimum stay, marked terminal."""
    start, end = F.col("range_start"), F.col("range_end")
    middle = F.date_add(start, F.floor(F.date_diff(end, start) / 2).cast("int"))
    whole = dates.days_inclusive(start, end)

    def part(a: Column, b: Column, terminal: bool) -> Column:
        return F.struct(
            a.alias("range_start"), b.alias("range_end"), F.lit(terminal).alias("terminal")
        )

    halves = F.array(part(start, middle, False), part(F.date_add(middle, 1), end, False))
    return (
        ranges.select(
            F.inline(F.when(whole > min_days, halves).otherwise(F.array(part(start, end, True))))
        )
        .withColumn("days", dates.days_inclusive(F.col("range_start"), F.col("range_end")))
    )


def daily_counts(df: DataFrame, day: str) -> DataFrame:
    return df.groupBy(F.to_date(q(day)).alias("day")).agg(F.count("*").alias("n"))


def running_totals(daily: DataFrame) -> DataFrame:
    """One row: the first day with data and, for it and every later day up to the last, the rows until then (an array).

    The ordered window and the array have one entry a calendar day between the first and the last, whatever the data's size.
    """
    span = daily.filter("day is not null").agg(F.min("day").alias("a"), F.max("day").alias("b"))
    spine = span.filter("a is not null").select(F.explode(F.sequence("a", "b")).alias("day"))
    until = F.sum(F.coalesce("n", F.lit(0))).over(Window.orderBy("day"))
    dense = spine.join(daily, "day", "left").select("day", until.alias("total"))
    found = dense.agg(F.min("day").alias("first_day"), F.sort_array(F.collect_list(F.struct("day", "total"))).alias("x"))
    return found.select("first_day", F.col("x.total").alias("totals"))


def rows_between(start: Column, end: Column, running: DataFrame) -> Column:
    """Rows from one day to another, both included: two look-ups in the running totals."""
    first, totals = running.select("first_day").scalar(), running.select("totals").scalar()

    def until(day: Column) -> Column:
        place = F.least(F.date_diff(day, first), F.size(totals) - 1)
        return F.when(place >= 0, F.get(totals, place)).otherwise(F.lit(0).cast("bigint"))

    return F.when(start <= end, until(end) - until(F.date_sub(start, 1))).otherwise(F.lit(0).cast("bigint"))


def count_ranges(ranges: DataFrame, daily: DataFrame) -> DataFrame:
    """Rows per date range ``(range_start, range_end)``, whatever its length; no range is spread to days."""
    running = stored(running_totals(daily), "running-totals")
    return ranges.withColumn("row_count", rows_between(F.col("range_start"), F.col("range_end"), running))


def split_until(ranges: DataFrame, daily: DataFrame, max_rows: int, min_days: int = MIN_SPLIT_DAYS) -> DataFrame:
    """Split ranges that hold too many rows, again and again, until they fit or have the minimum length.

    Equal ranges count once. Every halving is a projection, as counts are look-ups; there are as many as the longest range
    can need, log2(its length / ``min_days``) + 1.
    """
    running = stored(running_totals(daily), "running-totals")
    start, end = F.col("range_start"), F.col("range_end")
    days = dates.days_inclusive(start, end)
    out = ranges.select("range_start", "range_end").distinct()
    longest = out.agg(F.coalesce(F.max(days), F.lit(1)).alias("n")).first().n
    while True:
        out = out.select("range_start", "range_end", rows_between(start, end, running).alias("row_count"))
        if longest <= min_days:
            break
        middle = F.date_add(start, F.floor(F.date_diff(end, start) / 2).cast("int"))
        pair = lambda a, b: F.struct(a.alias("range_start"), b.alias("range_end"))
        halves = F.array(pair(start, middle), pair(F.date_add(middle, 1), end))
        too_big = (F.col("row_count") > max_rows) & (days > min_days)
        out = out.select(F.inline(F.when(too_big, halves).otherwise(F.array(pair(start, end)))))
        longest = -(-longest // 2)
    return out.distinct().withColumn("days", days).withColumn("within_limit", F.col("row_count") <= max_rows)


def parse_spans(labels: DataFrame, label: str = "shard") -> DataFrame:
    """Landed labels ``start_to_end`` as days (span_start, span_end); others give null days and cover nothing."""
    ends = F.split(q(label), "_to_")
    day = lambda i: F.try_to_date(F.get(ends, F.lit(i)), "yyyy-MM-dd")
    whole = (F.size(ends) == 2) & (day(0) <= day(1))
    return labels.withColumn("span_start", F.when(whole, day(0))).withColumn("span_end", F.when(whole, day(1)))


def missing_spans(wanted: DataFrame, covered: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Days of each wanted span (keys, first_day, last_day) that no covered span (keys, span_start, span_end) holds,
    as spans. Keys may be null; covered spans may overlap, touch or lie in one another.

    Spans of a key that start on one day are one before anything is sorted, so a key has at most a row a calendar day.
    """
    same = lambda a, b: reduce(lambda x, y: x & y, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys])
    spans = covered.filter("span_start is not null").groupBy(*keys, "span_start").agg(F.max("span_end").alias("span_end"))
    bounds = wanted.filter("first_day <= last_day").groupBy(*keys).agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))
    inside = spans.alias("c").join(bounds.alias("w"), same("c", "w")).filter("span_end >= first_day and span_start <= last_day")
    clipped = inside.select(*[F.col(f"w.{k}") for k in keys], F.greatest("span_start", "first_day").alias("a"), F.least("span_end", "last_day").alias("b"))
    # A span of no length after the last day closes the wanted one; before the first, nothing is covered.
    closing = bounds.select(*keys, F.date_add("last_day", 1).alias("a"), F.date_add("last_day", 1).alias("b"))
    so_far = Window.partitionBy(*keys).orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    seen = clipped.unionByName(closing).withColumn("reached", F.max("b").over(so_far))
    gaps = seen.alias("s").join(bounds.alias("w"), same("s", "w")).select(
        *[F.col(f"s.{k}") for k in keys], F.coalesce(F.date_add("reached", 1), "first_day").alias("span_start"), F.date_sub("a", 1).alias("span_end")
    )
    return gaps.filter("span_start <= span_end")


def repull_list(missing: DataFrame, keys: Sequence[str], chunk_days: int = SHARD_DAYS) -> DataFrame:
    """Missing spans cut into shards to pull again."""
    starts = F.sequence("span_start", "span_end", F.expr(f"interval {int(chunk_days)} days"))
    return missing.select(*keys, "span_end", F.explode(starts).alias("shard_start")).select(
        *keys, "shard_start", F.least(F.date_add("shard_start", chunk_days - 1), "span_end").alias("shard_end")
    )


def period_availability(periods: DataFrame, daily: DataFrame) -> DataFrame:
    """Rows per named period ``(period, range_start, range_end)`` and whether there are any."""
    counted = count_ranges(periods, daily)
    return counted.withColumn("has_data", F.col("row_count") > 0)


def date_gaps(df: DataFrame, day: str, first: dt.date, last: dt.date) -> DataFrame:
    """Runs of days in the range without any row.

    Only the calendar passes through the ordered window: one row per day of the range, whatever
    the size of ``df``, whose days are reduced to distinct values before the join.
    """
    spine = df.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last))).alias("day")
    )
    seen = df.filter(dates.in_days(q(day), first, last)).select(F.to_date(q(day)).alias("day")).distinct()
    missing = spine.join(seen, "day", "left_anti")
    island = F.date_sub("day", F.row_number().over(Window.orderBy("day")))
    return (
        missing.withColumn("island", island)
        .groupBy("island")
        .agg(F.min("day").alias("gap_start"), F.max("day").alias("gap_end"), F.count("*").alias("days"))
        .drop("island")
    )


def month_buckets(df: DataFrame, day: str) -> DataFrame:
    return df.withColumn("month", dates.month_label(q(day)))
