"""Dates, spans and relative windows. "Now" is always a parameter."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

WINDOW_DAYS = {"daily": 1, "weekly": 7, "monthly": 30}


def compact_ts(col: Column) -> Column:
    return F.date_format(col, "yyyyMMdd_HHmmss")


def run_id(moment: dt.datetime) -> str:
    return moment.strftime("%Y%m%d_%H%M%S")


def month_label(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM")


def days_inclusive(start: Column, end: Column) -> Column:
    return F.date_diff(end, start) + 1


def to_instant(text: Column) -> Column:
    """ISO text to timestamp; null where it does not parse."""
    return F.try_to_timestamp(text)


def minutes_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(60_000_000.0)


def window_bounds(mode: str, as_of: dt.date, backfill_days: int = 30) -> tuple[dt.date, dt.date]:
    """Inclusive date range of a named window; every window ends the day before ``as_of``."""
    days = backfill_days if mode == "backfill" else WINDOW_DAYS.get(mode)
    if days is None:
        raise ValueError(f"unknown window mode: {mode}")
    last = as_of - dt.timedelta(days=1)
    return last - dt.timedelta(days=days - 1), last


def in_days(col: Column, first: dt.date, last: dt.date) -> Column:
    """Inclusive day range as plain comparisons on the stored column.

    The column keeps its own type on the left side, so the predicate reaches the Parquet scan
    for date and timestamp columns alike.
    """
    return (col >= F.lit(first)) & (col < F.lit(last + dt.timedelta(days=1)))
