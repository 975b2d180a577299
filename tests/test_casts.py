import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from awardloom.functions import casts, dates, text


def apply(spark, expr, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


def test_null_tokens(spark):
    got = apply(spark, casts.null_if_token, ["", "NA", "N/A", "null", "None", "nan", "#N/A", "none", " ", "0", None])
    assert got == [None] * 7 + ["none", " ", "0", None]


def test_amounts(spark):
    raw = [" 5 ", "1e3", "+7", "1,000", "$5", "1d", "nan", "inf", "0x10", "1_000", "-2.50", "", None]
    want = [5, 1000, 7, None, None, None, None, None, None, None, Decimal("-2.5"), None, None]
    assert apply(spark, casts.to_amount, raw) == want


def test_dates(spark):
    raw = ["2024-09-01", "2024-9-4", "2024-09-02 00:00:00", "2024-02-30", "bad", None]
    want = [dt.date(2024, 9, 1), dt.date(2024, 9, 4), dt.date(2024, 9, 2), None, None, None]
    assert apply(spark, casts.to_date, raw) == want


def test_flags_from_text(spark):
    raw = ["t", "F", "Y", "NO", "1", "0", "True", "YES", "N", "False", "f", "T", "y", "true", " t", None]
    want = [True, False, True, False, True, False, True, True, False, False, False, True, None, None, None, None]
    assert apply(spark, casts.decode_flag, raw) == want


def test_flags_from_native_values(spark):
    assert apply(spark, lambda c: casts.decode_flag(c, T.BooleanType()), [True, False, None], "boolean") == [True, False, None]
    assert apply(spark, lambda c: casts.decode_flag(c, T.IntegerType()), [1, 0, 2, None], "int") == [True, False, None, None]
    assert apply(spark, lambda c: casts.decode_flag(c, T.DoubleType()), [1.0, 0.0, 0.5], "double") == [True, False, None]


def test_fiscal_year(spark):
    assert apply(spark, casts.to_year, ["2024", "2024.0", "FY??", " 1999 "]) == [2024, 2024, None, 1999]


def test_clean_text(spark):
    raw = ["\t a \n", "nan", " nan ", None, "", " x ", "a b", "\x1cq\x85"]
    assert apply(spark, casts.clean_text, raw) == ["a", None, None, None, "", "x", "a b", "q"]


def test_counts_as_text_or_number(spark):
    assert apply(spark, casts.to_count, ["5", "x", None]) == [5, None, None]


def test_slug(spark):
    got = apply(spark, text.safe_slug, ["Dept. of X / Y", "__a b__", "é", "ok-1_2.z"])
    assert got == ["Dept._of_X_Y", "a_b", "", "ok-1_2.z"]


def test_agency_specs(spark):
    raw = [
        "Department of Defense",
        "funding:Department of Defense",
        "funding:APHIS|Department of Agriculture",
        " AWARDING: A | B | C ",
        "x:y|z",
    ]
    got = [tuple(r) for r in apply(spark, text.agency_spec, raw)]
    assert got == [
        ("awarding", "toptier", "Department of Defense", None),
        ("funding", "toptier", "Department of Defense", None),
        ("funding", "subtier", "APHIS", "Department of Agriculture"),
        ("awarding", "subtier", "A", "B | C"),
        ("awarding", "subtier", "x:y", "z"),
    ]


def test_default_agency_type(spark):
    assert apply(spark, lambda c: text.agency_spec(c, "funding"), ["X"])[0].type == "funding"


def test_compact_ts(spark):
    assert apply(spark, dates.compact_ts, [dt.datetime(2024, 1, 2, 3, 4, 5, 999)], "timestamp") == ["20240102_030405"]


def test_windows():
    as_of = dt.date(2024, 3, 1)
    day = dt.timedelta(days=1)
    assert dates.window_bounds("daily", as_of) == (as_of - day, as_of - day)
    assert dates.window_bounds("weekly", as_of) == (as_of - 7 * day, as_of - day)
    assert dates.window_bounds("monthly", as_of) == (as_of - 30 * day, as_of - day)
    assert dates.window_bounds("backfill", as_of, 3) == (as_of - 3 * day, as_of - day)
    with pytest.raises(ValueError):
        dates.window_bounds("hourly", as_of)
