"""Tolerant conversions from raw text: a bad value becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import FALSE_TOKENS, NULL_TOKENS, TRUE_TOKENS, WHITESPACE


def null_if_token(col: Column) -> Column:
    """Null for the spellings of "missing" that delimited files use."""
    return F.when(~col.isin(*NULL_TOKENS), col)


def to_date(col: Column) -> Column:
    return col.try_cast("date")


def to_amount(col: Column) -> Column:
    """Exact money value.

    DECIMAL rather than DOUBLE: ``nan``, ``inf`` and ``1d`` become null instead of numbers
    that compare above every threshold, and sums do not depend on partition order.
    """
    return col.try_cast("decimal(20,2)")


def to_year(col: Column) -> Column:
    """Fiscal year; goes through DECIMAL so that ``2024.0`` is accepted."""
    return to_amount(col).try_cast("int")


def decode_flag(col: Column, data_type: T.DataType = T.StringType()) -> Column:
    """Three-valued flag: case-sensitive untrimmed tokens, native booleans and 0/1."""
    if isinstance(data_type, T.BooleanType):
        return col
    if isinstance(data_type, T.NumericType):
        return F.when(col == 1, True).when(col == 0, False)
    return F.when(col.isin(*TRUE_TOKENS), True).when(col.isin(*FALSE_TOKENS), False)


def strip(col: Column) -> Column:
    """Remove every kind of white space at both ends, not only blanks."""
    return F.btrim(col, F.lit(WHITESPACE))


def clean_text(col: Column) -> Column:
    return F.nullif(strip(col), F.lit("nan"))


def to_count(col: Column) -> Column:
    """Issue counts arrive as a number or as text."""
    return col.try_cast("bigint")
