"""Column profiles and completeness of the processed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import quoted, text_literal
from .medians import exact_medians, flag_median


# Null of the right type for measures that a column's type does not have.
ABSENT = {
    "min": "cast(null AS double)",
    "max": "cast(null AS double)",
    "total": "cast(null AS double)",
    "total_length": "cast(null AS bigint)",
    "longest": "cast(null AS int)",
}


def _per_column(df: DataFrame, columns: Sequence[str], **measures) -> DataFrame:
    """One global aggregate over all columns, turned into one row per column.

    ``measures`` maps an output name to a function from column name to aggregate SQL text, or to
    None where the column has no such measure; text keeps the many small expressions cheap to
    build. Every row also has its place, type, row count and null count.
    """
    types = dict(df.dtypes)
    aggs, cells = ["count(*) AS rows"], []
    for i, c in enumerate(columns):
        fields = [
            f"'column_name', {text_literal(c)}, 'ord', {df.columns.index(c)}, 'data_type', '{types[c]}'",
            f"'present', present_{i}",
        ]
        aggs.append(f"count({quoted(c)}) AS present_{i}")
        for m, make in measures.items():
            aggregate = make(c)
            if aggregate:
                aggs.append(f"{aggregate} AS {m}_{i}")
            fields.append(f"'{m}', {f'{m}_{i}' if aggregate else ABSENT[m]}")
        cells.append(f"named_struct({', '.join(fields)})")
    per_column = df.selectExpr(*aggs).selectExpr("rows", f"inline(array({', '.join(cells)}))")
    return per_column.withColumn("null_count", F.col("rows") - F.col("present"))


def _percent(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part * 100.0, whole), 4)


def summary_stats(df: DataFrame) -> DataFrame:
    """Rows, columns, and per column its type and null count."""
    return _per_column(df, df.columns).select(
        "column_name",
        "data_type",
        "null_count",
        F.col("rows").alias("total_rows"),
        F.lit(len(df.columns)).alias("total_columns"),
    )


def profile_nulls(df: DataFrame) -> DataFrame:
    share = _percent(F.col("null_count"), F.col("rows"))
    return _per_column(df, df.columns).select("column_name", "null_count", share.alias("null_percentage"))


def profile_distinct(df: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct non-null values per column and their share of all rows.

    The exact form unpivots once and groups by (column, value), so repeated values are combined
    before the shuffle; many distinct counts in one aggregate would copy each row once per column.
    """
    if approx:
        counts = _per_column(df, df.columns, unique_count=lambda c: f"approx_count_distinct({quoted(c)})")
        total = F.col("rows")
    else:
        cells = ", ".join(
            f"named_struct('column_name', {text_literal(c)}, 'value', cast({quoted(c)} AS string))" for c in df.columns
        )
        per_value = (
            df.selectExpr(f"inline(array({cells}))")
            .groupBy("column_name", "value")
            .agg(F.count("*").alias("n"))
        )
        counts = per_value.groupBy("column_name").agg(
            F.count("value").alias("unique_count"), F.sum("n").alias("rows")
        )
        total = F.col("rows")
    shares = counts.select(
        "column_name", "unique_count", _percent(F.col("unique_count"), total).alias("unique_percentage")
    )
    # A table without rows has no values to count, but it has columns.
    names = df.sparkSession.createDataFrame([(c,) for c in df.columns], "column_name string")
    return names.join(F.broadcast(shares), "column_name", "left").select(
        "column_name", F.coalesce("unique_count", F.lit(0)).alias("unique_count"), "unique_percentage"
    )


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns; booleans profile as 0/1."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.BooleanType))]


def flag_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _measures(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count, range, sum and text lengths of each column, all in one scan.

    Measures that a column's type does not have are null. Text lengths skip nulls.
    """
    numbers, flags, texts = set(numeric_columns(df)), set(flag_columns(df)), set(text_columns(df))
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, T.FractionalType) and not isinstance(f.dataType, T.DecimalType)}

    def of_number(function: str):
        def make(c: str) -> str | None:
            """Computed in the column's own type (a decimal sum is exact), then a double."""
            value = f"int({quoted(c)})" if c in flags else quoted(c)
            value = f"nullif({value}, double('NaN'))" if c in floats else value
            return f"cast({function}({value}) AS double)" if c in numbers else None

        return make

    def of_length(function: str):
        return lambda c: f"{function}(length({quoted(c)}))" if c in texts else None

    return _per_column(
        df,
        columns,
        min=of_number("min"),
        max=of_number("max"),
        total=of_number("sum"),
        total_length=of_length("sum"),
        longest=of_length("max"),
    )


def _numeric_part(df: DataFrame, measures: DataFrame) -> tuple[DataFrame, list[Column]]:
    """``measures`` joined with exact medians, and the numeric output columns."""
    flags = flag_columns(df)
    numbers = [c for c in numeric_columns(df) if c not in flags]
    # Flags need no search: their median follows from the counts.
    median = F.when(F.col("column_name").isin(*flags), flag_median("total", "present"))
    if numbers:
        # One row per numeric column.
        measures = measures.join(F.broadcast(exact_medians(df, numbers)), "column_name", "left")
        median = F.coalesce(median, F.col("median"))
    return measures, [
        F.col("min").cast("double").alias("min"),
        F.col("max").cast("double").alias("max"),
        F.round(F.try_divide(F.col("total").cast("double"), F.col("present")), 4).alias("mean"),
        median.alias("median"),
    ]


def _text_part() -> list[Column]:
    mean = F.try_divide(F.col("total_length").cast("double"), F.col("present"))
    return [F.round(mean, 4).alias("avg_length"), F.col("longest").cast("bigint").alias("max_length")]


def profile_numeric(df: DataFrame) -> DataFrame:
    """Minimum, maximum, mean and exact median per numeric or boolean column."""
    rows, columns = _numeric_part(df, _measures(df, numeric_columns(df)))
    return rows.select("column_name", *columns)


def profile_text(df: DataFrame) -> DataFrame:
    """Average and longest length of the present values; nulls do not count."""
    return _measures(df, text_columns(df)).select("column_name", *_text_part())


def column_profiles(df: DataFrame, approx: bool = False) -> DataFrame:
    """Everything known about each column, one row per column (the profile part of the report).

    One scan for all plain measures, one for the distinct counts, and the median search.
    """
    rows, numeric = _numeric_part(df, _measures(df, df.columns))
    return rows.join(F.broadcast(profile_distinct(df, approx)), "column_name").select(
        "ord",
        "column_name",
        "data_type",
        "null_count",
        _percent(F.col("null_count"), F.col("rows")).alias("null_percentage"),
        "unique_count",
        "unique_percentage",
        *numeric,
        *_text_part(),
    )
