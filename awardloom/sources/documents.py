"""JSON records: run ledger, quality reports and search-result pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import QUALITY_REPORT_SCHEMA, RUN_SCHEMA, SEARCH_FIELDS, q

CORRUPT = "_corrupt_record"


def _read(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool) -> DataFrame:
    return spark.read.schema(with_text(schema)).option("multiLine", multi_line).json(path)


def with_text(schema: T.StructType) -> T.StructType:
    """Schema that also keeps the text of records that do not fit."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def _readable(records: DataFrame) -> Column:
    """Valid JSON with at least one declared field.

    Spark keeps the text of a record aside both when it is no JSON and when one field has an
    unexpected type; only the former makes the record unreadable.
    """
    text = F.col(CORRUPT)
    fields = [q(c).isNotNull() for c in records.columns if c != CORRUPT]
    return reduce(lambda a, b: a | b, fields) & (text.isNull() | F.try_parse_json(text).isNotNull())


def good(records: DataFrame) -> DataFrame:
    return records.filter(_readable(records)).drop(CORRUPT)


def broken(records: DataFrame) -> DataFrame:
    return records.filter(~_readable(records) & F.col(CORRUPT).isNotNull()).select(CORRUPT)


def read_runs(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Run ledger: one JSON object per line, or per file with ``multi_line``."""
    return _read(spark, path, RUN_SCHEMA, multi_line)


def read_quality_reports(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return _read(spark, path, QUALITY_REPORT_SCHEMA, multi_line)


def read_search_pages(
    spark: SparkSession, path: str, fields: tuple[str, ...] = SEARCH_FIELDS, multi_line: bool = False
) -> DataFrame:
    """Landed result pages ``{results: [...], page_metadata: {hasNext}}``."""
    return _read(spark, path, page_schema(fields), multi_line)


def page_schema(fields: tuple[str, ...] = SEARCH_FIELDS) -> T.StructType:
    row = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    return T.StructType(
        [
            T.StructField("results", T.ArrayType(row)),
            T.StructField("page_metadata", T.StructType([T.StructField("hasNext", T.BooleanType())])),
        ]
    )


def flatten_pages(pages: DataFrame) -> DataFrame:
    """One row per search result; empty and broken pages give none."""
    whole = good(pages) if CORRUPT in pages.columns else pages
    return whole.select(F.explode("results").alias("r")).select("r.*")
