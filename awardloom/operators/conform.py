"""Schema conformance: select, rename, null-fill and type the declared columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import EngineConfig
from ..functions import casts
from ..schema import award_type_of, q

ISSUE_SCHEMA = "severity string, rule string, message string, issue_count bigint"


def missing_columns(columns: Sequence[str], cfg: EngineConfig) -> list[tuple[str, str, str]]:
    """(source, target, severity) of every mapped column that is not there."""
    have = set(columns)
    return [
        (src, dst, "WARNING" if src in cfg.optional_columns else "ERROR")
        for src, dst in cfg.column_mapping.items()
        if src not in have
    ]


def has_known_column(columns: Sequence[str], cfg: EngineConfig) -> bool:
    return not set(cfg.column_mapping).isdisjoint(columns)


def conform(df: DataFrame, cfg: EngineConfig, keep: Sequence[str] = ()) -> DataFrame:
    """Mapped columns under their business headers, absent ones as typed nulls.

    ``keep`` names bookkeeping columns (source file, row order) to carry along. A frame without a
    single mapped column gives an empty result with the same schema.
    """
    have = set(df.columns)
    picked = [
        q(src).alias(dst) if src in have else F.lit(None).cast("string").alias(dst)
        for src, dst in cfg.column_mapping.items()
    ]
    out = df.select(*picked, *[q(c) for c in keep])
    return out if has_known_column(df.columns, cfg) else out.limit(0)


def select_fields(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Explicit field list; fields the source does not have are left out."""
    return df.select(*[q(f) for f in fields if f in df.columns])


def missing_column_issues(df: DataFrame, cfg: EngineConfig, by: str = "source_file") -> DataFrame:
    """One row per source file and absent mapped column."""
    rows = [
        F.struct(
            F.lit(severity).alias("severity"),
            F.lit(src).alias("source_column"),
            F.lit(dst).alias("target_column"),
            F.lit(f"Missing column: {src} -> {dst}").alias("message"),
        )
        for src, dst, severity in missing_columns(df.columns, cfg)
    ]
    if not rows:
        empty = "severity string, source_column string, target_column string, message string"
        return df.select(by).limit(0).selectExpr(
            by, *[f"cast(null as {f.split()[1]}) as {f.split()[0]}" for f in empty.split(", ")]
        )
    return df.select(by).distinct().select(by, F.inline(F.array(*rows)))


def clean(df: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Typed form of a conformed frame; one projection, no shuffle."""
    types = {f.name: f.dataType for f in df.schema.fields}

    def typed(name: str):
        col, data_type = q(name), types[name]
        text = col if isinstance(data_type, T.StringType) else col.cast("string")
        if name in cfg.date_columns:
            return (col if isinstance(data_type, T.DateType) else casts.to_date(text)).alias(name)
        if name in cfg.numeric_columns:
            number = casts.to_year if isinstance(award_type_of(name), T.IntegerType) else casts.to_amount
            return number(text).alias(name)
        if name in cfg.boolean_columns:
            return casts.decode_flag(col, data_type).alias(name)
        if name in cfg.text_columns:
            return casts.clean_text(text).alias(name)
        return text.alias(name) if name in cfg.column_mapping.values() else col  # declared text, whatever it is stored as

    return df.select(*[typed(c) for c in df.columns])
