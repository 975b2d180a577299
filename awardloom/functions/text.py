"""Slugs, labels and formatted text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import FLAG_PREFIX
from .casts import strip


def safe_slug(col: Column) -> Column:
    """File-name-safe form: other characters collapse to one underscore, none at the ends."""
    return F.btrim(F.regexp_replace(col.cast("string"), "[^A-Za-z0-9_.-]+", "_"), F.lit("_"))


def head(col: Column, n: int) -> Column:
    return F.substring(col, 1, n)


def flag_label(column_name: str) -> str:
    """Short name of a vendor-type flag column."""
    return column_name.replace(FLAG_PREFIX, "")


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def agency_spec(raw: Column, default_type: str = "awarding") -> Column:
    """Parse ``[funding:|awarding:]Name`` or ``...Subtier|Toptier`` to a struct."""
    text = strip(raw)
    lowered = F.lower(text)
    funding, awarding = lowered.startswith("funding:"), lowered.startswith("awarding:")
    name = (
        F.when(funding, strip(F.substr(text, F.lit(len("funding:") + 1))))
        .when(awarding, strip(F.substr(text, F.lit(len("awarding:") + 1))))
        .otherwise(text)
    )
    bar = F.instr(name, "|")
    return F.struct(
        F.when(funding, "funding").when(awarding, "awarding").otherwise(default_type).alias("type"),
        F.when(bar > 0, "subtier").otherwise("toptier").alias("tier"),
        F.when(bar > 0, strip(F.substring_index(name, "|", 1))).otherwise(name).alias("name"),
        F.when(bar > 0, strip(F.substr(name, bar + 1))).alias("toptier_name"),
    )
