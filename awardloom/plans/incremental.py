"""Incremental pull as a data job: request predicate, duplicate removal, shard partitions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import safe_slug
from ..operators import filters, planning
from ..schema import SHARD_DAYS, q
from ..sources import sinks

PARTITION_KEYS = ("award_group", "shard", "agency_slug")


def shard_rows(
    df: DataFrame,
    groups: Sequence[str] | None,
    first: dt.date,
    last: dt.date,
    agency_column: str | None = None,
    chunk_days: int = SHARD_DAYS,
) -> DataFrame:
    """Rows of the requested groups and dates, labelled with group, shard and agency slug."""
    wanted = filters.codes_of(groups or ["contracts"])
    rows = filters.with_award_group(df.filter(F.col("award_type_code").isin(*wanted)))
    rows = planning.with_shard(rows, "action_date", first, last, chunk_days)
    slug = safe_slug(q(agency_column)) if agency_column else F.lit("all")
    return (
        rows.withColumn("award_group", safe_slug(F.col("award_group")))
        .withColumn("shard", planning.shard_label(F.col("shard_start"), F.col("shard_end")))
        .withColumn("agency_slug", slug)
        .drop("shard_start", "shard_end")
    )


def planned_shards(bounds: DataFrame, groups: Sequence[str], agencies: Sequence[str], chunk_days: int = SHARD_DAYS) -> DataFrame:
    """The shards of a pull under the labels that ``shard_rows`` gives them, with their bounds, whether they have rows or not."""
    planned = planning.plan_shards(bounds, groups, agencies, chunk_days)
    return planned.select(
        safe_slug(F.col("award_group")).alias("award_group"),
        planning.shard_label(F.col("shard_start"), F.col("shard_end")).alias("shard"),
        safe_slug(F.coalesce("agency", F.lit("all"))).alias("agency_slug"),
        "shard_start",
        "shard_end",
    )


def write_shards(rows: DataFrame, path: str) -> str:
    """Replace the partitions that ``rows`` covers; a repeated pull gives the same table."""
    return sinks.write_partitions(rows, path, PARTITION_KEYS)
