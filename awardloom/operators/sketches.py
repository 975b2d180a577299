"""Column profiles that add up: kept for every file or run, and merged into those of a month without its rows.

Counts, sums and extremes add exactly. Distinct values are a HyperLogLog sketch and quantiles a KLL sketch, both mergeable
and of bounded size: a profile has one row a column and group, whatever the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import q

#: Bits of the HyperLogLog index and size of the KLL sketch.
LG_K, KLL_K = 12, 400
#: Stated errors, met in all but a few of a thousand cases: of distinct counts as a share, of quantiles as a share of ranks.
DISTINCT_ERROR, RANK_ERROR = 0.05, 0.015

#: Whole numbers and decimals, whose sums are exact; others have no sum here.
_EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)
_NUMBERS = (*_EXACT, T.FloatType, T.DoubleType)


def column_sketches(df: DataFrame, by: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """A row a group (``by``) and column: values, nulls, exact sum and extremes, text lengths, and both sketches.

    One pass; all columns in one aggregate. Columns by which it groups are not profiled; a group without rows has none.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    names = [c for c in (columns or df.columns) if c not in by]
    none = lambda kind: F.lit(None).cast(kind)

    def of(name: str) -> Column:
        col, kind = q(name), kinds[name]
        number, text = isinstance(kind, _NUMBERS), isinstance(kind, T.StringType)
        value = col.cast("double")
        return F.struct(
            F.lit(name).alias("column_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(col.isNull()).alias("null_count"),
            (F.sum(col.cast("decimal(38,2)")) if isinstance(kind, _EXACT) else none("decimal(38,2)")).cast("decimal(38,2)").alias("total"),
            (F.min(value) if number else none("double")).alias("least"),
            (F.max(value) if number else none("double")).alias("most"),
            (F.sum(F.length(col)) if text else none("bigint")).cast("bigint").alias("text_length"),
            (F.max(F.length(col)) if text else none("int")).cast("int").alias("longest"),
            F.hll_sketch_agg(col.cast("string"), LG_K).alias("distinct_sketch"),
            (F.kll_sketch_agg_double(value, KLL_K) if number else none("binary")).alias("quantile_sketch"),
        )

    return df.groupBy(*[q(c) for c in by]).agg(F.array(*[of(n) for n in names]).alias("x")).select(*[q(c) for c in by], F.inline("x"))


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of groups together, by column and perhaps by less than they were kept for."""
    return sketches.groupBy(*[q(c) for c in by], "column_name").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"),
        F.sum("total").cast("decimal(38,2)").alias("total"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.sum("text_length").alias("text_length"),
        F.max("longest").alias("longest"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
    )


def estimates(sketches: DataFrame) -> DataFrame:
    """The profile that sketches stand for: exact counts, sums and extremes, estimated distinct values and medians."""
    values = F.col("row_count") - F.col("null_count")
    some = F.col("least").isNotNull()  # a sketch without a number has no quantile
    return sketches.select(
        *[q(c) for c in sketches.columns if c not in ("distinct_sketch", "quantile_sketch")],
        F.when(values > 0, F.col("total") / values).cast("double").alias("mean"),
        F.when(values > 0, F.col("text_length") / values).alias("avg_length"),
        F.hll_sketch_estimate("distinct_sketch").alias("distinct_estimate"),
        F.when(some, F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(0.5))).alias("median_estimate"),
    )
