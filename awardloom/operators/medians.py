"""Exact medians without gathering values.

``median`` keeps every distinct value of a column in one aggregation buffer. Here the median is
found by narrowing: count rows per coarse interval, pick the interval that holds the wanted rank,
count again inside it with finer intervals, and so on. Each count is combined in the map tasks
and has at most 200,000 intervals per column whatever the row count, so neither a hot value nor a
huge column can overload a task. The cost is one narrow scan per level.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import quoted, text_literal

# Interval widths in whole units. DECIMAL(20,2) has at most 18 integer digits, so the first level
# has at most 200,000 intervals and the next two 100,000; the last level is hundredths.
WIDTHS = (10**13, 10**8, 10**3)


def flag_median(true_count: str, present: str) -> Column:
    """Median of a boolean column as 0/1: its two middle ranks follow from two counts."""
    false_count = f"({present} - {true_count})"
    low = f"int(({present} + 1) div 2 > {false_count})"
    high = f"int({present} div 2 + 1 > {false_count})"
    return F.expr(f"CASE WHEN {present} > 0 THEN ({low} + {high}) / 2.0D END")


def _interval(level: int) -> str:
    """Start of the interval of whole units that the value falls into."""
    return f"d - pmod(d, {WIDTHS[level]}L)"


def on_grid(data_type: T.DataType) -> bool:
    """Whether DECIMAL(20,2) holds every value of the type."""
    if isinstance(data_type, T.DecimalType):
        return data_type.scale <= 2 and data_type.precision - data_type.scale <= 18
    return isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType))


def exact_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, median)`` per numeric column; null where all values are null.

    Money and small integers are searched on the grid of hundredths, all columns at once; any other number
    within its observed range. ``df`` should be a stored table: it is read once per level, only the named columns of it.
    """
    grid = [c for c in columns if on_grid(df.schema[c].dataType)]
    found = [_grid_medians(df, grid)] if grid else []
    rest = [(c, range_median(df, c)) for c in columns if c not in grid]
    if rest or not found:
        found.append(df.sparkSession.createDataFrame(rest, "column_name string, median double"))
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def range_median(df: DataFrame, column: str) -> float | None:
    """Exact median of one numeric column of any type: its two middle values, averaged.

    Each level cuts the observed range of the values that may still hold a middle rank into ``CUTS`` intervals,
    counts them (with their least and largest value) in the map tasks, and goes on inside the one that holds
    the rank, until that has one value only. NaN counts as missing.
    """
    values = df.select(F.col(f"`{column}`").alias("v")).filter("v IS NOT NULL AND NOT isnan(cast(v AS double))")
    low, high, n = values.agg(F.min("v"), F.max("v"), F.count("v")).first()
    if not n:
        return None
    middle = [ranked_value(values, low, high, rank) for rank in sorted({(n + 1) // 2, n // 2 + 1})]
    return sum(float(m) for m in middle) / len(middle)


# Intervals of one level of the range search.
CUTS = 100_000


def ranked_value(values: DataFrame, low, high, rank: int):
    """The value of a rank (from 1) among the values from ``low`` to ``high``."""
    while low != high:
        inside = values.filter(F.col("v").between(F.lit(low), F.lit(high)))
        width = float(high) - float(low)
        x = F.col("v").cast("double")
        if 0 < width < float("inf"):
            place = F.least(F.floor((x - float(low)) / width * CUTS), F.lit(CUTS - 1))
        else:  # wider than any double, or too close for doubles to tell apart
            place = F.signum(x) if width else F.col("v")
        counts = inside.groupBy(place.alias("b")).agg(F.count("v").alias("n"), F.min("v").alias("a"), F.max("v").alias("z"))
        upto = counts.withColumn("upto", F.sum("n").over(Window.orderBy("b")))  # at most CUTS rows
        at = upto.filter(F.col("upto") >= rank).orderBy("b").first()
        rank -= at.upto - at.n
        low, high = at.a, at.z
    return low


def _grid_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, median)`` of columns on the grid of hundredths."""
    cells = ", ".join(
        f"named_struct('column_name', {text_literal(c)}, 'v', cast({quoted(c)} AS decimal(20,2)))" for c in columns
    )
    # d grows with v; that is all the intervals need.
    values = df.selectExpr(f"inline(array({cells}))").filter("v IS NOT NULL").selectExpr(
        "column_name", "v", "cast(v AS bigint) AS d"
    )
    counts = (
        values.selectExpr("column_name", f"{_interval(0)} AS b")
        .groupBy("column_name", "b")
        .agg(F.count("*").alias("n"))
        .selectExpr("column_name", "0L AS p", "b", "n", "sum(n) OVER (PARTITION BY column_name) AS total")
        # lo and hi are the ranks of the lower and the upper middle value inside interval p.
        .selectExpr("column_name", "p", "b", "n", "(total + 1) div 2 AS lo", "total div 2 + 1 AS hi")
    )
    found = _narrow(counts, "b")
    for level in range(1, len(WIDTHS) + 1):
        last = level == len(WIDTHS)
        # One or two intervals per column are still open: a broadcast of a few rows.
        inside = values.selectExpr("column_name", "v", "d", f"{_interval(level - 1)} AS p").join(
            F.broadcast(found), ["column_name", "p"]
        )
        finer = "cast((v - p) * 100 AS bigint)" if last else _interval(level)
        counts = (
            inside.selectExpr("column_name", "p", "lo", "hi", f"{finer} AS b")
            .groupBy("column_name", "p", "lo", "hi", "b")
            .agg(F.count("*").alias("n"))
        )
        found = _narrow(counts, "cast(p + b / 100bd AS decimal(20,2))" if last else "b")
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    medians = found.groupBy("column_name").agg(F.avg("p").cast("double").alias("median"))
    return names.join(F.broadcast(medians), "column_name", "left")


def _narrow(counts: DataFrame, start: str) -> DataFrame:
    """Keep the intervals that hold a middle rank, with the rank counted from their start."""
    upto = counts.selectExpr(
        "*", "sum(n) OVER (PARTITION BY column_name, p ORDER BY b ROWS UNBOUNDED PRECEDING) AS upto"
    )
    rank = "CASE WHEN upto - n < {0} AND {0} <= upto THEN {0} - upto + n END AS {0}"
    return upto.selectExpr("column_name", f"{start} AS p", rank.format("lo"), rank.format("hi")).filter(
        "lo IS NOT NULL OR hi IS NOT NULL"
    )
