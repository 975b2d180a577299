"""Union by name and key-based duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import AWARD_KEYS, SEARCH_KEYS, q
from ..session import stored

#: Where a row lies in a stored table: the number of its file, and its number there.
PLACE = ("_file", "_index")
#: Rows of a file that one block of marks covers, a bit each; blocks that are sent to every task, at most (64 MB, half a
#: billion rows).
BLOCK_BITS = 15
BLOCK = 1 << BLOCK_BITS
#: A place as one number: the row's number in its file in the low bits, the file's above.
FILE_BITS = 40
SENT_BLOCKS = 1 << 14


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; a column one side lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def present_keys(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [k for k in keys if k in df.columns]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in ``order``; null keys equal each other; no key present is a no-op.

    ``row_number() = 1`` lets Spark plan a group limit on both sides of the exchange: each task
    keeps one row per key before shuffling, so a key that holds a third of all rows sends one
    row per task and no reducer sees the whole group.
    """
    present = present_keys(df, keys)
    if not present:
        return df
    first = Window.partitionBy(*[q(k) for k in present]).orderBy(*[q(c) for c in order])
    return df.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")


def placed(table: DataFrame) -> DataFrame:
    """The rows of a Parquet scan, of files of different names, with their places: files are numbered in the order of their names."""
    names = sorted({unquote(p.rsplit("/", 1)[-1]) for p in table.inputFiles()})
    numbers = table.sparkSession.createDataFrame(list(enumerate(names)), f"{PLACE[0]} bigint, _name string")
    rows = table.select("*", F.col("_metadata.file_name").alias("_name"), F.col("_metadata.row_index").alias(PLACE[1]))
    known = F.coalesce(F.col(PLACE[0]), F.raise_error(F.concat(F.lit("file not listed: "), "_name")).cast("bigint"))
    met = rows.join(F.broadcast(numbers), "_name", "left")
    return met.select(*[q(c) for c in table.columns], known.alias(PLACE[0]), PLACE[1])


def _marks(places: DataFrame) -> DataFrame:
    """Places, a number each, as a bit a row: file, block and the words of the block, for blocks with a place."""
    # Dealt by block, in which all further grouping is local.
    dealt = places.select(F.shiftright("at", BLOCK_BITS).alias("p"), (F.col("at") % BLOCK).cast("int").alias("r")).repartition("p")
    bits = dealt.select("p", F.floor(F.col("r") / 64).cast("int").alias("w"), F.expr("shiftleft(1L, r % 64)").alias("b"))
    words = bits.groupBy("p", "w").agg(F.bit_or("b").alias("b")).groupBy("p").agg(F.map_from_entries(F.collect_list(F.struct("w", "b"))).alias("m"))
    filled = F.transform(F.sequence(F.lit(0), F.lit(BLOCK // 64 - 1)), lambda i: F.coalesce(F.element_at("m", i), F.lit(0).cast("bigint")))
    shift = FILE_BITS - BLOCK_BITS
    return words.select(F.shiftright("p", shift).alias(PLACE[0]), (F.col("p") % (1 << shift)).cast("int").alias("_block"), filled.alias("_marks"))


def _met(rows: DataFrame, marks: DataFrame, how: str) -> tuple[DataFrame, Column]:
    """Rows with the marks of their block, and whether a row's own bit is set."""
    block, word, bit = F.floor(F.col(PLACE[1]) / BLOCK).cast("int"), ((F.col(PLACE[1]) % BLOCK) / 64).cast("int"), (F.col(PLACE[1]) % 64).cast("int")
    marks = F.broadcast(marks) if marks.count() <= SENT_BLOCKS else marks.hint("shuffle_hash")
    met = rows.withColumn("_block", block).join(marks, [PLACE[0], "_block"], how)
    return met, F.coalesce(F.getbit(F.get("_marks", word), bit), F.lit(0)) == 1


def keep_first_placed(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """As ``keep_first``, of rows with places: the rows stay where they lie, only hashes and places are exchanged of most of them.

    A row whose key's hash no other row has is the first of its key. Only of all other rows keys, order and places are sorted and
    exchanged. The places of the first rows become a stored table of marks, a bit a row of each file, and the rows meet the marks of
    their block. Ties in ``order`` go by place. ``rows`` is scanned three times and should be a projection or filter of one stored table.
    """
    present = present_keys(rows, keys)
    if not present:
        return rows.drop(*PLACE)
    at = (F.shiftleft(F.col(PLACE[0]), FILE_BITS) + F.col(PLACE[1])).alias("at")
    hashed = rows.select(F.xxhash64(*[q(k) for k in present]).alias("h"), at)
    once = hashed.groupBy("h").agg(F.count("*").alias("n"), F.min("at").alias("at")).filter("n = 1")
    single = stored(_marks(once), "single-rows")
    narrow, is_single = _met(rows.select(*[q(c) for c in dict.fromkeys([*present, *order])], *PLACE), single, "left")
    first = keep_first(narrow.filter(~is_single).drop("_block", "_marks"), present, [*order, *PLACE])
    both = single.unionByName(_marks(first.select(at))).groupBy(PLACE[0], "_block").agg(F.collect_list("_marks").alias("l"))
    either = F.when(F.size("l") == 1, F.col("l")[0]).otherwise(F.zip_with(F.col("l")[0], F.col("l")[1], lambda x, y: x.bitwiseOR(y)))
    met, is_first = _met(rows, stored(both.select(PLACE[0], "_block", either.alias("_marks")), "first-rows"), "inner")
    return met.filter(is_first).select(*[q(c) for c in rows.columns if c not in PLACE])


def dedup_awards(df: DataFrame, order: Sequence[str]) -> DataFrame:
    return keep_first(df, AWARD_KEYS, order)


def dedup_search(df: DataFrame, order: Sequence[str]) -> DataFrame:
    return keep_first(df, SEARCH_KEYS, order)


def dedup_accounting(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows before and after duplicate removal; counts per key are combined before the shuffle."""
    present = present_keys(df, keys)
    if not present:
        total = F.count("*")
        return df.agg(total.alias("rows_before"), total.alias("rows_after"), F.lit(0).cast("bigint").alias("rows_removed"))
    per_key = df.groupBy(*[q(k) for k in present]).agg(F.count("*").alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_before"), F.count("*").alias("rows_after")
    ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))
