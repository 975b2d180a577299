"""I-Match document fingerprints with randomised lexicon subsets, by DataFrame operations only.

The lexicon is the terms (runs of letters and digits, lower case) whose document frequency lies in a band,
in shares of all documents: terms that say something about a text, but are no accidents of one. As every
term of the band occurs in at least a share ``low`` of the documents, it has at most (mean distinct terms
of a document) / ``low`` terms, whatever the number of documents, and may be broadcast. A document keeps its distinct
terms of the lexicon, sorted. For each of 64 random subsets of the lexicon (sixteen each with a 16th, a
64th, a 256th and a 1024th of the terms) the kept terms in the subset are joined and hashed; no term gives no
hash. The fingerprint is the list of hashes. A document with no term in the lexicon has the hash of its
whole text instead. The likeness of two fingerprints is the share of equal hashes among those that either has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import written

#: Band of document frequency, as shares of all documents, and in documents at least.
LOW, HIGH, LEAST = 0.001, 0.02, 2
#: Subsets, and the bounds below which the hexadecimal hash of (subset, term) puts a term in: 1/16 to 1/1024.
SUBSETS, BOUNDS = 64, ("10", "04", "01", "004")
#: What separates terms.
APART = "[^\\p{L}\\p{N}]+"
HASH_DIGITS = 8


def terms(text: Column) -> Column:
    """Distinct terms of a text."""
    return F.array_except(F.split(F.lower(text), APART), F.array(F.lit("")))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """k, h name a document: its id (nulls told apart in h) and a hash of its text; equal rows share the name."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("k"),
        F.xxhash64(text, F.col(id_col).isNull()).alias("h"),
        text.alias("text"),
    )


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """term, mask: the terms of the band, and the subsets that hold each as bits. ``docs`` has k, h, text."""
    n = docs.count()
    listed = docs.select(F.explode(terms(F.col("text"))).alias("term"))
    kept = listed.groupBy("term").agg(F.count(F.lit(1)).alias("df")).where(F.col("df").between(max(LEAST, low * n), max(LEAST, high * n)))
    bits = [
        F.when(F.md5(F.concat(F.lit(f"{j}:"), F.col("term"))) < BOUNDS[j // 16], F.lit(1 << j if j < 63 else -(1 << 63))).otherwise(F.lit(0))
        for j in range(SUBSETS)
    ]
    mask = bits[0].cast("long")
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit.cast("long"))
    return kept.select("term", mask.alias("mask"))


def kept_terms(texts: DataFrame, lexicon_terms: DataFrame) -> DataFrame:
    """k, h, kept: each document's sorted (term, mask) of the lexicon; documents with none are missing."""
    rows = texts.select("k", "h", F.explode(terms(F.col("text"))).alias("term"))
    found = rows.join(F.broadcast(lexicon_terms), "term")
    return found.groupBy("k", "h").agg(F.sort_array(F.collect_set(F.struct("term", "mask"))).alias("kept"))


def fingerprint(kept: Column) -> Column:
    """The subsets' hashes (null: no term) of the sorted kept terms."""
    masks = F.array(*[F.lit(1 << j if j < 63 else -(1 << 63)).cast("long") for j in range(SUBSETS)])

    def one(bit: Column) -> Column:
        inside = F.filter(kept, lambda t: t["mask"].bitwiseAND(bit) != 0)
        joined = F.array_join(F.transform(inside, lambda t: t["term"]), " ")
        return F.when(F.length(joined) > 0, F.substring(F.md5(joined), 1, HASH_DIGITS))

    return F.transform(masks, one)


def or_whole(prints: Column, text_hash: Column) -> Column:
    """The fingerprint, or where no subset has a term, the hash of the whole text in a place of its own."""
    nothing = F.coalesce(F.forall(prints, lambda x: x.isNull()), F.lit(True))
    empty = F.array_repeat(F.lit(None).cast("string"), SUBSETS)
    return F.when(nothing, F.concat(empty, F.array(text_hash))).otherwise(F.concat(prints, F.array(F.lit(None).cast("string"))))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among those that either fingerprint has."""
    count = lambda c: F.size(F.filter(c, lambda x: x)).cast("double")
    equal = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    either = F.zip_with(a, b, lambda x, y: x.isNotNull() | y.isNotNull())
    return count(equal) / count(either)


def rendered(prints: Column) -> Column:
    """A fingerprint as text, which is what travels: far smaller than the list."""
    return F.array_join(prints, ".", "-")


def hashes(text: Column) -> Column:
    """The list of hashes of a rendered fingerprint."""
    return F.transform(F.split(text, "\\."), lambda x: F.nullif(x, F.lit("-")))


def successors(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, k, h, n_chars, next_k, next_h, next_t: the next document in descending id order (nulls last, ties by h), the
    first after the last; t is the hash of its whole text.

    Ids alone are sorted, over range partitions; only one row a partition meets in one place.
    """
    ids = docs.select("doc_id", "k", "h", F.length("text").alias("n_chars"), _text_hash("text").alias("t")).distinct()
    down = [F.desc_nulls_last("doc_id"), F.asc("h")]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(ids.repartitionByRange(n, *down).withColumn("part", F.spark_partition_id()), "ordered-ids")
    this = F.struct("k", "h", "t")
    within = Window.partitionBy("part").orderBy(*down)
    linked = ranged.withColumn("next", F.lead(this).over(within))
    first = ranged.withColumn("r", F.row_number().over(within)).where("r = 1").select("part", this.alias("head"))
    parts = Window.orderBy("part")  # one row a range partition
    heads = first.select("part", F.coalesce(F.lead("head").over(parts), F.first("head").over(parts)).alias("after"))
    out = linked.join(F.broadcast(heads), "part").withColumn("next", F.coalesce("next", "after"))
    return out.select("doc_id", "k", "h", "n_chars", *[F.col(f"next.{c}").alias(f"next_{c}") for c in ("k", "h", "t")])


def edited_texts(docs: DataFrame, order: DataFrame) -> DataFrame:
    """k, h, text, edited of each row: its last third gives way to the beginning of the next document."""
    wanted = order.select(F.col("next_k").alias("k"), F.col("next_h").alias("h"), F.col("k").alias("to_k"), F.col("h").alias("to_h"), F.floor(F.col("n_chars") / 3).cast("int").alias("cut"))
    donors = docs.select("k", "h", "text").join(wanted, ["k", "h"])
    donors = donors.select(F.col("to_k").alias("k"), F.col("to_h").alias("h"), F.substring("text", F.lit(1), F.col("cut")).alias("tail"))
    donors = donors.groupBy("k", "h").agg(F.max("tail").alias("tail"))  # a repeated donor row gives the same tail
    n = F.length("text")
    whole = docs.select("k", "h", "text").join(donors, ["k", "h"])
    return whole.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - F.floor(n / 3).cast("int")), F.col("tail")))


def fingerprints(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", low: float = LOW, high: float = HIGH) -> DataFrame:
    """doc_id, fingerprint (list of hashes) of each row. A null text is an empty one; equal texts have equal
    fingerprints; repeated rows repeat; an empty table gives no rows."""
    table = keyed(docs, id_col, text_col)
    words = written(lexicon(table, low, high), "lexicon")
    kept = kept_terms(table, words).select("k", "h", fingerprint(F.col("kept")).alias("p"))
    joined = table.join(kept, ["k", "h"], "left")
    return joined.select("doc_id", or_whole(F.col("p"), _text_hash("text")).alias("fingerprint"))


def _text_hash(column: str) -> Column:
    return F.substring(F.md5(column), 1, HASH_DIGITS)


def compare_edits(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", low: float = LOW, high: float = HIGH) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of each row.

    The edited text is the text with its last floor(n / 3) characters replaced by as many from the beginning of the
    next document in descending id order. Rows equal in id and text share their successor; of rows that share
    an id only, the order is by a hash of the text; null ids come last. A single document is its own successor.
    """
    table = keyed(docs, id_col, text_col)
    words = written(lexicon(table, low, high), "lexicon")
    order = written(successors(spark, table), "successors")
    # The texts' own hashes come from the texts as they lie, so that only kept terms move, and meet both neighbours as written.
    prints = written(kept_terms(table, words).select("k", "h", rendered(fingerprint(F.col("kept"))).alias("own")), "fingerprints")
    other = prints.select(F.col("k").alias("next_k"), F.col("h").alias("next_h"), F.col("own").alias("other"))
    nexts = order.select("doc_id", "k", "h", "next_k", "next_h", "next_t").join(other, ["next_k", "next_h"], "left")
    nexts = nexts.select("doc_id", "k", "h", "next_t", "other")
    both = edited_texts(table, order)
    facts = both.select("k", "h", F.length("text").alias("n_chars"), _text_hash("text").alias("t"), _text_hash("edited").alias("e"), F.sha2("edited", 256).alias("edited_sha256"))
    changed = kept_terms(both.select("k", "h", F.col("edited").alias("text")), words).select("k", "h", fingerprint(F.col("kept")).alias("q"))
    whole = facts.join(prints, ["k", "h"], "left").join(changed, ["k", "h"], "left").join(nexts, ["k", "h"])
    whole = whole.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256", or_whole(hashes(F.col("own")), F.col("t")).alias("p"),
        or_whole(F.col("q"), F.col("e")).alias("q"), or_whole(hashes(F.col("other")), F.col("next_t")).alias("o"),
    )
    return whole.select(
        "doc_id", "n_chars", "edited_sha256", rendered(F.col("p")).alias("fingerprint"), rendered(F.col("q")).alias("edited_fingerprint"),
        likeness(F.col("p"), F.col("q")).alias("near_edited"), likeness(F.col("p"), F.col("o")).alias("near_next"),
    )
