"""A training corpus from raw documents: toxicity, language, near duplicates, packing.

Each stage takes the documents that its predecessor kept, read back from Parquet; all but the last return
the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from awardloom.llm import hyperminhash, langid, packing, toxicity
from awardloom.llm.common import written

SEQUENCE = packing.Limits(tokens=1024, segments=64, loss=640)
END_ID = 0


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic by a model of all labelled documents."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity.keep_clean(spark, docs, toxicity.fit(spark, docs, labels))


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is accepted."""
    return langid.keep_accepted(spark, docs, langid.fit(spark, docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity of 0.8) the row of the smallest id."""
    return hyperminhash.keep_rows(spark, docs, size=5, percent=80)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row a piece of a packed sequence."""
    return packing.pack_texts(spark, docs, public_tokenizers.path("byte_bpe_50k.json"), END_ID, SEQUENCE)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unknown_language),
    ("near_duplicates", drop_near_duplicates),
    ("packing", pack),
]

#: The stages' models and random registers have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"pipeline-{name}")
    return docs
