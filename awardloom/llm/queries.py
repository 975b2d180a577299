"""The registered queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_dir
from . import ballkmeans, bpe, eliasfano, grayindex, hmm, hyperminhash, imatch, kdtree, langid, multiindex, packing, toxicity, warc
from .common import crc_mod
from .oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

#: Sequence length and the ids that end a document are fixed by the queries' contracts; of a sequence's tokens at most five eighths bear loss.
SEQUENCE = packing.Limits(tokens=1024, segments=64, loss=640)
WORD_END_ID, BYTE_END_ID = 2, 0
#: Fetch date of the crawl that the pages table stands for.
CRAWL_DATE = "2024-01-01T00:00:00Z"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive(warc.responses(table(spark, sf_dir, "pages"), CRAWL_DATE))


def op2_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_documents(spark, table(spark, sf_dir, "documents"), crc_mod("doc_id", 5) == 1)


def op3_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(spark, docs, table(spark, sf_dir, "labels"), crc_mod("doc_id", 4) != 2)
    scored = toxicity.score(spark, docs, model)
    return scored.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "score", "predicted", "passages")


def op4_elias_fano(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    files = eliasfano.write_token_files(spark, table(spark, sf_dir, "documents"), path, WORD_END_ID, fresh_dir(spark, "token-ids"))
    return eliasfano.digest_token_files(spark, files)


def op5_kneser_ney_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    predicted = langid.fit_predict(spark, docs, crc_mod("doc_id", 3) != 1)
    return predicted.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "accepted")


def op6_kd_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdtree.top_k(spark, table(spark, sf_dir, "embeddings"), 5, 256.0, F.col("vec_id") % 50 == 0)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(spark, table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op8_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_texts(spark, table(spark, sf_dir, "documents"), path, BYTE_END_ID, SEQUENCE)


def op9_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.compare_edits(spark, table(spark, sf_dir, "documents"))


def op10_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(spark, table(spark, sf_dir, "documents"), size=4, percent=80)


def op11_ball_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = ballkmeans.compress(spark, table(spark, sf_dir, "embeddings"))
    return codes.select("vec_id", "code", "error", "label_error", F.lit(ballkmeans.digest(books)).alias("codebooks_sha256"))


def op12_gray_order_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grayindex.near_duplicates(spark, table(spark, sf_dir, "documents"), size=3, most=2)


def op13_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return multiindex.mine(spark, rows.withColumn("label", shifted), F.col("vec_id") % 100 == 0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_warc_derivatives": op1_warc_derivatives,
    "op2_hidden_markov": op2_hidden_markov,
    "op3_toxic_segments": op3_toxic_segments,
    "op4_elias_fano": op4_elias_fano,
    "op5_kneser_ney_language": op5_kneser_ney_language,
    "op6_kd_trees": op6_kd_trees,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_vector_packing": op8_vector_packing,
    "op9_imatch": op9_imatch,
    "op10_hyperminhash": op10_hyperminhash,
    "op11_ball_kmeans": op11_ball_kmeans,
    "op12_gray_order_index": op12_gray_order_index,
    "op13_inverted_multi_index": op13_inverted_multi_index,
    "pipeline": pipeline,
}
