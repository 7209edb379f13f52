"""Registered queries of the operators; each reads its whole table and derives the columns to compare."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homespan.llm import attention_lm, chat, decontamination, kdsearch, language, licenses, middles, packing, toxicity, warc
from homespan.llm.common import id_remainder, table
from homespan.llm.hyperplanes import near_vectors
from homespan.llm.minhash import near_duplicates
from homespan.llm.whitening import whiten

WORD_PIECES = public_tokenizers.path("word_bpe_49k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.piece_columns(packing.pack(table(spark, sf_dir, "documents"), WORD_PIECES))


def op2_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.derive(warc.responses(table(spark, sf_dir, "pages")))
    return records.select(
        "page_id", "record_type", "record_id", "refers_to", "concurrent_to", "target_uri", "block_digest",
        "payload_digest", "content_length", F.sha2("headers", 256).alias("headers_sha256"),
    )


def op3_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    scored = attention_lm.score_texts(documents, id_remainder("doc_id", 7) != 2, WORD_PIECES)
    return scored.select(
        "doc_id", (id_remainder("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    net = language.fit_languages(documents.filter(id_remainder("doc_id", 3) != 1))
    rows = documents.select("doc_id", (id_remainder("doc_id", 3) == 1).alias("held_out"), "text")
    found = language.identify(rows, net)
    return found.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))


def op5_kd_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), kdsearch.whole_numbers("embedding").alias("vector")
    )
    return kdsearch.top_k(vectors, vectors.filter("id % 50 = 0"), k=5)


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4, percent=80)


def op7_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = "</s>[INST] ok [/INST]"
    probe = spark.range(2).selectExpr(
        "-1L AS conv_id", "id AS turn", "if(id = 0, 'user', 'assistant') AS role", f"'{told}' AS text"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat.read_back(chat.chat_windows(rows))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.size("licenses").cast("long").alias("n_passages"),
        F.array_join(F.transform("licenses", lambda p: p["license"]), ",").alias("licenses"),
        F.coalesce(F.array_max(F.transform("licenses", lambda p: p["coverage"])), F.lit(0.0)).alias("best_coverage"),
        F.aggregate("licenses", F.lit(0).cast("long"), lambda n, p: n + p["end_word"] - p["first_word"]).alias("n_words"),
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.fit_chain(documents, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(documents, chain).drop("text")
    return scored.withColumn("toxic", F.col("p_toxic") >= toxicity.TOXIC_FROM)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.digest_columns(decontamination.passages(documents, table(spark, sf_dir, "benchmark")))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return middles.digest_columns(middles.fill_in_middle(table(spark, sf_dir, "documents")))


def op12_hyperplane_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.93)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deviations as longs; null where one does not fit."""
    white = whiten(table(spark, sf_dir, "embeddings"), most=16)
    return white.withColumn("deviation", F.col("deviation").try_cast("long"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_packing, op2_warc_derivatives, op3_attention_lm, op4_language_id, op5_kd_top_k, op6_minhash_near_dedup,
        op7_chat_windows, op8_license_scan, op9_toxicity, op10_decontamination, op11_fill_in_middle,
        op12_hyperplane_dedup, op13_whitening,
    )
}
