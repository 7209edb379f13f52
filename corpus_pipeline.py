"""From raw documents to packed training sequences: five stages, each reading all that the one before kept."""

from __future__ import annotations

from collections.abc import Iterable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homespan.llm import decontamination, language, packing, toxicity
from homespan.llm.common import stored, table
from homespan.llm.minhash import near_duplicates


def _apart(docs: DataFrame, names: Iterable[str]) -> tuple[DataFrame, dict[str, str]]:
    """Columns of the documents that an operator would add under the same name, under private names, and how to turn back."""
    taken = {n.lower() for n in names}
    private = {c: f"of documents: {c}" for c in docs.columns if c.lower() in taken}
    return docs.withColumnsRenamed(private), {p: c for c, p in private.items()}


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is told; texts without letters or spread over languages go."""
    rows, back = _apart(docs, ("lang_pred", "lang_score"))
    found = language.identify(rows, language.fit_languages(docs))
    kept = (F.col("lang_pred") != language.UNKNOWN) & (F.col("lang_score") >= language.LEAST_SCORE)
    return found.filter(kept).select(*rows.columns).withColumnsRenamed(back)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the last model of the chain calls toxic go."""
    chain = toxicity.fit_chain(docs, table(spark, sf_dir, "labels"))
    rows, back = _apart(docs, [f"p_{n}" for n in chain.names])
    scored = toxicity.score_toxicity(rows, chain)
    return scored.filter(F.col("p_toxic") < toxicity.TOXIC_FROM).select(*rows.columns).withColumnsRenamed(back)


OTHER_TEXTS = 1 << 62
FEW_IDS = 500_000


def _text_ids(docs: DataFrame) -> DataFrame:
    """Add ``text id``: the id of the document, or a number of its own for a text whose id is null or stands for another text."""
    mark = F.xxhash64("text")
    several = docs.groupBy("doc_id").agg(F.min(mark).alias("first text"), F.max(mark).alias("last text"))
    several = several.filter("`first text` <> `last text` and doc_id is not null").select(F.col("doc_id").alias("told id"), "first text")
    several = stored(several)
    if (ids := several.count()) == 0:
        joined = docs.withColumn("first text", F.lit(None).cast("long"))
    else:  # texts need not be shuffled for few such ids
        joined = docs.join(F.broadcast(several) if ids <= FEW_IDS else several, F.col("doc_id") == F.col("told id"), "left")
    other = F.lit(OTHER_TEXTS) + F.pmod(F.xxhash64("doc_id", "text"), F.lit(OTHER_TEXTS - 1))
    of_another = F.col("first text").isNotNull() & (mark != F.col("first text"))
    own = F.when(F.col("doc_id").isNull() | of_another, other).otherwise(F.col("doc_id").cast("long"))
    return joined.select(*docs.columns, own.alias("text id"))


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest id.

    Texts count, not ids: unrelated texts under one id both stay, a text without id stays unless it is a copy, equal
    rows stay once. Of rows that differ in other columns alone, the one with the smallest hash stays.
    """
    rows = _text_ids(docs)
    classes = near_duplicates(rows.select(F.col("text id").alias("doc_id"), "text"), shingle=5, percent=80)
    kept = stored(classes.filter("kept").groupBy(F.col("doc_id").alias("text id")).agg(F.count("*").alias("times")))
    single = rows.join(kept.filter("times = 1"), "text id", "left_semi").select(*docs.columns)
    repeated = rows.join(kept.filter("times > 1"), "text id", "left_semi")
    whole = F.struct(*docs.columns)
    first = repeated.groupBy("text id").agg(F.min_by(whole, F.xxhash64(F.to_json(whole))).alias("row"))
    return single.unionByName(first.select("row.*").select(*docs.columns))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of ten words and more of benchmark items are cut; documents that are half passages go."""
    return decontamination.remove_passages(docs, table(spark, sf_dir, "benchmark"), window=10, longest=0, coverage=0.5)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, with their ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxic),
    ("near_dedup", near_duplicate),
    ("decontamination", benchmark_passages),
    ("packing", sequences),
]

#: Trained models and subword ids have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = stored(docs)
    return docs
