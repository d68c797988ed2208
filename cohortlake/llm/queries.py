"""The registered queries of this subpackage, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.llm import (
    ann,
    bpe,
    extraction,
    minhash,
    mixing,
    ngram_lm,
    pii,
    resample,
    semdedup,
    tokenfiles,
    toxicity,
    variants,
    warc,
)
from cohortlake.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name, with its SQL if there is any."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLE_SQL[function.__name__] = sql.strip()
        return function

    return register


@query()
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query()
def op2_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages")).drop("blocks")


@query()
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoding_digests(table(spark, sf_dir, "documents"))


@query()
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.token_files(table(spark, sf_dir, "documents"))


@query()
def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query()
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages")).select(
        "page_id",
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to"),
    )


@query()
def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.scores(table(spark, sf_dir, "documents"))


@query()
def op9_semdedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return semdedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query(mixing.SQL)
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query(variants.SQL)
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


@query()
def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digests(table(spark, sf_dir, "documents"))


@query(resample.SQL)
def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
