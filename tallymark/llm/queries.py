"""Registered queries of this subpackage beside their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallymark.llm import decontaminate, jaccard, language, licenses, packing, quality, reputation, resampling, sharding, suffixes, topk, warc, whitening
from tallymark.llm.common import table
from tallymark.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return keep


@query(sharding.SQL)
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 16)


@query(packing.sql())
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query(jaccard.SQL)
def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.documents_components(table(spark, sf_dir, "documents"))


@query(warc.SQL)
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_records(spark, table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))


@query()
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.documents_languages(table(spark, sf_dir, "documents"))


@query()
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.documents_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(licenses.sql())
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.documents_licenses(table(spark, sf_dir, "documents"))


@query(reputation.sql())
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = reputation.page_outcomes(table(spark, sf_dir, "labels"))
    return reputation.url_filter(table(spark, sf_dir, "pages"), outcomes)


@query(topk.SQL)
def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.embeddings_top(table(spark, sf_dir, "embeddings"))


@query(decontaminate.SQL)
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.documents_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.embeddings_whitened(table(spark, sf_dir, "embeddings"))


@query(resampling.SQL)
def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.documents_draw(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.documents_repeats(table(spark, sf_dir, "documents"))
