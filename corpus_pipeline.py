"""From documents to packed batches of clean text: five stages, each one operator over all that the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import decontaminate, jaccard, language, packing, quality
from tallymark.llm.common import forget, fresh, saved, set_aside, table, unshare

#: A text whose language is less certain than this is rejected, as is one without a letter.
LEAST_SCORE = 0.3
#: Near duplicates share 80 % of their five-word shingles.
NEAR = jaccard.Likeness(width=5, num=80, den=100)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a recognised language; the machines learn from the documents' own `lang`."""
    unshare()
    out, score = (fresh(c, docs.columns) for c in ("predicted_lang", "predicted_score"))
    found = language.predict(docs, language.fit(docs), out=out, score=score)
    return found.filter((F.col(out) != language.UNKNOWN) & (F.col(score) >= LEAST_SCORE)).select(*docs.columns)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely good than of low quality or toxic."""
    unshare()
    rows, now = set_aside(docs, quality.RESULTS)
    kept = quality.classify(rows, table(spark, sf_dir, "labels")).filter("keep")
    return kept.select(*[F.col(f"`{n}`").alias(c) for c, n in now.items()])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    unshare()
    return jaccard.one_of_each(docs, like=NEAR)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    unshare()
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and each document's bucket, batch and place."""
    unshare()
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", known_language),
    ("quality_classifier", good_quality),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", without_benchmark),
    ("packing", packed),
]

#: Fitted models are no SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = saved(docs, name)
            forget(before)
    return docs
