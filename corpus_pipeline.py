"""Corpus pipeline: stages that each take the documents their predecessor kept.

Every stage is written as Parquet in the shared folder and read again.  All but
the last keep the columns of ``documents``; the last adds ``mix_copy`` and
repeats documents as the mix asks.

Labels and languages are learned only from rows whose crc32(doc_id as text)
modulo 4 is not 2.  An empty table stays empty; null texts are documents
without words, which language identification rejects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histlake.llm import decontaminate, jaccard_join, lang_id, mixing, quality
from histlake.llm.common import cut, held_out, table
from histlake.session import scratch_dir

#: Least probability of good quality that a document needs to stay.
LEAST_QUALITY = 0.7


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: keeps documents that score ``LEAST_QUALITY`` or more."""
    counts = cut(quality.with_counts(docs))
    model = quality.fit(counts.filter(~held_out("id")), quality.corpus_sums(counts), table(spark, sf_dir, "labels"))
    return quality.score_text(docs, model, out="__score").filter(F.col("__score") >= LEAST_QUALITY).select(*docs.columns)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: keeps documents whose language is recognised."""
    model = lang_id.fit(docs.filter(~held_out()))
    return lang_id.predict(docs, model).filter(~F.col("lang_id.rejected")).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: keeps one document of each group."""
    return jaccard_join.one_of_each(docs).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: keeps documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: emits each document as often as its source's target asks."""
    return mixing.emit(mixing.mix(docs))


STAGES = [
    ("quality_classifier", quality_stage),
    ("language_id", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: SQL can't express the stages; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
