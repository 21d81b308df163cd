"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept, and is written as Parquet and read
again. All but the last return the columns of documents.

Language ID drops what it rejects. Near-duplicates leave one document of each class, the one of the smallest doc_id.
Secret scans put a mark in the place of each secret; no document goes. Mixing repeats and drops documents to meet the
sources' targets. Packing returns the pieces of the packed sequences.

Defined results: see the operators' docstrings; an empty table goes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import table, written
from lodestone.llm.language import accepted, fit
from lodestone.llm.mixing import mix
from lodestone.llm.near_duplicates import deduplicated
from lodestone.llm.packing import packed
from lodestone.llm.secrets import without_secrets


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return accepted(docs, fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return deduplicated(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = without_secrets(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can't express the stages; tests/llm holds each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
