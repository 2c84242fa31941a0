"""Corpus pipeline: toxicity, line dedup, SimHash near-dedup, PII redaction, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, written as Parquet and reread as the next one's docs.
All but the last return the columns of ``documents``; the last returns one row
per packed piece. Each stage sees all rows its predecessor kept.

- toxicity: rows predicted toxic go.
- line dedup: later copies of repeated line runs (three lines, or over 50 words)
  go from the texts; rows stay.
- near dedup: of each SimHash component the smallest doc_id stays.
- pii: personal data in the texts is replaced by its kind.
- packing: the texts become token pieces placed in sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import line_dedup, packing, pii, simhash_dedup, toxicity
from tidemark.llm.common import read_table, written
from tidemark.session import ship_package


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def stage_line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(docs, over_words=line_dedup.OVER_WORDS).select(*docs.columns)


def stage_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return simhash_dedup.keep_one(docs)


def stage_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", stage_toxicity),
    ("line_dedup", stage_line_dedup),
    ("near_dedup", stage_near_dedup),
    ("pii", stage_pii),
    ("packing", stage_packing),
]

# the classifier, the fingerprints and the packing are not expressible in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and reread."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
