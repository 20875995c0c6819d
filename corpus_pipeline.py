"""A training-data pipeline over ``documents``, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept. Its result is written as Parquet under the shared scratch folder and
read again as the next stage's ``docs``, so a lost executor repeats part of
one stage at most. All stages but the last return the columns of
``documents``; the last returns packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tramline.llm.common import benchmark, documents, settle
from tramline.llm.decontaminate import clean_documents
from tramline.llm.ngram_join import keep_one_per_class
from tramline.llm.packing import pack_documents
from tramline.llm.repetition import drop_repetitive
from tramline.llm.secrets import redact_secrets


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules reject go."""
    return drop_repetitive(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of exact and near copies one document stays."""
    return keep_one_per_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return clean_documents(docs, benchmark(spark, sf_dir))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; all documents stay."""
    return redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, packed into sequences."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("packing", packing),
]

#: Similarity classes and tokenizers have no SQL form; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
