"""op4: near-duplicate passages of 50 words or more across all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import documents
from tramline.llm.substrings import duplicate_passages

NAME = "op4_substring_dedup"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = duplicate_passages(documents(spark, sf_dir))
    text = F.concat_ws(",", F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))))
    return found.select("doc_id", "class_id", "n_links", "n_dup_words", (F.col("n_dup_words") > 0).alias("has_duplicate"),
                        text.alias("spans"))


SQL = None
