"""op6: personal data in all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import documents
from tramline.llm.pii import find_personal_data, span_list

NAME = "op6_pii"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(documents(spark, sf_dir))

    def number(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", *(number(k).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")),
        F.sha2(span_list(F.col("base")), 256).alias("base_sha256"),
        span_list(F.concat("base", "added")).alias("spans"))


#: The rounds over the graph have no SQL form; tests hold the result against brute force.
SQL = None
