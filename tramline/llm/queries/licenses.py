"""op5: licences in all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tramline.llm.common import documents
from tramline.llm.licenses import find_licenses

NAME = "op5_license_scan"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licenses(documents(spark, sf_dir))


SQL = None
