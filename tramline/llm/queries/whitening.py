"""op11: whitening of all embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tramline.llm.common import embeddings
from tramline.llm.whitening import whiten

NAME = "op11_embedding_whitening"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(embeddings(spark, sf_dir))


#: Eigenvectors have no SQL form; tests compare with a plain eigendecomposition.
SQL = None
