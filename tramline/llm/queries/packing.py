"""op9: best-fit packing of all documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tramline.llm.common import documents
from tramline.llm.packing import pack_documents

NAME = "op9_best_fit_packing"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), ids=False)


SQL = None
