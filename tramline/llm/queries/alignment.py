"""op12: alignment of two tokenizers over all documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tramline.llm.alignment import align
from tramline.llm.common import documents

NAME = "op12_tokenizer_alignment"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


#: Tokenizers have no SQL form; tests compare with whole-text encoding and plain loops over all pairs.
SQL = None
