"""op10: token files of all documents, written and read back."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tramline.llm.common import documents, scratch_path
from tramline.llm.token_files import read_tokens, write_tokens

NAME = "op10_token_files"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_tokens(documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_tokens(spark, path, ids=False)


SQL = None
