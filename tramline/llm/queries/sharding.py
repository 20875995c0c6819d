"""op2: all documents shuffled into 16 shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import documents, scratch_path
from tramline.llm.sharding import read_shards, size_of, write_shards

NAME = "op2_sharding"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the shards, and report what is in the files."""
    docs, path = documents(spark, sf_dir).select("doc_id", "text"), scratch_path(spark, "shards")
    write_shards(docs, path)
    text = F.col("row.text")
    return read_shards(spark, path, docs.schema).select(
        F.col("row.doc_id").alias("doc_id"), size_of(text).alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


SQL = None
