"""The supplied Parquet tables (one file or folder per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Tables whose row count is fixed by the TPC-H specification (25 nations, 5
# regions) regardless of scale factor: safe to broadcast.
FIXED_SIZE_DIMENSIONS = {"nation": 25, "region": 5}


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessor: ``t.orders`` reads ``<sf_dir>/orders.parquet`` once per use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark = spark
        self._dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        return load_table(self._spark, self._dir, name)
