"""Reading the corpus, cutting lineage on shared storage, and checked broadcasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.session import scratch_path, ship_package

#: ASCII upper to lower case only; ``lower`` would also change other letters.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A word: digits, letters, and every character beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Largest table that is broadcast on purpose, in rows; beyond it Spark joins by shuffle.
BROADCAST_ROWS = 200_000
#: Rows of a table that one file of it may stand for, where the number of files is bounded on purpose.
FILE_ROWS = 50_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared scratch folder and read it back.

    This cuts the lineage: what follows neither recomputes it nor depends on
    an executor that may be lost.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def files_for(spark: SparkSession, rows: int) -> int:
    """Files for a table that grows with ``rows``: a few for each core, and one for each ``FILE_ROWS``.

    On a local file system every file written costs processes that the executor starts.
    """
    return max(4 * spark.sparkContext.defaultParallelism, 1 + rows // FILE_ROWS)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, else as it is.

    ``df`` should be settled: its rows are counted (up to the bound).
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def with_python(spark: SparkSession) -> None:
    """Python tasks import this package; send it along."""
    ship_package(spark)


__all__ = ["BROADCAST_ROWS", "UPPER", "WORD", "benchmark", "broadcast_if_small", "documents",
           "embeddings",
           "lower_ascii", "scratch_path", "settle", "with_python"]
