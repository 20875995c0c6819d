"""Shuffling a corpus into shards of equal row counts, in two passes.

First pass: every row goes to a bucket by a seeded hash; the number of buckets
follows from the corpus's bytes and rows, so a bucket fits in memory. Second
pass: the rows of a bucket are put in an order of their contents and permuted by
Fisher-Yates, whose draws are hashes of seed, bucket and step. Buckets in
order, each permuted, are one random order of all rows; shard s takes the
places from floor(s N / S) on, so counts differ by one at most and a bucket
lies in one shard or at a border. The order is a function of seed and rows
alone: partitions, cluster and repeated tasks do not change it.

Only the first pass moves rows. Bucket offsets come from a second scan of the
ids, as counts per bucket, added up in two levels.

Defined cases: a null text has zero bytes (plus one). Rows equal in every
column are interchangeable; of a row with more than COPIES of them one is kept
while counting, and its copies are dealt to buckets by their number. No rows
give no rows. All columns are kept and may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tramline.llm.common import broadcast_if_small, settle
from tramline.llm.spans import let

#: Bytes of text in a bucket, and rows, about.
BUCKET_BYTES, BUCKET_ROWS = 8 << 20, 1024
#: Buckets whose counts are added up in one window group.
GROUP = 1024
#: Equal rows beyond this number are dealt to buckets one by one.
COPIES = 64


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def _bucket(docs: DataFrame, seed: int, bucket_bytes: int, *fields: Column) -> Column:
    n = docs.agg(F.ceil(F.greatest(F.sum(size_of(F.col("text"))) / bucket_bytes, F.count(F.lit(1)) / BUCKET_ROWS)).cast("long").alias("n")).scalar()
    return F.pmod(F.xxhash64(F.lit(seed), *fields), F.greatest(n, F.lit(1)))


def _numbered(docs: DataFrame) -> DataFrame:
    """(row, digest, copy): every row of ``docs``; ``copy`` is 0, or numbers the copies of a row that has many."""
    whole = F.md5(F.concat_ws("|", F.coalesce(F.col("row.doc_id").cast("string"), F.lit("null")), F.md5(F.to_json("row"))))
    rows = docs.select(F.struct("*").alias("row")).select("row", whole.alias("digest"))
    hot = rows.groupBy("digest").agg(F.count("*").alias("copies")).filter(F.col("copies") > COPIES)
    hot = settle(hot, "repeated-rows").select(F.col("digest").alias("d"), "copies")
    marked = rows.join(broadcast_if_small(hot), F.col("digest") == F.col("d"), "left")
    single = marked.filter("copies is null").select("row", "digest", F.lit(0).cast("long").alias("copy"))
    kept = marked.filter("copies is not null").groupBy("digest").agg(F.first("row").alias("row"), F.max("copies").alias("copies"))
    return single.union(kept.select("row", "digest", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")))


def fisher_yates(n: Column, *seeds: Column) -> Column:
    """A permutation of 0 to n - 1 as array<int>, built inside out: element i takes the place of a drawn earlier one."""
    def place(a: Column, i: Column) -> Column:
        return let(F.pmod(F.xxhash64(*seeds, i), i + 1).cast("int"), lambda j: F.when(j == i, F.concat(a, F.array(i))).otherwise(
            F.concat(F.slice(a, 1, j), F.array(i), F.slice(a, j + 2, i - j - 1), F.array(F.get(a, j)))))

    return F.when(n > 0, F.aggregate(F.sequence(F.lit(0), n - 1), F.array().cast("array<int>"), place))


def shuffle_into_shards(docs: DataFrame, shards: int = 16, seed: int = 7, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(row, shard, slot) for every row of ``docs``, ``row`` a struct of all its columns.

    Slots of a shard run from 0 without gaps, in the shuffled order.
    """
    numbered = _numbered(docs)
    bucket = _bucket(docs, seed, bucket_bytes, F.col("digest"), F.col("copy"))
    counts = numbered.select(bucket.alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))
    counts = counts.withColumn("part", F.floor(F.col("bucket") / GROUP))
    parts = counts.groupBy("part").agg(F.sum("n").alias("total"))
    before = parts.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("base"),
                          F.sum("total").over(Window.partitionBy()).alias("all"))
    inside = F.sum("n").over(Window.partitionBy("part").orderBy("bucket")) - F.col("n")
    offsets = counts.withColumn("inside", inside).join(before, "part").select(
        "bucket", (F.col("base") + F.col("inside")).alias("first"), "all")
    lists = numbered.select(bucket.alias("bucket"), F.struct(
        F.xxhash64(F.lit(seed + 1), "digest", "copy").alias("order"), "digest", "row").alias("entry")).groupBy("bucket").agg(
        F.array_sort(F.collect_list("entry"), lambda a, b: F.when(a["order"] < b["order"], -1).when(a["order"] > b["order"], 1).when(
            a["digest"] < b["digest"], -1).when(a["digest"] > b["digest"], 1).otherwise(0)).alias("entries"))
    permuted = let(F.col("entries"), lambda e: F.transform(
        fisher_yates(F.size(e), F.lit(seed + 2), F.col("bucket")), lambda k: F.get(e, k)))
    placed = lists.join(offsets, "bucket").select("first", "all", F.posexplode(permuted).alias("i", "entry"))
    at = F.col("first") + F.col("i")
    shard = F.floor((shards * (at + 1) + F.col("all") - 1) / F.col("all")) - 1
    return placed.select(F.col("entry.row").alias("row"), shard.cast("int").alias("shard"), "all", at.alias("at")).select(
        "row", "shard", (F.col("at") - F.floor(F.col("shard") * F.col("all") / shards)).cast("long").alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = 16, seed: int = 7, bucket_bytes: int = BUCKET_BYTES) -> None:
    """Write the shuffled rows (row, slot) as Parquet, a folder per shard; a file holds whole buckets in slot order."""
    shuffle_into_shards(docs, shards, seed, bucket_bytes).write.partitionBy("shard").mode("overwrite").parquet(path)


def read_shards(spark: SparkSession, path: str, row: StructType) -> DataFrame:
    """(row, slot, shard) of the files that ``write_shards`` wrote; ``row`` is the schema of the rows."""
    schema = StructType([StructField("row", row), StructField("slot", LongType()), StructField("shard", IntegerType())])
    return spark.read.schema(schema).parquet(path)
