"""The shuffled order is a function of seed and rows alone."""

import collections

from pyspark.sql import functions as F

from tramline.llm import sharding
from tramline.llm.sharding import fisher_yates, read_shards, shuffle_into_shards, write_shards


def places(df):
    return sorted((r.shard, r.slot, r.row.doc_id, r.row.text or "", r.row.x) for r in df.collect())


def test_order_does_not_depend_on_partitions(spark, scratch, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 64)
    rows = [(i, f"text {i % 700}", i % 5) for i in range(2_000)] + [(7, "same", k % 3) for k in range(300)] + [(7, "same", 9)] * 500 + [(None, None, 0)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, x int")
    want = places(shuffle_into_shards(docs.repartition(1), 16, 3))
    assert places(shuffle_into_shards(docs.repartition(13), 16, 3)) == want
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        assert places(shuffle_into_shards(docs.repartition(4), 16, 3)) == want
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert collections.Counter(w[2:] for w in want) == collections.Counter((d, t or "", x) for d, t, x in rows)
    other = places(shuffle_into_shards(docs, 16, 4))
    assert sum(a == b for a, b in zip(want, other, strict=True)) < len(rows) // 4
    # copies of one row are spread: no shard holds more than a fair share and some
    copies = collections.Counter(w[0] for w in want if w[4] == 9)
    assert max(copies.values()) < 100
    write_shards(docs, f"{scratch}/shards", 16, 3)
    assert places(read_shards(spark, f"{scratch}/shards", docs.schema)) == want


def test_fisher_yates_is_uniform(spark):
    got = spark.range(6_000).select(fisher_yates(F.lit(4), F.lit(1), F.col("id")).alias("p")).groupBy("p").count().collect()
    assert len(got) == 24 and all(sorted(r.p) == [0, 1, 2, 3] for r in got) and all(180 < r["count"] < 330 for r in got)
    one = spark.range(1).select(fisher_yates(F.lit(1), F.lit(1)).alias("a"), fisher_yates(F.lit(0), F.lit(1)).alias("b")).head()
    assert one.a == [0] and one.b is None
