"""A hot key is split into bounded chunks and results equal the plain window."""

from pyspark.sql import Window
from pyspark.sql import functions as F

import random
import re

import pytest

from tramline.operators.asof import as_of_merge, latest_at_probes
from tramline.operators.sequence import CHUNK, carry_forward, neighbors, running_total, with_chunks


def _skewed(spark, n=20000):
    # key 0 holds 90% of the rows; order values are distinct per key
    df = spark.range(n).select(
        F.when(F.col("id") < n * 9 // 10, F.lit(0)).otherwise(F.col("id") % 37 + 1).alias("k"),
        (F.col("id") * 7 % n).alias("t"), F.col("id").alias("v"))
    return df


def test_hot_key_is_split(spark):
    spark.conf.set("tramline.sequence.chunkRows", "1000")
    try:
        df = _skewed(spark)
        chunked = with_chunks(df, ["k"], ["t"])
        sizes = chunked.groupBy("k", CHUNK).count()
        biggest = sizes.agg(F.max("count")).first()[0]
        hot_chunks = sizes.where("k = 0").count()
        assert hot_chunks == 20  # a chunk for every thousand rows
        assert biggest <= 2000
    finally:
        spark.conf.set("tramline.sequence.chunkRows", "4")


@pytest.mark.parametrize("spread", ["outlier", "corner", "heavy value"])
def test_uneven_values_are_cut_at_quantiles(spark, spread):
    """One value far out, nine tenths of the rows in a hundredth of the range, one value with a third of the rows."""
    n, rows = 100_000, 1000
    t = {"outlier": "case when id = 0 then timestamp_ntz'9999-01-01 00:00:00' else timestampadd(second, id, timestamp_ntz'2024-01-01 00:00:00') end",
         "corner": "case when id % 10 = 0 then id * 100 else id end",
         "heavy value": "case when id % 3 = 0 then 50000 else id end"}[spread]
    df = spark.range(n).selectExpr("0 as k", f"{t} as t", "id as v").repartition(7)
    spark.conf.set("tramline.sequence.chunkRows", str(rows))
    try:
        sizes = [r["count"] for r in with_chunks(df, ["k"], ["t"]).groupBy(CHUNK).count().collect()]
    finally:
        spark.conf.set("tramline.sequence.chunkRows", "4")
    if spread == "heavy value":  # a single value cannot be cut
        assert sorted(sizes)[-1] < n // 3 + 2 * rows and sorted(sizes)[-2] <= 2 * rows
    else:
        assert len(sizes) >= n // rows * 3 // 4 and max(sizes) <= 2 * rows


def test_the_sketch_is_evaluated_once(spark):
    """Both branches of the plan take their chunk ids from one subquery."""
    df = neighbors(_skewed(spark), ["k"], ["t"], ["v"], "prev")
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert len(set(re.findall(r"[Ss]ubquery#\d+", text))) == 1


def test_more_chunks_than_quantiles(spark):
    df = _skewed(spark)
    spark.conf.set("tramline.sequence.chunkRows", "10")
    try:
        sizes = [r["count"] for r in with_chunks(df, ["k"], ["t"]).groupBy(CHUNK).count().collect()]
        assert len(sizes) > 1500 and max(sizes) <= 20
        a, b = (running_total(df, ["k"], ["t"], "v", "cum", bounded=x) for x in (False, True))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    finally:
        spark.conf.set("tramline.sequence.chunkRows", "4")


@pytest.mark.parametrize("rows_per_chunk", ["3", "1000000"])
def test_carry_forward_equals_plain_window(spark, rows_per_chunk):
    r = random.Random(12)
    rows = [(r.choice([None, 1, 2]), r.choice([None, *range(40)]), i, r.choice([None, None, None, i]), r.choice([None, "a", "b"])) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, t int, tie int, v int, s string")
    spark.conf.set("tramline.sequence.chunkRows", rows_per_chunk)
    try:
        got = carry_forward(df, ["k"], ["t", "tie"], ["v", "s"])
        w = Window.partitionBy("k").orderBy("t", "tie").rowsBetween(Window.unboundedPreceding, 0)
        want = df.select("*", F.last("v", True).over(w).alias("last_v"), F.last("s", True).over(w).alias("last_s"))
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    finally:
        spark.conf.set("tramline.sequence.chunkRows", "4")


def _as_of(probes, rows, strict=False):
    out = []
    for k, t, name in probes:
        hits = [(rt, o, v) for rk, rt, o, v in rows if rk == k and rt is not None and t is not None and (rt < t or (rt == t and not strict))]
        out.append((k, t, name, max(hits)[2] if hits else None))
    return out


@pytest.mark.parametrize("strict", [False, True])
def test_as_of_merge(spark, strict):
    """Ties, null times and keys, keys on one side only, repeated probes, columns with the merge's own names."""
    r = random.Random(13)
    pick = lambda n: None if r.random() < 0.1 else r.randrange(n)
    rows = [(pick(4), pick(30), i, f"v{i}") for i in range(120)] + [(9, 1, 1, "only")]
    probes = [(pick(5), pick(34), f"p{i}") for i in range(80)] + [(1, 7, "same"), (1, 7, "same")]
    a = spark.createDataFrame(probes, "k int, t int, _side string")
    b = spark.createDataFrame(rows, "k int, rt int, o int, _t string")
    got = as_of_merge(a, b, ["k"], "t", "rt", ["o"], ["_t"], strict=strict)
    assert got.columns == ["k", "t", "_side", "asof__t"]
    order = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(map(tuple, got.collect()), key=order) == sorted(_as_of(probes, rows, strict), key=order)


def test_latest_at_probes(spark):
    r = random.Random(14)
    rows = [(r.randrange(4), r.choice([None, *range(30)]), i) for i in range(90)]
    probes = [(t,) for t in (3, 3, 8, 15, 29, 40, None, -1)]
    a = spark.createDataFrame(rows, "k int, t int, o int")
    got = latest_at_probes(a, spark.createDataFrame(probes, "p int"), "k", "t", "p", ["o"])
    want = {(k, p, max((t, o) for kk, t, o in rows if kk == k and t is not None and t <= p))
            for k in range(4) for p in (3, 8, 15, 29, 40) if any(kk == k and t is not None and t <= p for kk, t, o in rows)}
    assert sorted((x.k, x.p, (x.t, x.o)) for x in got.collect()) == sorted(want)
    assert "NestedLoop" not in got._jdf.queryExecution().toString()


def test_chunked_equals_plain(spark):
    spark.conf.set("tramline.sequence.chunkRows", "1000")
    try:
        df = _skewed(spark)
        for direction in ("prev", "next"):
            a = neighbors(df, ["k"], ["t"], ["v", "t"], direction)
            b = neighbors(df, ["k"], ["t"], ["v", "t"], direction, bounded=True)
            assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
        a = running_total(df, ["k"], ["t"], "v", "cum")
        b = running_total(df, ["k"], ["t"], "v", "cum", bounded=True)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    finally:
        spark.conf.set("tramline.sequence.chunkRows", "4")


def test_text_order_needs_a_number(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (1, "c", 3)], "k int, s string, v int")
    with pytest.raises(TypeError, match="dense number"):
        neighbors(df, ["k"], ["s"], ["v"], "prev")
    got = [r.prev_v for r in neighbors(df, ["k"], ["s"], ["v"], "prev", bounded=True).orderBy("s").collect()]
    assert got == [None, 1, 2]


@pytest.mark.parametrize("rows_per_chunk", ["3", "1000000"])
def test_nulls_and_ties_equal_plain_windows(spark, rows_per_chunk):
    """Null keys, null and tied order values, null values: the same rows as the plain window, cut or not."""
    r = random.Random(11)
    pick = lambda n: None if r.random() < 0.2 else r.randrange(n)
    rows = [(pick(3), pick(9), i, pick(50)) for i in range(300)] + [(7, i, i, None) for i in range(9)]
    df = spark.createDataFrame(rows, "k int, t int, tie int, v int")
    spark.conf.set("tramline.sequence.chunkRows", rows_per_chunk)
    try:
        for f in (lambda b: neighbors(df, ["k"], ["t", "tie"], ["v", "t"], "prev", bounded=b),
                  lambda b: neighbors(df, ["k"], ["t", "tie"], ["v"], "next", bounded=b),
                  lambda b: running_total(df, ["k"], ["t", "tie"], "v", "cum", bounded=b)):
            assert f(False).exceptAll(f(True)).count() == 0 and f(True).exceptAll(f(False)).count() == 0
    finally:
        spark.conf.set("tramline.sequence.chunkRows", "4")


def test_building_a_frame_starts_no_job(spark):
    df = _skewed(spark, 100)
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    running_total(neighbors(df, ["k"], ["t"], ["v"], "prev"), ["k"], ["t"], "v", "cum")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before


def test_null_keys_stay_whole(spark):
    rows = [(None, t, t * 10) for t in range(12)] + [(1, t, t) for t in range(12)]
    df = spark.createDataFrame(rows, "k int, t int, v int")
    for direction in ("prev", "next"):
        a = neighbors(df, ["k"], ["t"], ["v"], direction)
        b = neighbors(df, ["k"], ["t"], ["v"], direction, bounded=True)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    a = running_total(df, ["k"], ["t"], "v", "cum")
    b = running_total(df, ["k"], ["t"], "v", "cum", bounded=True)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
