"""The topic log, ticks held back until complete, duplicates, and keyed state that expires."""

import json
import os

from pyspark.sql import functions as F

from tramline.schemas import EVENT_TABLES
from tramline.sources.landing import LandingStore
from tramline.sources.topics import append_messages, subscribe
from tramline.streaming.ingest import start_ingest
from tramline.streaming.stateful import recent_per_key, transition_waits

TOPICS = {EVENT_TABLES[t].topic: EVENT_TABLES[t] for t in ("world_clock_state", "train_state")}


def run(q):
    q.awaitTermination()
    assert q.exception() is None, q.exception()


def train(tick, train_id, n):
    return ("train_status", str(train_id), json.dumps({"clock_tick": tick, "train_id": train_id, "segment_id": None, "station_id": 1,
                                                       "stops_seen_so_far": [], "passenger_count": n}))


def clock(tick):
    return ("world_clock", None, json.dumps({"clock_tick": tick, "year": 2026, "day_of_year": 54, "day_of_week": "M", "hour_of_day": 8, "minute": tick}))


def append(spark, log, messages):
    rows = [(*m, i) for i, m in enumerate(messages)]
    df = spark.createDataFrame(rows, "topic string, key string, value string, n long")
    append_messages(df.withColumn("timestamp", F.timestamp_seconds(F.col("n"))), log, "n", partitions=2)


def test_half_a_tick_is_never_read(spark, scratch):
    log, ckpt = os.path.join(scratch, "log"), os.path.join(scratch, "ckpt")
    store = LandingStore(spark, os.path.join(scratch, "landing"))

    def ingest():
        run(start_ingest(subscribe(spark, log, list(TOPICS)), store, ckpt, topics=TOPICS, signals=["world_clock"], compact_every=1))
        return sorted((r.clock_tick, r.train_id, r.passenger_count) for r in store.state(EVENT_TABLES["train_state"]).collect())

    append(spark, log, [clock(1), train(1, 1, 5), train(1, 2, 6), clock(2), train(2, 1, 7)])
    assert ingest() == [(1, 1, 5), (1, 2, 6)]  # tick 2 is open
    append(spark, log, [train(2, 2, 8)])
    assert ingest() == [(1, 1, 5), (1, 2, 6)]  # still: no clock message has come, whatever was compacted
    append(spark, log, [clock(3), train(3, 1, 9)])
    assert ingest() == [(1, 1, 5), (1, 2, 6), (2, 1, 7), (2, 2, 8)]
    assert [r.clock_tick for r in store.state(EVENT_TABLES["world_clock_state"]).orderBy("clock_tick").collect()] == [1, 2]
    # an earlier snapshot stays as it was
    first = spark.read.schema("batch long").json(os.path.join(scratch, "landing", "_commits")).agg(F.min("batch")).first()[0]
    assert sorted(r.clock_tick for r in store.at(first).state(EVENT_TABLES["train_state"]).collect()) == [1, 1]


def read_all(spark, log, topics, out, ckpt, starting="earliest"):
    src = subscribe(spark, log, topics, starting)
    run(src.writeStream.foreachBatch(lambda df, b: df.write.mode("overwrite").parquet(f"{out}/batch={b}"))
        .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    return spark.read.parquet(out).orderBy("topic", "partition", "offset").collect() if os.path.exists(out) else []


def test_subscription_resumes_and_keeps_key_order(spark, scratch):
    log, out, ckpt = (os.path.join(scratch, x) for x in ("log", "out", "ckpt"))
    append(spark, log, [("a", f"k{i % 3}", str(i)) for i in range(40)] + [("b", None, "x"), ("c", "k", "not asked for")])
    got = read_all(spark, log, ["a", "b"], out, ckpt)
    assert len(got) == 41 and {r.topic for r in got} == {"a", "b"}
    append(spark, log, [("a", f"k{i % 3}", str(i)) for i in range(40, 60)])
    got = read_all(spark, log, ["a", "b"], out, ckpt)  # resumes: nothing comes twice
    assert len(got) == 61 and sorted(int(r.value) for r in got if r.topic == "a") == list(range(60))
    for p in {(r.topic, r.partition) for r in got}:
        mine = [r for r in got if (r.topic, r.partition) == p]
        assert [r.offset for r in mine] == list(range(len(mine)))
    for k in ("k0", "k1", "k2"):
        mine = [r for r in got if r.key == k]
        assert len({r.partition for r in mine}) == 1 and [int(r.value) for r in mine] == sorted(int(r.value) for r in mine)
    assert read_all(spark, log, ["a"], os.path.join(scratch, "late"), os.path.join(scratch, "ckpt2"), "latest") == []
    append(spark, log, [("a", "k0", "60")])
    assert [r.value for r in read_all(spark, log, ["a"], os.path.join(scratch, "late"), os.path.join(scratch, "ckpt2"), "latest")] == ["60"]


def test_messages_delivered_twice_count_once(spark, scratch):
    """In one batch, over batches, and after the row was walked."""
    day = 86_400_000
    rows = [(1, 0, 1, True, False), (1, 3, 2, False, True), (2, 1, 3, True, False), (2, 2, 4, False, True), (1, 9, 5, True, False)]
    folder, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")

    def write(part, some):
        spark.createDataFrame([(k, (20_000 + d) * day * 1000, i, s, e) for k, d, i, s, e in some], "k long, t long, i long, s boolean, e boolean").withColumn(
            "ts", F.timestamp_micros("t").cast("timestamp_ntz")).coalesce(1).write.parquet(f"{folder}/part={part}")

    write(0, rows[:2] + rows[:2] + rows[2:3])
    src = spark.readStream.schema("k long, t long, i long, s boolean, e boolean, ts timestamp_ntz").parquet(folder)
    waits = transition_waits(src, "k", "t", "i", F.col("s"), F.col("e"), "ts", tolerance_ms=day, horizon_ms=60 * day, once=True)

    def step():
        run(waits.writeStream.outputMode("append").foreachBatch(lambda df, b: df.write.mode("overwrite").parquet(f"{out}/b={b}"))
            .option("checkpointLocation", os.path.join(scratch, "ckpt")).trigger(availableNow=True).start())

    step()
    write(1, rows[2:] + rows[:1])
    step()
    write(2, rows + [(3, 30, 9, True, False)])
    step()
    got = sorted((r.key, r.tb, r.wait, r.kind) for r in spark.read.parquet(out).collect())
    assert got == [(1, 2, 3 * day * 1000, "wait"), (2, 4, day * 1000, "wait")]


def test_recent_state_expires(spark, scratch):
    """The state store holds the keys of the look-back, not all keys ever seen."""
    day = 86_400_000
    folder, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    os.makedirs(folder)
    src = spark.readStream.schema("k long, t long, ts timestamp_ntz").parquet(f"{folder}/*")
    state = recent_per_key(src, "k", F.col("t"), "k", F.col("k").cast("string"), "ts", 2 * day, delay_ms=0)
    totals = []
    for d in range(6):  # every day fifty new keys
        spark.createDataFrame([(100 * d + k, (20_000 + d) * day * 1000) for k in range(50)], "k long, t long").withColumn(
            "ts", F.timestamp_micros("t").cast("timestamp_ntz")).write.parquet(f"{folder}/day{d}")
        q = state.writeStream.outputMode("update").foreachBatch(lambda df, b: df.write.mode("overwrite").parquet(f"{out}/b={b}")).option(
            "checkpointLocation", os.path.join(scratch, "ckpt")).trigger(availableNow=True).start()
        run(q)
        totals.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert max(totals) <= 200 and totals[-1] <= 200
    rows = spark.read.parquet(out).collect()
    assert {r.key for r in rows if r.gone} >= {k for k in range(50)} | {100 + k for k in range(50)}
    assert not any(r.gone for r in rows if r.key >= 400)
