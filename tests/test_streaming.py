"""Six-topic ingest, live marts, replay and stateful waits on the shipped network."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tramline.plans import transit as tp
from tramline.schemas import EVENT_TABLES
from tramline.sources.landing import LandingStore
from tramline.streaming.ingest import file_source, start_ingest
from tramline.streaming.live import LIVE_MARTS, publish, read_published, snapshot_events


def _msgs(topic, rows, start_offset):
    return [{"topic": topic, "value": json.dumps(r), "partition": 0, "offset": start_offset + i,
             "timestamp": "2026-02-23T08:00:00.000Z"} for i, r in enumerate(rows)]


def live_messages():
    """Ticks 2 and 3: the clock advances, train 101 carries riders, passenger 7
    waits at station 2 from tick 2 and boards train 201 at tick 3."""
    b1 = []
    b1 += _msgs("world_clock", [{"clock_tick": 2, "year": 2026, "day_of_year": 54, "day_of_week": "M",
                                 "hour_of_day": 8, "minute": 1}], 0)
    b1 += _msgs("train_status", [{"clock_tick": 2, "train_id": 101, "segment_id": 32, "station_id": None,
                                  "stops_seen_so_far": [1, 2, 3], "passenger_count": 4}], 10)
    b1 += _msgs("rail_segments", [{"clock_tick": 2, "segment_id": 32,
                                   "trains_present": [{"id": 101, "position_km": 0.9},
                                                      {"id": 102, "position_km": 2.56},
                                                      {"id": 201, "position_km": 2.46}]}], 20)
    b1 += _msgs("passenger_status", [{"clock_tick": 2, "passenger_id": 7, "train_id": None, "station_id": 2,
                                      "stops_seen_so_far": [2]}], 30)
    b1 += _msgs("station_status", [{"station_id": 2, "clock_tick": 2, "total_passengers_in_station": 5,
                                    "passengers_boarded_trains": 0, "passengers_entered_station": 5,
                                    "passengers_waiting": 5, "trains_at_platform": None}], 40)
    b1 += _msgs("platform_status", [{"clock_tick": 2, "station_id": 2, "route_id": 2,
                                     "platform_state": "Arrival"}], 50)
    b2 = []
    b2 += _msgs("world_clock", [{"clock_tick": 3, "year": 2026, "day_of_year": 54, "day_of_week": "M",
                                 "hour_of_day": 8, "minute": 2}], 100)
    b2 += _msgs("passenger_status", [{"clock_tick": 3, "passenger_id": 7, "train_id": 201, "station_id": None,
                                      "stops_seen_so_far": [2]}], 110)
    b2 += _msgs("station_status", [{"station_id": 2, "clock_tick": 3, "total_passengers_in_station": 4,
                                    "passengers_boarded_trains": 1, "passengers_entered_station": 0,
                                    "passengers_waiting": 4, "trains_at_platform": None}], 120)
    # a corrected re-delivery of train 101 at tick 2: last write wins
    b2 += _msgs("train_status", [{"clock_tick": 2, "train_id": 101, "segment_id": 32, "station_id": None,
                                  "stops_seen_so_far": [1, 2, 3], "passenger_count": 6}], 130)
    return [b1, b2]


def _write_batches(folder, batches):
    os.makedirs(folder, exist_ok=True)
    for i, b in enumerate(batches):
        path = os.path.join(folder, f"batch-{i:03d}.json")
        with open(path, "w") as fh:
            fh.write("\n".join(json.dumps(m) for m in b) + "\n")
        # the file source orders files by modification time
        os.utime(path, (1_700_000_000 + i * 60, 1_700_000_000 + i * 60))


def _run(q):
    q.awaitTermination()
    assert q.exception() is None, q.exception()


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_ingest_publish_replay(spark, shipped, scratch):
    net, seed_ev = shipped
    msgs = os.path.join(scratch, "msgs")
    _write_batches(msgs, live_messages())
    landing, out = os.path.join(scratch, "landing"), os.path.join(scratch, "marts")
    store = LandingStore(spark, landing)
    # the seed rows stand in for the tables' initial load
    published = []
    q = start_ingest(file_source(spark, msgs, max_files=1), store, os.path.join(scratch, "ck1"),
                     on_committed=lambda b: (publish(spark, store, net, out, b, LIVE_MARTS, seed_ev),
                                             published.append(b)))
    _run(q)
    assert published == [0, 1]

    # upsert: train 101 at tick 2 was delivered twice; the later write wins
    trains = store.state(EVENT_TABLES["train_state"]).collect()
    assert [(r.clock_tick, r.train_id, r.passenger_count) for r in trains] == [(2, 101, 6)]

    ev = snapshot_events(store, seed_ev)
    for mart in LIVE_MARTS:
        assert _rows(read_published(spark, out, mart)) == _rows(tp.ALL_PRODUCTS[mart](ev, net)), mart

    kpi = read_published(spark, out, "live_system_kpis").collect()[0]
    assert (kpi.total_passengers_riding, kpi.total_passengers_waiting) == (6, 4)
    waits = {r.metric: float(r.wait_time) for r in read_published(spark, out, "live_wait_times").collect()}
    assert waits == {"Max": 1.0, "Avg": 1.0, "Min": 1.0}
    clock = read_published(spark, out, "world_clock").collect()[0]
    assert (clock.clock_tick, clock.minute) == (3, 2)

    # replay from scratch with a new checkpoint (compacting after each batch):
    # a later epoch, same state
    before = {n: _rows(store.state(t).drop("created_at")) for n, t in EVENT_TABLES.items()}
    _run(start_ingest(file_source(spark, msgs, max_files=1), store, os.path.join(scratch, "ck2"), compact_every=1))
    assert {n: _rows(store.state(t).drop("created_at")) for n, t in EVENT_TABLES.items()} == before
    assert _rows(store.state(EVENT_TABLES["station_passenger_stats"])) == \
        _rows(LandingStore(spark, landing).state(EVENT_TABLES["station_passenger_stats"]))
    # compacted at batch 1: one snapshot row per key remains to be merged
    assert store.writes(EVENT_TABLES["train_state"]).count() == 1


def _clock(minute, partition, offset, second):
    return {"topic": "world_clock", "partition": partition, "offset": offset,
            "timestamp": f"2026-02-23T08:00:{second:02d}.000Z", "value": json.dumps(
                {"clock_tick": 1, "year": 2026, "day_of_year": 54, "day_of_week": "M", "hour_of_day": 8, "minute": minute})}


def _minutes(store):
    return [r.minute for r in store.state(EVENT_TABLES["world_clock_state"]).collect()]


def test_newer_message_wins_across_partitions(spark, scratch):
    msgs = os.path.join(scratch, "msgs")
    _write_batches(msgs, [[_clock(1, 1, 0, 10), _clock(59, 0, 0, 30)]])
    store = LandingStore(spark, os.path.join(scratch, "landing"))
    _run(start_ingest(file_source(spark, msgs), store, os.path.join(scratch, "ck")))
    assert _minutes(store) == [59]


def test_replay_with_other_batches_and_run_after_purge(spark, scratch):
    msgs = os.path.join(scratch, "msgs")
    _write_batches(msgs, [[_clock(1, 0, 0, 1)], [_clock(2, 0, 1, 2)], [_clock(3, 0, 2, 3)]])
    store = LandingStore(spark, os.path.join(scratch, "landing"))
    _run(start_ingest(file_source(spark, msgs, max_files=1), store, os.path.join(scratch, "ck1")))
    assert _minutes(store) == [3]
    # a replay in one batch, and one more message: leftover batches of the first run do not outrank it
    _write_batches(msgs + "2", [[_clock(1, 0, 0, 1), _clock(2, 0, 1, 2), _clock(3, 0, 2, 3), _clock(44, 0, 3, 4)]])
    _run(start_ingest(file_source(spark, msgs + "2"), store, os.path.join(scratch, "ck2")))
    assert _minutes(store) == [44]
    store.purge(store.run(os.path.join(scratch, "ck2")).sequence(0))
    assert _minutes(store) == []
    _run(start_ingest(file_source(spark, msgs, max_files=1), store, os.path.join(scratch, "ck3")))
    assert _minutes(store) == [3]


def test_null_topic_fails(spark, scratch):
    msgs = os.path.join(scratch, "bad")
    _write_batches(msgs, [[{"topic": None, "value": "{}", "partition": 0, "offset": 0}]])
    store = LandingStore(spark, os.path.join(scratch, "landing"))
    q = start_ingest(file_source(spark, msgs), store, os.path.join(scratch, "ck"))
    with pytest.raises(Exception, match="unknown topic"):
        q.awaitTermination()


def test_unknown_topic_fails(spark, scratch):
    msgs = os.path.join(scratch, "bad")
    _write_batches(msgs, [[{"topic": "bogus", "value": "{}", "partition": 0, "offset": 0}]])
    store = LandingStore(spark, os.path.join(scratch, "landing"))
    q = start_ingest(file_source(spark, msgs), store, os.path.join(scratch, "ck"))
    with pytest.raises(Exception, match="unknown topic"):
        q.awaitTermination()


def test_stateful_waits_match_batch(spark, scratch):
    from tramline.operators.sequence import completed_waits
    from tramline.streaming.stateful import transition_waits
    rows = [(7, 10, None, 1), (7, 14, 5, None), (7, 20, 5, None), (7, 25, None, 2), (7, 34, 6, None),
            (8, 3, 9, None), (8, 5, None, 3), (8, 9, 4, None), (9, 1, None, None), (9, 2, None, 1), (9, 6, 3, None)]
    df = spark.createDataFrame(rows, "pid int, tick int, train int, station int")
    df = df.withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("tick") * 60).cast("timestamp_ntz"))
    src_dir = os.path.join(scratch, "src")
    # two deliveries out of order, then a row of another key that makes all final
    df.where("tick % 2 = 0").write.parquet(f"{src_dir}/part=1")
    df.where("tick % 2 = 1").write.parquet(f"{src_dir}/part=2")
    spark.createDataFrame([(99, 500, None, 1)], "pid int, tick int, train int, station int").withColumn(
        "ts", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("tick") * 60).cast("timestamp_ntz")).write.parquet(f"{src_dir}/part=3")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 4).parquet(src_dir)
    located = stream.where(F.col("train").isNotNull() | F.col("station").isNotNull())
    waits = transition_waits(located, "pid", "tick", "tick", F.col("train").isNull(), F.col("train").isNotNull(),
                             event_time="ts", tolerance_ms=60 * 60_000, horizon_ms=600 * 60_000)
    out = os.path.join(scratch, "out")
    q = (waits.writeStream.foreachBatch(lambda b, i: b.write.mode("append").parquet(out))
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
    _run(q)
    got = sorted((r.key, r.wait) for r in spark.read.parquet(out).where("kind = 'wait'").collect())
    want = sorted((r.pid, r.wait_time_ticks) for r in completed_waits(df, "pid", "tick", "train", "station").collect())
    assert got == want == [(7, 4), (7, 9), (8, 4), (9, 4)]


def test_idle_state_expires(spark, scratch):
    """A key idle beyond the retention is forgotten: its next row starts fresh."""
    from tramline.streaming.stateful import transition_waits
    src_dir = os.path.join(scratch, "src")
    schema = "pid long, ts timestamp_ntz, kind string"

    os.makedirs(src_dir, exist_ok=True)

    def deliver(name, rows):
        import pyarrow as pa
        import pyarrow.parquet as pq
        pid, ts, kind = zip(*rows)
        table = pa.table({"pid": pa.array(pid, pa.int64()), "ts": pa.array(ts, pa.timestamp("us")),
                          "kind": pa.array(kind, pa.string())})
        pq.write_table(table, os.path.join(src_dir, f"{name}.parquet"))

    import datetime as dt
    t0 = dt.datetime(2024, 1, 1, 8, 0)
    m = lambda k: t0 + dt.timedelta(minutes=k)
    stream = spark.readStream.schema(schema).parquet(src_dir)
    waits = transition_waits(stream, "pid", F.timestamp_diff("MINUTE", F.lit(t0).cast("timestamp_ntz"), F.col("ts")),
                             "pid", F.col("kind") == "wait", F.col("kind") == "ride",
                             event_time="ts", tolerance_ms=60_000, horizon_ms=60_000, retention_ms=10 * 60_000)
    out, ck = os.path.join(scratch, "out"), os.path.join(scratch, "ck")

    def run():
        _run(waits.writeStream.foreachBatch(lambda b, i: b.write.mode("append").parquet(out))
             .option("checkpointLocation", ck).trigger(availableNow=True).start())

    deliver("a", [(1, m(0), "wait"), (2, m(0), "wait")])
    run()
    deliver("b", [(2, m(3), "ride"), (3, m(60), "wait")])   # watermark moves to 59 min
    run()
    deliver("c", [(3, m(61), "wait")])                        # a batch after the watermark moved: pid 1 times out
    run()
    deliver("d", [(1, m(62), "ride"), (3, m(65), "ride")])
    run()
    deliver("e", [(9, m(80), "none")])                        # makes minute 65 final
    run()
    got = sorted((r.key, r.wait) for r in spark.read.parquet(out).where("kind = 'wait'").collect())
    # pid 2 waited 3 minutes; pid 1's wait state expired, so no 62-minute wait; pid 3 waited 4
    assert got == [(2, 3), (3, 4)]


def test_shuffled_delivery_same_marts(spark, shipped, scratch):
    """Without re-deliveries of a key, arrival order does not change the marts:
    state is keyed by clock_tick in the data, not by arrival (SURVEY D10)."""
    net, seed_ev = shipped
    b1, b2 = live_messages()
    b2 = [m for m in b2 if not (m["topic"] == "train_status")]  # drop the re-delivery
    msgs = os.path.join(scratch, "msgs")
    _write_batches(msgs, [list(reversed(b2)), list(reversed(b1))])
    store = LandingStore(spark, os.path.join(scratch, "landing"))
    out = os.path.join(scratch, "marts")
    _run(start_ingest(file_source(spark, msgs, max_files=1), store, os.path.join(scratch, "ck"),
                      on_committed=lambda b: publish(spark, store, net, out, b, LIVE_MARTS, seed_ev)))
    ev = snapshot_events(store, seed_ev)
    for mart in LIVE_MARTS:
        assert _rows(read_published(spark, out, mart)) == _rows(tp.ALL_PRODUCTS[mart](ev, net)), mart
    waits = {r.metric: float(r.wait_time) for r in read_published(spark, out, "live_wait_times").collect()}
    assert waits == {"Max": 1.0, "Avg": 1.0, "Min": 1.0}
    assert read_published(spark, out, "world_clock").first().clock_tick == 3


def test_topic_counts_monitor(spark, scratch):
    """Windowed counts per topic equal the batch counts once the watermark has passed."""
    from tramline.streaming.ingest import MESSAGE_SCHEMA
    from tramline.streaming.monitor import topic_counts
    msgs = os.path.join(scratch, "msgs")
    rows = [{"topic": t, "value": "{}", "partition": 0, "offset": i,
             "timestamp": f"2026-02-23T08:{m:02d}:{s:02d}.000Z"}
            for i, (t, m, s) in enumerate([("world_clock", 0, 5), ("train_status", 0, 30), ("train_status", 0, 59),
                                           ("world_clock", 1, 10), ("station_status", 2, 0)])]
    _write_batches(msgs, [rows, [{"topic": "world_clock", "value": "{}", "partition": 0, "offset": 99,
                                  "timestamp": "2026-02-23T09:00:00.000Z"}]])
    out = os.path.join(scratch, "counts")
    stream = spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", 1).json(msgs)
    q = (topic_counts(stream, "1 minute", "1 minute").writeStream.outputMode("append")
         .foreachBatch(lambda b, i: b.write.mode("append").parquet(out))
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
    _run(q)
    got = sorted((r.window_start.minute, r.topic, r.n) for r in spark.read.parquet(out).collect()
                 if r.window_start.hour == 8)
    assert got == [(0, "train_status", 2), (0, "world_clock", 1), (1, "world_clock", 1), (2, "station_status", 1)]


class _State:
    """A group's state in memory; a stand-in for Spark's."""

    def __init__(self):
        self.value, self.mark, self.hasTimedOut, self.timeout = None, 0, False, None

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def getCurrentWatermarkMs(self):
        return self.mark

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def setTimeoutTimestamp(self, at):
        self.timeout = at


def test_waits_of_many_keys_in_one_group():
    """One call walks all keys of a group; keys do not see each other's rows, and duplicates count once."""
    import random

    import pandas as pd

    from tramline.streaming.stateful import _waits_fn
    r = random.Random(3)
    rows = [(k, t * 1000, k * 100 + t, r.random() < 0.5, r.random() < 0.5, t) for k in range(20) for t in r.sample(range(1, 90), 30)]
    state, got = _State(), []
    for upto, mark in ((30, 0), (60, 20), (90, 50), (0, 1000)):
        part = [x for x in rows if upto - 30 <= x[5] < upto]
        frame = pd.DataFrame(part + part[::2], columns=["_k", "_t", "_tb", "_start", "_end", "_ms"])
        state.mark, state.hasTimedOut = mark, not part
        for out in _waits_fn(0, 100, (7,), iter([frame] if part else []), state):
            got += list(out.itertuples(index=False, name=None))
    want = []
    for k in range(20):
        own = sorted(x for x in rows if x[0] == k)
        want += [(k, b[1], b[2], b[1] - a[1], "wait") for a, b in zip(own, own[1:], strict=False) if a[3] and b[4]]
    assert sorted(got) == sorted(want) and len(want) > 50
    assert not state.exists  # all keys are older than the retention
