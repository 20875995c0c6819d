"""Operating rules as table operators and scalar helpers."""

import os

import pytest
from pyspark.sql import functions as F

from tramline import functions as fx
from tramline.plans import rules
from tramline.plans.integrity import route_rows


def test_next_stop_from_history(spark, shipped):
    net, ev = shipped
    routes = route_rows(net.routes)
    trains = net.trains.select("train_id", F.col("route_id").alias("route"))
    st = ev.train_state.join(trains, "train_id")
    got = {r.train_id: (r.next_station, r.complete)
           for r in rules.next_stop_from_history(st, routes, "train_id", "route", "stops_seen_so_far").collect()}
    assert got[101] == (2, False)      # 1,2,3 on 1,2,3,2,1
    assert got[201] == (2, False)      # 3 on 3,2,1,2,3
    assert got[104] == (1, False)      # 1,2,3,2 -> last stop 1
    full = spark.createDataFrame([(1, 1, [1, 2, 3, 2, 1])], "train_id int, route int, stops_seen_so_far array<int>")
    r = rules.next_stop_from_history(full, routes, "train_id", "route", "stops_seen_so_far").first()
    assert (r.next_station, r.complete) == (None, True)


def test_boarding_allocation_capacity(spark):
    """20 riders waiting, 10 free places: the first 10 by arrival board."""
    waiting = spark.createDataFrame([(2, p, 100 + p) for p in range(20)], "station int, pid int, arrived int")
    cap = spark.createDataFrame([(2, 10)], "station int, free int")
    got = rules.allocate(waiting, cap, "station", ["arrived", "pid"], "free").orderBy("slot").collect()
    assert [r.pid for r in got] == list(range(10))


def test_alighting(spark):
    riders = spark.createDataFrame([(1, 9, 3), (2, 9, 4), (3, 9, None)], "pid int, train int, want int")
    trains = spark.createDataFrame([(9, 3)], "train int, next_stop int")
    got = sorted(r.pid for r in rules.alighting(riders, trains, "train", "want", "next_stop").collect())
    assert got == [2, 3]


def test_platform_audit(spark):
    rows = [(1, 1, 1, "Empty"), (2, 1, 1, "Arrival"), (3, 1, 1, "Arrival"), (4, 1, 1, "Departure"),
            (7, 1, 1, "Empty"), (8, 1, 1, "Departure")]
    df = spark.createDataFrame(rows, "clock_tick int, station_id int, route_id int, platform_state string")
    got = sorted((r.clock_tick, r.verdict) for r in rules.platform_transition_audit(df, ["station_id", "route_id"])
                 .collect())
    assert got == [(4, "invalid"), (7, "gap"), (8, "invalid")]


def test_station_counts(spark):
    rows = [(7, 10, 1, None), (7, 14, None, 5), (7, 25, 2, None), (8, 14, 1, None), (8, 15, None, 5)]
    df = spark.createDataFrame(rows, "passenger_id int, clock_tick int, station_id int, train_id int")
    got = sorted(tuple(r) for r in rules.station_counts(df).collect())
    assert got == [(14, 1, 1, 0), (15, 1, 1, 0), (25, 2, 0, 1)]


def test_travel_ticks(spark, shipped):
    net, _ = shipped
    t = {r.segment_id: r.travel_ticks for r in rules.travel_ticks(net.rail_segments).collect()}
    assert t[12] == 37 and t[23] == 40 and t[24] == 5
    legs = rules.route_travel_ticks(net.routes, net.rail_segments).where("route_id = 1").orderBy("stop_sequence")
    assert [r.ticks_from_start for r in legs.collect()] == [0, 37, 77, 117, 154]


def test_trips_due_first_plan(spark):
    plans = spark.createDataFrame([(1, 5, "M", 8, 0), (1, 3, "M", 8, 0), (2, 4, "T", 8, 0), (3, 1, "M", 9, 0)],
                                  "pid int, plan int, wd string, hh int, mm int")
    clock = spark.createDataFrame([("M", 8, 0)], "wd string, hh int, mm int")
    got = [(r.pid, r.plan) for r in rules.trips_due(plans, clock, ["wd", "hh", "mm"], "pid", "plan").collect()]
    assert got == [(1, 3)]


def test_as_of_latest(spark):
    rows = spark.createDataFrame([(1, 10, 100), (1, 20, 101), (2, 30, 102)], "k int, t int, id int")
    probes = spark.createDataFrame([(15,), (25,)], "p int")
    got = sorted(tuple(r) for r in rules.as_of_latest(rows, probes, "k", "t", "p", ["id"]).collect())
    assert got == [(1, 15, 10, 100), (1, 25, 20, 101)]


def test_tick_calendar_matches_stepping(spark):
    """Closed form equals stepping the clock minute by minute (with year carry)."""
    def step(state):
        y, doy, wd, h, m = state
        codes = ["M", "T", "W", "R", "F", "S", "U"]
        m += 1
        if m > 59:
            m, h = 0, h + 1
        if h > 23:
            h, m, wd, doy = 0, 0, codes[(codes.index(wd) + 1) % 7], doy + 1
        if doy > 365:
            y, doy = y + 1, 1
        return (y, doy, wd, h, m)
    start = (2026, 364, "S", 23, 57)
    want, s = [start], start
    for _ in range(3000):
        s = step(s)
        want.append(s)
    cal = fx.tick_calendar("n", *start)
    got = spark.range(3001).select(F.col("id").alias("n")).select(
        "n", cal["year"].alias("y"), cal["day_of_year"].alias("d"), cal["day_of_week"].alias("w"),
        cal["hour_of_day"].alias("h"), cal["minute"].alias("m")).orderBy("n").collect()
    assert [(r.y, r.d, r.w, r.h, r.m) for r in got] == want


def test_scalar_helpers(spark):
    df = spark.createDataFrame([(2.6789, 8, 5, "Arrival", None)], "x double, h int, m int, s string, n double")
    r = df.select(fx.truncate_to("x", 3).alias("t"), fx.clock_text("h", "m").alias("c"),
                  fx.next_in_cycle("s", ["Empty", "Arrival", "MovingPassengers", "Departure"]).alias("nx"),
                  fx.clip_upper("n", 1.0).alias("clip_null"), fx.clip_upper("x", 1.0).alias("clip"),
                  fx.pair_key(F.lit("b"), F.lit("a")).alias("pk")).first()
    assert (r.t, r.c, r.nx, r.clip_null, r.clip, r.pk) == (2.678, "08:05", "MovingPassengers", None, 1.0, ["a", "b"])
    with pytest.raises(Exception, match="unknown travel code"):
        spark.createDataFrame([("X",)], "c string").select(
            fx.lookup("c", {"M": "Monday"}, error_on_missing=True, what="travel code")).collect()


def test_purge_hides_earlier_batches(spark, scratch):
    from tramline.schemas import EVENT_TABLES
    from tramline.sources.landing import LandingStore
    from tramline.streaming.ingest import parse_topic
    store = LandingStore(spark, os.path.join(scratch, "landing"))
    t = EVENT_TABLES["world_clock_state"]
    msg = spark.createDataFrame([("world_clock", '{"clock_tick": 5, "year": 2026, "day_of_year": 1, '
                                  '"day_of_week": "M", "hour_of_day": 0, "minute": 5}', 0, 1)],
                                "topic string, value string, partition int, offset long")
    store.append(t, parse_topic(msg, t), 0)
    store.commit(0)
    assert store.state(t).count() == 1
    store.purge(0)
    assert store.state(t).count() == 0
    store.append(t, parse_topic(msg, t), 1)
    store.commit(1)
    assert store.state(t).count() == 1


def test_fetch_edge(spark, shipped):
    from tramline.plans import transit as tp
    from tramline.plans.serve import fetch
    net, ev = shipped
    pdf = fetch("live_train_positions", tp.live_train_positions(ev, net))
    assert list(pdf.columns)[:2] == ["train_id", "route_id"] and len(pdf) == 11


def test_compaction_keeps_state(spark, scratch):
    from tramline.schemas import EVENT_TABLES
    from tramline.sources.landing import LandingStore
    from tramline.streaming.ingest import parse_topic
    t = EVENT_TABLES["train_state"]

    def msgs(rows):
        return spark.createDataFrame(
            [("train_status", '{"clock_tick": %d, "train_id": %d, "segment_id": 1, "station_id": null, '
              '"stops_seen_so_far": [1], "passenger_count": %d}' % (tick, tid, n), 0, off)
             for off, (tick, tid, n) in enumerate(rows)], "topic string, value string, partition int, offset long")

    batches = [[(1, 7, 1), (1, 8, 1), (2, 7, 2)], [(2, 7, 3), (2000, 8, 4)], [(1, 7, 9), (3000, 9, 5)]]
    plain = LandingStore(spark, os.path.join(scratch, "plain"))
    comp = LandingStore(spark, os.path.join(scratch, "comp"))
    for b, rows in enumerate(batches):
        for store in (plain, comp):
            store.append(t, parse_topic(msgs(rows), t), b)
            store.commit(b)
        if b == 1:
            comp.compact(t, 1)
            comp.compact(t, 1)  # idempotent
    cols = ["clock_tick", "train_id", "passenger_count"]
    want = sorted(tuple(r) for r in plain.state(t).select(*cols).collect())
    assert sorted(tuple(r) for r in comp.state(t).select(*cols).collect()) == want
    assert want == [(1, 7, 9), (1, 8, 1), (2, 7, 3), (2000, 8, 4), (3000, 9, 5)]
    # reads after compaction: one snapshot row per key + the later batch
    assert comp.writes(t).count() == 4 + 2 and plain.writes(t).count() == 7
    # the snapshot as of batch 0 ignores the compaction at 1
    assert sorted(tuple(r) for r in comp.at(0).state(t).select(*cols).collect()) == \
        [(1, 7, 1), (1, 8, 1), (2, 7, 2)]
