"""Hand-computed goldens for the shipped network at tick 1 (FIXTURES.md §4)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tramline.plans import transit as tp

# Train -> (route, distance from start, train ahead, gap) at tick 1.
POSITIONS = {
    101: (1, 12.00, 102, 1.86), 102: (1, 13.86, 103, 5.90), 103: (1, 19.76, 104, 0.91),
    104: (1, 20.67, 101, 13.93), 201: (2, 2.46, 202, 6.21), 202: (2, 8.67, 203, 0.55),
    203: (2, 9.22, 204, 2.48), 204: (2, 11.70, 201, 13.36), 301: (3, 3.89, 302, 7.74),
    302: (3, 11.63, 303, 1.32), 303: (3, 12.95, 301, 8.14),
}


def test_route_topology(shipped):
    ev, net = shipped[1], shipped[0]
    rows = tp.route_topology(net).orderBy("route_id", "stop_sequence").collect()
    cum = {}
    for r in rows:
        cum.setdefault(r.route_id, []).append(round(r.distance_from_start_km, 2))
        assert r.max_system_length_km == pytest.approx(22.6)
    assert cum == {1: [0, 7.3, 11.3, 15.3, 22.6], 2: [0, 4.0, 11.3, 18.6, 22.6], 3: [0, 1.3, 8.6, 15.9, 17.2]}


def test_positions_and_spacing(shipped):
    net, ev = shipped
    rows = {r.train_id: r for r in tp.train_spacing(ev, net).collect()}
    assert set(rows) == set(POSITIONS)
    for tid, (route, dist, ahead, gap) in POSITIONS.items():
        r = rows[tid]
        assert r.route_id == route
        assert round(r.distance_from_start_km, 2) == pytest.approx(dist)
        assert r.train_ahead_id == ahead
        assert round(r.gap_to_next_train_km, 2) == pytest.approx(gap)
    per_route = {}
    for r in rows.values():
        per_route[r.route_id] = per_route.get(r.route_id, 0) + r.gap_to_next_train_km
    assert {k: round(v, 6) for k, v in per_route.items()} == {1: 22.6, 2: 22.6, 3: 17.2}


def test_headways_all_optimal(shipped):
    net, ev = shipped
    rows = tp.live_headways(ev, net).collect()
    assert len(rows) == 11
    assert {r.spacing_health for r in rows} == {"🟢 Optimal"}
    assert {r.train_id: r.gap_km for r in rows}[204] == Decimal("13.36")


def test_edges_extents_clock(shipped):
    net, ev = shipped
    assert tp.system_topology_edges(net).count() == 12
    ext = {r.route_id: (r.start_km, round(r.end_km, 6)) for r in tp.track_extents(net).collect()}
    assert ext == {1: (0.0, 22.6), 2: (0.0, 22.6), 3: (0.0, 17.2)}
    clock = tp.world_clock_mart(ev).collect()
    assert [(c.day_name, c.month_name, c.day_of_month, c.hour_of_day, c.minute) for c in clock] == \
        [("Monday", "February", 23, 8, 0)]


def test_kpis_crowding_waits(shipped):
    net, ev = shipped
    k = tp.live_system_kpis(ev, net).collect()
    assert len(k) == 1
    assert (k[0].total_passengers_in_system, k[0].total_passengers_riding, k[0].total_passengers_waiting,
            k[0].avg_network_utilization_pct, k[0].active_trains) == (0, 0, 0, Decimal("0.0"), 11)
    assert tp.live_station_crowding(ev, net).count() == 0
    waits = [(r.metric, r.wait_time) for r in tp.live_wait_times(ev).collect()]
    assert sorted(waits) == sorted([("Max", Decimal("0")), ("Avg", Decimal("0")), ("Min", Decimal("0"))])


def test_segment_rows(shipped):
    net, ev = shipped
    rows = tp.segments_recent_state(ev).collect()
    assert len([r for r in rows if r.train_id is not None]) == 11
    assert sorted(r.segment_id for r in rows if r.train_id is None) == [23, 24, 42]
    assert all(r.status == "MOVING" for r in tp.trains_recent_state(ev).collect())
    assert {r.utilization_pct for r in tp.trains_recent_utilization(ev, net).collect()} == {Decimal("0.0")}


def test_health_bands(spark):
    from tramline.functions import bands
    df = spark.createDataFrame([(0.199,), (0.2,), (0.499,), (0.5,), (0.1999,)], "g double")
    got = [r.h for r in df.select(bands("g", tp.HEALTH_BANDS, tp.HEALTH_DEFAULT).alias("h")).collect()]
    assert got == ["🔴 Bunched", "🟡 Gapped", "🟡 Gapped", "🟢 Optimal", "🔴 Bunched"]


def test_wait_time_trace(spark):
    """Station at 10, train at 14 and 20, station at 25, train at 34 -> waits 4 and 9;
    a passenger whose first located row is on a train yields no wait."""
    from tramline.operators.sequence import completed_waits
    rows = [(7, 10, None, 1), (7, 14, 5, None), (7, 20, 5, None), (7, 25, None, 2), (7, 34, 6, None),
            (8, 3, 9, None), (8, 4, 9, None)]
    df = spark.createDataFrame(rows, "pid int, tick int, train int, station int")
    for bounded in (True, False):
        got = sorted((r.pid, r.w) for r in completed_waits(df, "pid", "tick", "train", "station",
                                                           out_wait="w", bounded=bounded).collect())
        assert got == [(7, 4), (7, 9)]


def test_lone_train_leads_itself(spark):
    from tramline.operators.gaps import circular_gap
    df = spark.createDataFrame([(1, 9, 3.5), (2, 5, 1.0), (2, 6, 1.0)], "route int, tid int, pos double")
    lengths = spark.createDataFrame([(1, 10.0), (2, 8.0)], "route int, len double")
    got = {r.tid: (r.ahead_id, r.gap) for r in
           circular_gap(df, ["route"], "pos", "tid", lengths, "len").collect()}
    # lone train: whole loop; equal positions: ordered by id
    assert got == {9: (9, 10.0), 5: (6, 0.0), 6: (5, 8.0)}


def test_empty_inputs_keep_fixed_rows(spark, shipped):
    """No trains, no stations, no passengers: KPIs one row of zeros, waits three zero rows."""
    from dataclasses import replace
    from pyspark.sql import functions as F
    net, ev = shipped
    none = replace(ev, train_state=ev.train_state.where(F.lit(False)),
                   passenger_state=ev.passenger_state.where(F.lit(False)))
    k = tp.live_system_kpis(none, net).collect()
    assert [tuple(r) for r in k] == [(0, 0, 0, Decimal("0.0"), 0)]
    assert sorted(tuple(r) for r in tp.live_wait_times(none).collect()) == \
        [("Avg", Decimal("0.0")), ("Max", Decimal("0.0")), ("Min", Decimal("0.0"))]


def test_utilization_rounding_and_zero_capacity(spark):
    from tramline.functions import safe_pct
    df = spark.createDataFrame([(3, 8), (1, 3), (2, 3), (5, 0), (4, None), (1, 16)], "n int, cap int")
    got = [r.p for r in df.select(safe_pct("n", "cap", 1).alias("p")).collect()]
    assert got == [Decimal("37.5"), Decimal("33.3"), Decimal("66.7"), None, None, Decimal("6.3")]


def test_stop_index_null_and_empty(spark):
    from tramline.functions import stop_index
    df = spark.createDataFrame([(None,), ([],), ([4],), ([4, 2, 1],)], "h array<int>")
    assert [r.i for r in df.select(stop_index("h").alias("i")).collect()] == [0, 0, 0, 2]


def test_bad_seed_json_fails(spark, scratch):
    import os
    import pytest
    from tramline.schemas import SEGMENT_STATE, TRAINS_PRESENT_DDL
    from tramline.sources.seeds import read_seed
    p = os.path.join(scratch, "bad.csv")
    with open(p, "w") as fh:
        fh.write('segment_id,clock_tick,trains_present\n12,1,"[{""id"": 1, ""position_km"": 0.4"\n')
    with pytest.raises(Exception):
        read_seed(spark, p, SEGMENT_STATE, json_cols={"trains_present": TRAINS_PRESENT_DDL}).collect()


def test_staged_segment_length_rounds_half_up(spark):
    from tramline.plans.transit import Network, staged_segments
    segs = spark.createDataFrame([(1, 1, 2, 7.5, 0.2), (2, 2, 1, 7.3, 0.2), (3, 2, 3, 1.3, 0.3)],
                                 "segment_id int, from_station_id int, to_station_id int, distance_km double, "
                                 "speed double")
    net = Network(None, None, None, segs)
    assert [r.distance_km for r in staged_segments(net).orderBy("segment_id").collect()] == [8, 7, 1]


def test_map_edge_geometry_offsets(shipped):
    """Corridor North Park - Downtown Central carries routes 1, 2, 3 in order of
    first appearance: offsets 0, +12, -12 along the edge normal."""
    import math
    net, ev = shipped
    rows = {(r.route_id, tuple(r.corridor)): r for r in tp.map_edge_geometry(net).collect()}
    corridor = ("Downtown Central", "North Park")
    got = {route: rows[(route, corridor)] for route in (1, 2, 3)}
    assert [got[r].offset_index for r in (1, 2, 3)] == [0, 1, 2]
    # route 1 is drawn unshifted from its first edge North Park -> Downtown Central
    assert (got[1].x1, got[1].y1, got[1].x2, got[1].y2) == (100.0, 150.0, 350.0, 230.0)
    for r in (2, 3):
        # shifted copies are parallel and 12 units from the station-to-station line
        dx, dy = got[r].x2 - got[r].x1, got[r].y2 - got[r].y1
        px, py = got[r].x1 - 350.0, got[r].y1 - 230.0
        dist = abs(dx * py - dy * px) / math.hypot(dx, dy)
        assert dist == pytest.approx(12.0)
    assert len(rows) == 6


def test_passengers_recent_state(shipped):
    net, ev = shipped
    assert tp.passengers_recent_state(ev).count() == 2370


def test_staging_cuts_text_to_its_width(shipped):
    """A 60-character platform state becomes 50 characters, as a cast to varchar(50) does."""
    from dataclasses import replace

    from tramline.plans.transit import stage_events
    _, ev = shipped
    long = ev.platform_state.withColumn("platform_state", F.lit("x" * 60))
    staged = stage_events(None, replace(ev, platform_state=long))
    assert {r.platform_state for r in staged.platform_state.collect()} == {"x" * 50}


def test_route_topology_is_served_in_route_order(shipped):
    from tramline.plans.serve import fetch
    net, _ = shipped
    got = fetch("route_topology_mart", tp.route_topology_mart(net))
    assert list(zip(got.route_id, got.stop_sequence)) == sorted(zip(got.route_id, got.stop_sequence))
