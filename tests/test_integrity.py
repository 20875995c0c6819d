"""Integrity checks: the shipped network is clean; one broken input per rule."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tramline.plans import integrity as ig
from tramline.schemas import PASSENGER_ITINERARY


def ids(df):
    return {(r.check_id, r.entity) for r in df.collect()}


def test_shipped_network_is_clean(shipped):
    net, ev = shipped
    assert ig.run_all(net, ev).count() == 0


def test_missing_return_segment(shipped):
    net, ev = shipped
    broken = replace(net, rail_segments=net.rail_segments.where(F.col("segment_id") != 42))
    got = ids(ig.run_all(broken, ev))
    assert ("segment_without_return", "2,4") in got
    # route 3 travels 4 -> 2 which now has no segment
    assert ("route_pair_without_segment", "3,4,2") in got


def test_train_state_problems(shipped, spark):
    net, ev = shipped
    ts = ev.train_state
    bad = ts.withColumn("segment_id", F.when(F.col("train_id") == 101, F.lit(None)).otherwise(F.col("segment_id"))) \
        .withColumn("stops_seen_so_far", F.when(F.col("train_id") == 102, F.array(F.lit(1), F.lit(3)))
                    .otherwise(F.col("stops_seen_so_far"))) \
        .where(F.col("train_id") != 303)
    got = ids(ig.run_all(net, replace(ev, train_state=bad)))
    assert ("train_unlocated", "101") in got
    assert ("train_history_not_on_route", "102") in got
    assert ("train_without_state", "303") in got
    assert any(c == "segment_train_mismatch" and e.startswith("12,303") for c, e in got)


def test_train_on_foreign_segment(shipped):
    net, ev = shipped
    # train 101 (route 1: 1,2,3,2,1) placed on segment 24 (2 -> 4), not a leg of route 1
    ts = ev.train_state.withColumn("segment_id", F.when(F.col("train_id") == 101, F.lit(24))
                                   .otherwise(F.col("segment_id")))
    got = ids(ig.q17_trains_on_route_segments(net, replace(ev, train_state=ts)))
    assert got == {("train_segment_not_on_route", "101")}


def test_platform_checks(shipped):
    net, ev = shipped
    ps = ev.platform_state.withColumn(
        "platform_state", F.when((F.col("station_id") == 1) & (F.col("route_id") == 1), F.lit("Boarding"))
        .otherwise(F.col("platform_state"))).where(F.col("station_id") != 4)
    got = ids(ig.run_all(net, replace(ev, platform_state=ps)))
    assert ("unknown_platform_state", "1,1") in got
    assert ("station_without_platform_state", "4") in got
    assert ("route_station_without_platform", "3,4") in got


def test_two_trains_one_platform(shipped):
    net, ev = shipped
    ts = ev.train_state.withColumn("station_id", F.when(F.col("train_id").isin(101, 102), F.lit(2)))\
        .withColumn("segment_id", F.when(F.col("train_id").isin(101, 102), F.lit(None))
                    .otherwise(F.col("segment_id")))
    got = ids(ig.q22_platform_occupancy(net, replace(ev, train_state=ts)))
    assert got == {("platform_double_occupied", "2,1")}


def test_passenger_checks(shipped, spark):
    net, ev = shipped
    itinerary = spark.createDataFrame([(1, 1, 7, 30, "M"), (1, 2, 8, 30, "M"), (2, 9, 8, 30, "M"),
                                       (3, 1, 9, 0, "X"), (4, 1, 9, 0, "M"), (99999, 1, 7, 0, "T")], PASSENGER_ITINERARY)
    ps = ev.passenger_state.withColumn(
        "station_id", F.when(F.col("passenger_id") == 1, F.lit(4)).otherwise(F.col("station_id"))) \
        .withColumn("stops_seen_so_far", F.when(F.col("passenger_id").isin(1, 4), F.array(F.lit(2)))
                    .otherwise(F.col("stops_seen_so_far")))
    got = ids(ig.run_all(replace(net, passenger_itinerary=itinerary), replace(ev, passenger_state=ps)))
    assert ("itinerary_unknown_route", "2") in got
    assert ("itinerary_unknown_day", "3") in got
    assert ("passenger_without_state", "99999") in got
    assert ("passenger_off_route", "1") in got
    assert ("passenger_history_not_on_route", "1") in got
    assert ("passenger_without_past_plan", "4") in got  # today's only plan starts later
    assert ("passenger_lost", "4") in got


def test_two_plans_on_two_routes_are_no_violation(shipped, spark):
    """Only the plan that runs now counts: a valid passenger with a second plan is not reported."""
    net, ev = shipped
    itinerary = spark.createDataFrame([(1, 1, 7, 30, "M"), (1, 2, 17, 30, "M")], PASSENGER_ITINERARY)
    first = net.passenger_routes.where("route_id = 1").orderBy("stop_sequence").first().station_id
    ps = ev.passenger_state.withColumn(
        "station_id", F.when(F.col("passenger_id") == 1, F.lit(first)).otherwise(F.col("station_id"))) \
        .withColumn("stops_seen_so_far", F.when(F.col("passenger_id") == 1, F.array(F.lit(first)))
                    .otherwise(F.col("stops_seen_so_far")))
    assert ids(ig.run_all(replace(net, passenger_itinerary=itinerary), replace(ev, passenger_state=ps))) == set()


def test_a_train_listed_twice_is_found(shipped):
    net, ev = shipped
    twice = ev.rail_segment_state.withColumn("trains_present", F.concat("trains_present", "trains_present"))
    got = ids(ig.q14_segment_lists(replace(ev, rail_segment_state=twice)))
    assert any(e.startswith("12,204") for _, e in got)


def test_checks_need_the_passenger_tables(shipped):
    net, ev = shipped
    with pytest.raises(ValueError, match="passenger_itinerary"):
        ig.run_all(replace(net, passenger_itinerary=None), ev)


def test_empty_clock(shipped):
    net, ev = shipped
    got = ids(ig.q4_clock_present(replace(ev, world_clock=ev.world_clock.where(F.lit(False)))))
    assert got == {("clock_empty", "world_clock")}


@pytest.mark.parametrize("fixture_start", [0, 1])
def test_route_rows_renumber(spark, fixture_start):
    routes = spark.createDataFrame([(7, fixture_start + i, s) for i, s in enumerate([1, 2, 1])],
                                   "route_id int, stop_sequence int, station_id int")
    assert [r.seq for r in ig.route_rows(routes).orderBy("seq").collect()] == [0, 1, 2]
