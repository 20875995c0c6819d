"""All declared column tests of the models, sources and seeds, as one run with a row for each test.

The frames are the staged tables and the products over the adapter of
``given``; a frame that serves several tables is read once for all of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.operators.checks import declared_tests
from tramline.plans import given, transit
from tramline.plans.catalog import register
from tramline.session import settle

# The declared tests, as frame: (table, key column, further not-null columns, unique or not).
KEYS = {
    "clock_now": [("int_clock_current_state", "clock_tick", True), ("mart_world_clock", "clock_tick", True)],
    "station_now": [("int_station_passengers_recent_stats", "station_id", True), ("mart_live_station_crowding", "station_id", True)],
    "topology": [("int_route_topology", "route_id", False), ("int_route_topology", "stop_sequence", False)],
    "waits": [("int_passengers_wait_times", "passenger_id", True)],
    "spacing": [("int_train_spacing", "train_id", True), ("mart_live_headways", "train_id", True)],
    "positions": [("int_trains_linear_positions", "train_id", True), ("mart_live_train_positions", "train_id", True)],
    "segment_now": [("int_segments_recent_state", "segment_id", False)],
    "train_now": [("int_trains_recent_state", "train_id", True)],
    "utilization": [("int_trains_recent_utilization", "train_id", True)],
    "passenger_recent": [("int_passengers_recent_state", "passenger_id", False)],
    "wait_summary": [("mart_live_wait_times", "metric", False)],
    "stations": [("stg_stations", "station_id", True), ("stations", "station_id", True)],
    "routes": [("stg_routes", "route_id", False), ("stg_routes", "stop_sequence", False), ("stg_passenger_routes", "route_id", False)],
    "trains": [("stg_trains", "train_id", True), ("trains", "train_id", True)],
    "segments": [("stg_rail_segments", "segment_id", True)],
    "itinerary": [("stg_passenger_itinerary", "id", False), ("passenger_itinerary", "id", False)],
    "clock": [("stg_world_clock_state", "clock_tick", False), ("runtime_world_clock_state", "clock_tick", True)],
    "stats": [("stg_station_passenger_stats", "station_id", False), ("stg_station_passenger_stats", "clock_tick", False),
              ("station_passenger_stats", "station_id", False), ("station_passenger_stats", "clock_tick", False)],
    "passenger_log": [("stg_passenger_state", "passenger_id", False), ("runtime_passenger_state", "clock_tick", False),
                      ("runtime_passenger_state", "passenger_id", False)],
    "platform_log": [("stg_platform_state", "station_id", False), ("runtime_platform_state", "clock_tick", False),
                     ("runtime_platform_state", "station_id", False)],
    "segment_log": [("stg_rail_segment_state", "segment_id", False), ("runtime_rail_segment_state", "clock_tick", False),
                    ("runtime_rail_segment_state", "segment_id", False)],
    "train_log": [("stg_train_state", "train_id", False), ("runtime_train_state", "clock_tick", False),
                  ("runtime_train_state", "train_id", False)],
    "train_first": [("train_state", "train_id", True), ("train_state", "segment_id", False), ("train_state", "passenger_count", False)],
    "segment_first": [("rail_segment_state", "segment_id", True)],
    "platform_first": [("platform_state", "station_id", False), ("platform_state", "route_id", False), ("platform_state", "platform_state", False)],
}
COMBINATIONS = {
    "itinerary": [("passenger_itinerary", "id,passenger_route_id,start_arrival_hour,arrival_minute,travel_code")],
    "platform_first": [("platform_state", "station_id,route_id")],
}
TESTS = {frame: [t for table, column, unique in keys for t in [(table, "not_null", column), *[(table, "unique", column)] * unique]]
         + [(table, "unique_combination", columns) for table, columns in COMBINATIONS.get(frame, [])] for frame, keys in KEYS.items()}

_FIRST = "(select * from {0} where clock_tick = (select min(clock_tick) from clock))"
_SQL_FRAMES = {
    "clock_now": "(select * from clock, now where clock_tick = t)", "station_now": "station_now", "topology": "topo", "waits": "waits",
    "spacing": "spacing", "positions": "positions", "segment_now": "segment_now", "train_now": "train_now", "utilization": "utilization",
    "passenger_recent": "(select * from passenger_state, now where clock_tick >= t - 100)",
    "wait_summary": "(select * from (values ('Max'), ('Avg'), ('Min')) m(metric))", "stations": "stations", "routes": "routes",
    "trains": "trains", "segments": "segments", "itinerary": "itinerary", "clock": "clock", "stats": "station_stats",
    "passenger_log": "passenger_state", "platform_log": "platform_state",
    "segment_log": "(select distinct clock_tick, segment_id from segment_rows)", "train_log": "train_state",
    "train_first": _FIRST.format("train_state"), "platform_first": _FIRST.format("platform_state"),
    "segment_first": _FIRST.format("(select distinct clock_tick, segment_id from segment_rows)"),
}


def _sql_test(frame: str, table: str, kind: str, columns: str) -> str:
    source = _SQL_FRAMES[frame]
    if kind == "not_null":
        found = f"(select count(*) from {source} where {columns} is null)"
    else:
        known = f"where {columns} is not null" if kind == "unique" else ""
        found = f"(select count(*) from (select {columns} from {source} {known} group by {columns} having count(*) > 1))"
    return f"select '{table}' as table_name, '{kind}' as test, '{columns}' as column_name, {found} as failures"


def frames(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Every frame that has declared tests; the logs are written once, as most products read them."""
    net, raw = given.network(spark, d), given.events(spark, d)
    ev = transit.Events(**{k: settle(v, k) for k, v in vars(raw).items()})
    topology = settle(transit.route_topology(net), "topology")
    state = settle(transit.trains_recent_state(ev), "train-now")
    positions = settle(transit.trains_linear_positions(ev, net, state), "positions")
    first = ev.world_clock.agg(F.min("clock_tick")).scalar()
    at_first = lambda df: df.where(F.col("clock_tick") == first)
    return {
        "clock_now": transit.clock_current(ev), "station_now": transit.station_passengers_recent_stats(ev, net), "topology": topology,
        "waits": transit.passengers_wait_times(ev), "spacing": transit.train_spacing(ev, net, positions), "positions": positions,
        "segment_now": transit.segments_recent_state(ev), "train_now": state,
        "utilization": transit.trains_recent_utilization(ev, net, state), "passenger_recent": transit.passengers_recent_state(ev),
        "wait_summary": transit.live_wait_times(ev), "stations": net.stations, "routes": net.routes, "trains": net.trains,
        "segments": net.rail_segments, "itinerary": net.passenger_itinerary, "clock": ev.world_clock, "stats": ev.station_stats,
        "passenger_log": ev.passenger_state, "platform_log": ev.platform_state, "segment_log": ev.rail_segment_state,
        "train_log": ev.train_state, "train_first": at_first(ev.train_state), "segment_first": at_first(ev.rail_segment_state),
        "platform_first": at_first(ev.platform_state),
    }


@register("declared_tests", ("O-Q1", "O-Q2", "O-Q3"), given.GIVEN + " union all ".join(
    _sql_test(frame, *t) for frame, tests in TESTS.items() for t in tests))
def all_declared_tests(spark: SparkSession, d: str) -> DataFrame:
    have = frames(spark, d)
    return reduce(DataFrame.unionByName, [declared_tests(have[f], tests) for f, tests in TESTS.items()])
