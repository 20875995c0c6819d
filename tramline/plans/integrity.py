"""Network and state integrity checks.

Each rule is a join over whole tables and yields violation rows in the common
check frame; ``run_all`` unions them so every failure is reported at once.
Configuration errors and state errors are told apart by ``severity``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramline.operators import checks
from tramline.operators.state import as_of, latest_by_key, max_of
from tramline.plans.rules import history_violations
from tramline.plans.transit import Events, Network
from tramline.schemas import PLATFORM_STATES, WEEKDAY_CODES

CONFIG, STATE = "config", "state"


def _frame(df: DataFrame, check_id: str, table: str, column: str, entity, severity: str) -> DataFrame:
    ent = entity if not isinstance(entity, str) else F.col(entity).cast("string")
    return df.select(F.lit(check_id).alias("check_id"), F.lit(severity).alias("severity"),
                     F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), ent.alias("entity"))


def current_tick(ev: Events):
    return max_of(ev.world_clock, "clock_tick")


def snapshot(df: DataFrame, keys, ev: Events) -> DataFrame:
    """Latest row per key at or before the current tick (recovery read, O-A7/O-F3)."""
    return latest_by_key(as_of(df, "clock_tick", current_tick(ev)), keys, ["clock_tick"])


def route_rows(routes: DataFrame) -> DataFrame:
    """``(route, seq, station)`` with seq renumbered from 0 (fixtures may start at 1)."""
    w = Window.partitionBy("route_id").orderBy("stop_sequence")
    return routes.select(F.col("route_id").alias("route"), (F.row_number().over(w) - 1).alias("seq"),
                         F.col("station_id").alias("station"))


def route_pairs(routes: DataFrame, wrap: bool) -> DataFrame:
    """Consecutive ``(route, from, to)`` station pairs; with ``wrap`` also last -> first."""
    r = route_rows(routes)
    nxt = r.select("route", (F.col("seq") - 1).alias("seq"), F.col("station").alias("to_station"))
    pairs = r.join(nxt, ["route", "seq"]).select("route", F.col("station").alias("from_station"), "to_station")
    if wrap:
        ends = r.groupBy("route").agg(F.max(F.struct("seq", "station")).alias("last"),
                                      F.min(F.struct("seq", "station")).alias("first"))
        pairs = pairs.unionByName(ends.select("route", F.col("last.station").alias("from_station"),
                                              F.col("first.station").alias("to_station")))
    return pairs


def q4_clock_present(ev: Events) -> DataFrame:
    return _frame(checks.is_empty(ev.world_clock, "clock_empty", "world_clock"), "clock_empty", "world_clock", "",
                  F.lit("world_clock"), STATE)


def q5_itinerary_without_state(net: Network, ev: Events) -> DataFrame:
    people = snapshot(ev.passenger_state, ["passenger_id"], ev).select(F.col("passenger_id").alias("id"))
    miss = net.passenger_itinerary.select("id").distinct().join(people, "id", "left_anti")
    return _frame(miss, "passenger_without_state", "passenger_itinerary", "id", "id", STATE)


def q6_itinerary_codes(net: Network) -> DataFrame:
    it = net.passenger_itinerary
    routes = net.passenger_routes.select(F.col("route_id").alias("passenger_route_id")).distinct()
    bad_route = it.join(routes, "passenger_route_id", "left_anti")
    bad_code = it.where(~F.col("travel_code").isin(WEEKDAY_CODES) | F.col("travel_code").isNull())
    return _frame(bad_route, "itinerary_unknown_route", "passenger_itinerary", "passenger_route_id", "id", CONFIG) \
        .unionByName(_frame(bad_code, "itinerary_unknown_day", "passenger_itinerary", "travel_code", "id", CONFIG))


def q7_train_without_state(net: Network, ev: Events) -> DataFrame:
    now = ev.train_state.where(F.col("clock_tick") == current_tick(ev)).select("train_id").distinct()
    miss = net.trains.select("train_id").join(now, "train_id", "left_anti")
    return _frame(miss, "train_without_state", "trains", "train_id", "train_id", STATE)


def q8_train_route_undefined(net: Network) -> DataFrame:
    miss = net.trains.join(net.routes.select("route_id").distinct(), "route_id", "left_anti")
    return _frame(miss, "train_route_undefined", "trains", "route_id", "train_id", CONFIG)


def q9_train_history(net: Network, ev: Events) -> DataFrame:
    st = snapshot(ev.train_state, ["train_id"], ev).join(net.trains.select("train_id", "route_id"), "train_id")
    bad = history_violations(st.withColumnRenamed("route_id", "route"), route_rows(net.routes), "train_id", "route",
                             "stops_seen_so_far")
    return _frame(bad, "train_history_not_on_route", "train_state", "stops_seen_so_far", "train_id", STATE)


def q10_train_unlocated(ev: Events) -> DataFrame:
    st = snapshot(ev.train_state, ["train_id"], ev)
    bad = st.where(F.col("station_id").isNull() & F.col("segment_id").isNull())
    return _frame(bad, "train_unlocated", "train_state", "station_id,segment_id", "train_id", STATE)


def q11_station_connectivity(net: Network) -> DataFrame:
    s = net.stations.select("station_id")
    outgoing = net.rail_segments.select(F.col("from_station_id").alias("station_id")).distinct()
    incoming = net.rail_segments.select(F.col("to_station_id").alias("station_id")).distinct()
    return _frame(s.join(incoming, "station_id", "left_anti"), "station_no_incoming", "stations", "station_id",
                  "station_id", CONFIG) \
        .unionByName(_frame(s.join(outgoing, "station_id", "left_anti"), "station_no_outgoing", "stations",
                            "station_id", "station_id", CONFIG))


def q12_platforms(net: Network, ev: Events) -> DataFrame:
    now = ev.platform_state.where(F.col("clock_tick") == current_tick(ev))
    miss = net.stations.select("station_id").join(now.select("station_id").distinct(), "station_id", "left_anti")
    bad_code = now.where(~F.col("platform_state").isin(PLATFORM_STATES) | F.col("platform_state").isNull())
    return _frame(miss, "station_without_platform_state", "stations", "station_id", "station_id", STATE) \
        .unionByName(_frame(bad_code, "unknown_platform_state", "platform_state", "platform_state",
                            F.concat_ws(",", "station_id", "route_id"), STATE))


def plans_as_of(net: Network, ev: Events) -> DataFrame:
    """``(passenger_id, route)``: each passenger's plan now -- the latest of today's weekday that has started (O-R3)."""
    now = ev.world_clock.where(F.col("clock_tick") == current_tick(ev)).limit(1).select(F.struct(
        F.col("day_of_week").alias("day"), (F.col("hour_of_day") * 60 + F.col("minute")).alias("minute"))).scalar()
    start = F.col("start_arrival_hour") * 60 + F.col("arrival_minute")
    due = net.passenger_itinerary.withColumn("_start", start).where(
        F.contains(F.col("travel_code"), now["day"]) & (F.col("_start") <= now["minute"]))
    return latest_by_key(due, ["id"], ["_start", "passenger_route_id"], ["passenger_route_id"]).select(
        F.col("id").alias("passenger_id"), F.col("passenger_route_id").alias("route"))


def q13_passenger_history(net: Network, ev: Events) -> DataFrame:
    st = snapshot(ev.passenger_state, ["passenger_id"], ev).join(plans_as_of(net, ev), "passenger_id")
    bad = history_violations(st, route_rows(net.passenger_routes), "passenger_id", "route", "stops_seen_so_far")
    return _frame(bad, "passenger_history_not_on_route", "passenger_state", "stops_seen_so_far", "passenger_id",
                  STATE)


def q14_segment_lists(ev: Events) -> DataFrame:
    seg = snapshot(ev.rail_segment_state, ["segment_id"], ev)
    listed = seg.select("segment_id", F.explode("trains_present").alias("t")) \
        .select("segment_id", F.col("t.id").alias("train_id"))
    placed = snapshot(ev.train_state, ["train_id"], ev).where(F.col("segment_id").isNotNull()) \
        .select("segment_id", "train_id")
    diff = checks.disagreement(listed, placed, ["segment_id", "train_id"])
    return _frame(diff, "segment_train_mismatch", "rail_segment_state", "trains_present",
                  F.concat_ws(",", "segment_id", "train_id", "side"), STATE)


def q15_train_station_defined(net: Network, ev: Events) -> DataFrame:
    st = snapshot(ev.train_state, ["train_id"], ev).where(F.col("station_id").isNotNull())
    bad = st.join(net.stations.select("station_id"), "station_id", "left_anti")
    return _frame(bad, "train_at_undefined_station", "train_state", "station_id", "train_id", CONFIG)


def q16_symmetric_segments(net: Network) -> DataFrame:
    bad = checks.asymmetric_edges(net.rail_segments, "from_station_id", "to_station_id")
    return _frame(bad, "segment_without_return", "rail_segments", "from_station_id,to_station_id",
                  F.concat_ws(",", "from_station_id", "to_station_id"), CONFIG)


def q17_trains_on_route_segments(net: Network, ev: Events) -> DataFrame:
    st = snapshot(ev.train_state, ["train_id"], ev).where(F.col("segment_id").isNotNull()) \
        .join(net.trains.select("train_id", F.col("route_id").alias("route")), "train_id")
    undefined = st.join(net.rail_segments.select("segment_id"), "segment_id", "left_anti")
    on = st.join(net.rail_segments.select("segment_id", F.col("from_station_id").alias("from_station"),
                                          F.col("to_station_id").alias("to_station")), "segment_id")
    off_route = on.join(route_pairs(net.routes, wrap=True), ["route", "from_station", "to_station"], "left_anti")
    return _frame(undefined, "train_on_undefined_segment", "train_state", "segment_id", "train_id", CONFIG) \
        .unionByName(_frame(off_route, "train_segment_not_on_route", "train_state", "segment_id", "train_id", CONFIG))


def q18_passenger_location(net: Network, ev: Events) -> DataFrame:
    st = snapshot(ev.passenger_state, ["passenger_id"], ev)
    plans = plans_as_of(net, ev)
    travelling = st.where(F.size("stops_seen_so_far") > 0)
    lost = travelling.where(F.col("station_id").isNull() & F.col("train_id").isNull())
    # a passenger under way without a plan that has started cannot be resumed
    unplanned = travelling.join(net.passenger_itinerary.select(F.col("id").alias("passenger_id")).distinct(), "passenger_id",
                                "left_semi").join(plans, "passenger_id", "left_anti")
    at = st.where(F.col("station_id").isNotNull()).join(plans, "passenger_id") \
        .join(route_rows(net.passenger_routes).select("route", F.col("station").alias("station_id")).distinct(),
              ["route", "station_id"], "left_anti")
    ghost_train = st.where(F.col("train_id").isNotNull()).join(net.trains.select("train_id"), "train_id", "left_anti")
    return _frame(lost, "passenger_lost", "passenger_state", "station_id,train_id", "passenger_id", STATE) \
        .unionByName(_frame(unplanned, "passenger_without_past_plan", "passenger_state", "stops_seen_so_far",
                            "passenger_id", STATE)) \
        .unionByName(_frame(at, "passenger_off_route", "passenger_state", "station_id", "passenger_id", CONFIG)) \
        .unionByName(_frame(ghost_train, "passenger_on_undefined_train", "passenger_state", "train_id",
                            "passenger_id", STATE))


def q19_route_stations(net: Network, ev: Events) -> DataFrame:
    r = net.routes.select("route_id", "station_id").distinct()
    undefined = r.join(net.stations.select("station_id"), "station_id", "left_anti")
    platforms = ev.platform_state.select("station_id", "route_id").distinct()
    no_platform = r.join(net.stations.select("station_id"), "station_id").join(platforms, ["station_id", "route_id"],
                                                                                "left_anti")
    return _frame(undefined, "route_undefined_station", "routes", "station_id",
                  F.concat_ws(",", "route_id", "station_id"), CONFIG) \
        .unionByName(_frame(no_platform, "route_station_without_platform", "routes", "station_id",
                            F.concat_ws(",", "route_id", "station_id"), CONFIG))


def q20_platform_routes(net: Network, ev: Events) -> DataFrame:
    p = ev.platform_state.select("station_id", "route_id").distinct()
    bad = p.join(net.routes.select("route_id").distinct(), "route_id", "left_anti")
    return _frame(bad, "platform_undefined_route", "platform_state", "route_id",
                  F.concat_ws(",", "station_id", "route_id"), CONFIG)


def q21_route_connectivity(net: Network) -> DataFrame:
    seg = net.rail_segments.select(F.col("from_station_id").alias("from_station"),
                                   F.col("to_station_id").alias("to_station")).distinct()
    frames = []
    for label, routes in (("train", net.routes), ("passenger", net.passenger_routes)):
        if routes is None:
            continue
        short = routes.groupBy("route_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < 2)
        gaps = route_pairs(routes, wrap=False).join(seg, ["from_station", "to_station"], "left_anti")
        frames.append(_frame(short, "route_too_short", f"{label}_routes", "route_id", "route_id", CONFIG))
        frames.append(_frame(gaps, "route_pair_without_segment", f"{label}_routes", "station_id",
                             F.concat_ws(",", "route", "from_station", "to_station"), CONFIG))
    return checks.suite(*frames)


def q22_platform_occupancy(net: Network, ev: Events) -> DataFrame:
    docked = snapshot(ev.train_state, ["train_id"], ev).where(F.col("station_id").isNotNull()) \
        .join(net.trains.select("train_id", "route_id"), "train_id")
    crowded = docked.groupBy("station_id", "route_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return _frame(crowded, "platform_double_occupied", "train_state", "station_id,route_id",
                  F.concat_ws(",", "station_id", "route_id"), STATE)


def run_all(net: Network, ev: Events) -> DataFrame:
    """All checks, always: a network without passenger tables is an error, not fewer checks."""
    if net.passenger_itinerary is None or net.passenger_routes is None:
        raise ValueError("the checks need passenger_itinerary and passenger_routes (they may be empty tables)")
    return checks.suite(
        q4_clock_present(ev), q5_itinerary_without_state(net, ev), q6_itinerary_codes(net), q7_train_without_state(net, ev),
        q8_train_route_undefined(net), q9_train_history(net, ev), q10_train_unlocated(ev), q11_station_connectivity(net),
        q12_platforms(net, ev), q13_passenger_history(net, ev), q14_segment_lists(ev), q15_train_station_defined(net, ev),
        q16_symmetric_segments(net), q17_trains_on_route_segments(net, ev), q18_passenger_location(net, ev),
        q19_route_stations(net, ev), q20_platform_routes(net, ev), q21_route_connectivity(net),
        q22_platform_occupancy(net, ev))
