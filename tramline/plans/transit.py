"""The transit data products, as lazy DataFrames composed from the operators.

Inputs are two bundles: ``Network`` (static configuration; joins with it carry
no hint, Spark broadcasts a side it has measured as small) and ``Events`` (the staged event
logs: seed rows UNION ALL live rows, typed). Each function returns a lazy
frame; nothing is collected.

Look-back windows: trains, segments and station stats keep the last 6 ticks
(``now - 5`` inclusive), passengers the last 101 (``now - 100``).
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline import functions as fx
from tramline.operators.gaps import circular_gap, with_global_max
from tramline.operators.nested import explode_array
from tramline.operators.sequence import completed_waits, neighbors, running_total
from tramline.operators.sets import typed_union, unpivot_row
from tramline.operators.state import current_rows, latest_by_key, recent
from tramline.schemas import (PASSENGER_ROUTES, PASSENGER_ITINERARY, PASSENGER_STATE, PLATFORM_STATE,
                              RAIL_SEGMENTS, ROUTES, SEGMENT_STATE, STATION_STATS, STATIONS, TRAIN_STATE,
                              TRAINS, WORLD_CLOCK)

# Look-back lengths in ticks and the spacing-health bands (km, label).
RECENT_TICKS = 5
PASSENGER_RECENT_TICKS = 100
HEALTH_BANDS = [(0.2, "🔴 Bunched"), (0.5, "🟡 Gapped")]
HEALTH_DEFAULT = "🟢 Optimal"


@dataclass
class Network:
    stations: DataFrame
    routes: DataFrame
    trains: DataFrame
    rail_segments: DataFrame
    passenger_routes: DataFrame | None = None
    passenger_itinerary: DataFrame | None = None


@dataclass
class Events:
    world_clock: DataFrame
    train_state: DataFrame
    passenger_state: DataFrame
    rail_segment_state: DataFrame
    platform_state: DataFrame
    station_stats: DataFrame


# Text widths of the staging views; an explicit cast truncates.
VARCHAR = {"platform_state": {"platform_state": 50}, "world_clock": {"day_of_week": 10}}

_EVENT_SCHEMAS = {
    "world_clock": WORLD_CLOCK, "train_state": TRAIN_STATE, "passenger_state": PASSENGER_STATE,
    "rail_segment_state": SEGMENT_STATE, "platform_state": PLATFORM_STATE, "station_stats": STATION_STATS,
}


# ---- staging (O-P1..O-P12) ---------------------------------------------------

def stage_network(net: Network) -> Network:
    """Typed projections of the static tables (raw segment length kept as double)."""
    from tramline.operators.sets import conform
    return Network(
        stations=conform(net.stations, STATIONS),
        routes=conform(net.routes, ROUTES),
        trains=conform(net.trains, TRAINS),
        rail_segments=conform(net.rail_segments, RAIL_SEGMENTS),
        passenger_routes=None if net.passenger_routes is None else conform(net.passenger_routes, PASSENGER_ROUTES),
        passenger_itinerary=None if net.passenger_itinerary is None else conform(net.passenger_itinerary,
                                                                                   PASSENGER_ITINERARY),
    )


def staged_segments(net: Network) -> DataFrame:
    """Segment staging view: lengths as integers rounded half away from zero."""
    s = net.rail_segments
    return s.select("segment_id", "from_station_id", "to_station_id",
                    F.round(F.col("distance_km")).cast("int").alias("distance_km"),
                    F.col("speed").cast("decimal(18,6)").alias("speed"))


def stage_events(seed: Events | None, live: Events) -> Events:
    """Seed UNION ALL live with identical casts. Station stats have no seed."""
    out = {}
    for f in fields(Events):
        schema = _EVENT_SCHEMAS[f.name]
        parts = [getattr(live, f.name)]
        if seed is not None and f.name != "station_stats" and getattr(seed, f.name) is not None:
            parts.insert(0, getattr(seed, f.name))
        out[f.name] = typed_union(parts, schema)
        for column, width in VARCHAR.get(f.name, {}).items():
            out[f.name] = out[f.name].withColumn(column, F.left(column, F.lit(width)))
    return Events(**out)


# ---- intermediate -------------------------------------------------------------

def clock_current(ev: Events) -> DataFrame:
    """O-M1: the clock row(s) at the largest tick."""
    return current_rows(ev.world_clock, "clock_tick").select(
        "clock_tick", "year", "day_of_year", "day_of_week", "hour_of_day", "minute")


def trains_recent_state(ev: Events) -> DataFrame:
    """O-M2: latest row per train among the last 6 ticks, with status and stop index."""
    rows = recent(ev.train_state, "clock_tick", RECENT_TICKS, anchor=ev.world_clock)
    latest = latest_by_key(rows, ["train_id"], ["clock_tick"],
                           ["clock_tick", "station_id", "segment_id", "stops_seen_so_far", "passenger_count"])
    return latest.select(
        "train_id", "station_id", "segment_id", "stops_seen_so_far", "passenger_count",
        fx.entity_status("segment_id", "station_id").alias("status"),
        fx.stop_index("stops_seen_so_far").alias("recent_stop_sequence"))


def segments_recent_state(ev: Events) -> DataFrame:
    """O-M3: per segment's latest row in the last 6 ticks, one row per train on it,
    or one row with null train for an empty segment."""
    rows = recent(ev.rail_segment_state, "clock_tick", RECENT_TICKS, anchor=ev.world_clock)
    latest = latest_by_key(rows, ["segment_id"], ["clock_tick"], ["clock_tick", "trains_present"])
    flat = explode_array(latest, "trains_present", "t", outer=True)
    return flat.select("segment_id", F.col("t.id").alias("train_id"),
                       F.col("t.position_km").alias("train_position"),
                       F.col("clock_tick").alias("last_updated_tick"))


def station_passengers_recent_stats(ev: Events, net: Network) -> DataFrame:
    """O-M4: latest stats row per station in the last 6 ticks, with the station name."""
    rows = recent(ev.station_stats, "clock_tick", RECENT_TICKS, anchor=ev.world_clock)
    cols = ["total_passengers_in_station", "passengers_boarded_trains", "passengers_entered_station",
            "passengers_waiting"]
    latest = latest_by_key(rows, ["station_id"], ["clock_tick"], ["clock_tick", *cols])
    names = net.stations.select("station_id", "station_name")
    return latest.join(names, "station_id", "left").select("station_id", "station_name", *cols)


def passengers_recent_state(ev: Events) -> DataFrame:
    """O-M5: passenger rows of the last 101 ticks."""
    rows = recent(ev.passenger_state, "clock_tick", PASSENGER_RECENT_TICKS, anchor=ev.world_clock)
    return rows.select("clock_tick", "passenger_id", "train_id", "station_id")


def passengers_wait_times(ev: Events, since_tick: int | None = None) -> DataFrame:
    """O-M6: one row per completed wait (station -> boarded), over all history."""
    rows = ev.passenger_state
    if since_tick is not None:
        rows = rows.where(F.col("clock_tick") >= F.lit(since_tick))
    return completed_waits(rows, "passenger_id", "clock_tick", "train_id", "station_id")


def route_topology(net: Network) -> DataFrame:
    """O-M7: per (route, stop) the leg length from the previous stop and the
    cumulative distance; plus the longest cumulative distance in the network."""
    stops = net.routes.join(net.stations, "station_id", "inner")
    stops = neighbors(stops, ["route_id"], ["stop_sequence"], ["station_id"], "prev",
                      prefix="previous_", bounded=True)
    seg = net.rail_segments.select(F.col("from_station_id").alias("previous_station_id"),
                                   F.col("to_station_id").alias("station_id"),
                                   F.col("distance_km").cast("double").alias("_km"))
    legs = stops.join(seg, ["previous_station_id", "station_id"], "left")
    legs = legs.withColumn("segment_km", F.coalesce(F.col("_km"), F.lit(0.0)))
    cum = running_total(legs, ["route_id"], ["stop_sequence"], "segment_km", "distance_from_start_km",
                        bounded=True)
    cum = cum.select("route_id", "stop_sequence", "station_name", "map_x", "map_y", "segment_km",
                     "distance_from_start_km")
    return with_global_max(cum, "distance_from_start_km", "max_system_length_km")


def trains_linear_positions(ev: Events, net: Network, state: DataFrame | None = None) -> DataFrame:
    """O-M8: distance along the route = cumulative km of the last stop + offset on
    the current segment (0 without one). Trains whose stop index is not on
    their route's topology are dropped."""
    state = trains_recent_state(ev) if state is None else state
    current = state.join(net.trains.select("train_id", "route_id"), "train_id", "inner")
    topo = route_topology(net).select("route_id", F.col("stop_sequence").alias("recent_stop_sequence"),
                                      F.col("distance_from_start_km").alias("base_distance_km"))
    base = current.join(topo, ["route_id", "recent_stop_sequence"], "inner")
    offsets = segments_recent_state(ev).where(F.col("train_id").isNotNull()) \
        .select("segment_id", "train_id", "train_position")
    pos = base.join(offsets, ["segment_id", "train_id"], "left")
    return pos.select("train_id", "route_id", "status", "passenger_count",
                      (F.col("base_distance_km") + F.coalesce(F.col("train_position"), F.lit(0.0)))
                      .alias("distance_from_start_km"))


def route_lengths(net: Network) -> DataFrame:
    return route_topology(net).groupBy("route_id").agg(F.max("distance_from_start_km").alias("total_route_km"))


def train_spacing(ev: Events, net: Network, positions: DataFrame | None = None) -> DataFrame:
    """O-M9: leader and gap per train on its (circular) route; ties by train id."""
    positions = trains_linear_positions(ev, net) if positions is None else positions
    base = positions.select("train_id", "route_id", "distance_from_start_km")
    return circular_gap(base, ["route_id"], "distance_from_start_km", "train_id",
                        route_lengths(net), "total_route_km", "train_ahead_id", "gap_to_next_train_km",
                        bounded=True)


def trains_recent_utilization(ev: Events, net: Network, state: DataFrame | None = None) -> DataFrame:
    """O-M10: riders over capacity in percent, one decimal; null for zero/unknown capacity."""
    state = trains_recent_state(ev) if state is None else state
    caps = net.trains.select("train_id", "capacity")
    return state.join(caps, "train_id", "left").select(
        "train_id", "passenger_count", "capacity",
        fx.safe_pct("passenger_count", "capacity", 1).alias("utilization_pct"))


# ---- marts -----------------------------------------------------------------------

def world_clock_mart(ev: Events) -> DataFrame:
    """O-M11: the current tick as calendar text."""
    cur = clock_current(ev)
    cal = fx.calendar_parts("year", "day_of_year")
    return cur.select("clock_tick", "year", "hour_of_day", "minute",
                      cal["day_name"].alias("day_name"), cal["month_name"].alias("month_name"),
                      cal["day_of_month"].alias("day_of_month"))


def live_train_positions(ev: Events, net: Network) -> DataFrame:
    """O-M12."""
    state = trains_recent_state(ev)
    pos = trains_linear_positions(ev, net, state)
    util = trains_recent_utilization(ev, net, state).select("train_id", "utilization_pct")
    return pos.join(util, "train_id", "left").select(
        "train_id", "route_id", "status", "passenger_count", "utilization_pct", "distance_from_start_km")


def route_topology_mart(net: Network) -> DataFrame:
    """O-M13."""
    return route_topology(net).select("route_id", "stop_sequence", "station_name", "segment_km",
                                      "distance_from_start_km")


def _edges_in_order(net: Network) -> DataFrame:
    topo = route_topology(net).select("route_id", "stop_sequence", "station_name", "map_x", "map_y")
    seq = neighbors(topo, ["route_id"], ["stop_sequence"], ["station_name"], "next", prefix="next_",
                    bounded=True)
    return seq.where(F.col("next_station_name").isNotNull())


def system_topology_edges(net: Network) -> DataFrame:
    """O-M14: directed edges per route with the map position of the start."""
    return _edges_in_order(net).select("route_id", "station_name", "map_x", "map_y", "next_station_name")


def live_headways(ev: Events, net: Network) -> DataFrame:
    """O-M15: gap to 2 decimals and a health label judged on the unrounded gap."""
    sp = train_spacing(ev, net)
    return sp.select("train_id", "route_id", "train_ahead_id",
                     F.round(F.col("gap_to_next_train_km").cast("decimal(20,10)"), 2)
                     .cast("decimal(18,2)").alias("gap_km"),
                     fx.bands("gap_to_next_train_km", HEALTH_BANDS, HEALTH_DEFAULT).alias("spacing_health"))


def live_station_crowding(ev: Events, net: Network) -> DataFrame:
    """O-M17."""
    return station_passengers_recent_stats(ev, net).select(
        "station_id", "station_name", "total_passengers_in_station", "passengers_waiting")


def live_system_kpis(ev: Events, net: Network) -> DataFrame:
    """O-M16: exactly one row. Riding counts trains that are placed on the map."""
    trains = live_train_positions(ev, net).agg(
        F.coalesce(F.sum("passenger_count"), F.lit(0)).cast("long").alias("riding"),
        F.coalesce(F.avg("utilization_pct"), F.lit(0)).alias("avg_util"),
        F.count("train_id").cast("long").alias("active_trains"))
    stations = live_station_crowding(ev, net).agg(
        F.coalesce(F.sum("passengers_waiting"), F.lit(0)).cast("long").alias("waiting"))
    return trains.withColumn("waiting", stations.scalar()).select(
        (F.col("riding") + F.col("waiting")).alias("total_passengers_in_system"),
        F.col("riding").alias("total_passengers_riding"),
        F.col("waiting").alias("total_passengers_waiting"),
        F.round(F.col("avg_util").cast("decimal(20,6)"), 1).cast("decimal(18,1)")
        .alias("avg_network_utilization_pct"),
        "active_trains")


def live_wait_times(ev: Events) -> DataFrame:
    """O-M18: three rows Max, Avg, Min; zeros when nobody has waited."""
    waits = passengers_wait_times(ev)
    stats = waits.agg(
        F.coalesce(F.max("wait_time_ticks"), F.lit(0)).alias("max_wait"),
        F.coalesce(F.round(F.avg(F.col("wait_time_ticks").cast("decimal(20,0)")), 1), F.lit(0)).alias("avg_wait"),
        F.coalesce(F.min("wait_time_ticks"), F.lit(0)).alias("min_wait"))
    return unpivot_row(stats, [("Max", "max_wait"), ("Avg", "avg_wait"), ("Min", "min_wait")],
                       "metric", "wait_time", value_type="decimal(18,1)")


def track_extents(net: Network) -> DataFrame:
    """O-M19: start and end km per route."""
    return route_topology_mart(net).groupBy("route_id").agg(
        F.min("distance_from_start_km").alias("start_km"), F.max("distance_from_start_km").alias("end_km"))


def corridor_offsets(edges: DataFrame, route: str = "route_id", order: str = "stop_sequence",
                     start: str = "station_name", end: str = "next_station_name",
                     coords: DataFrame | None = None, spacing: float = 12.0) -> DataFrame:
    """O-M20: parallel drawing offsets for routes sharing an undirected corridor.

    Each (corridor, route) is drawn once, in the direction of its first edge
    by (route, order). Within a corridor, routes in order of first appearance
    get offsets 0, +s, -s, +2s, -2s, ... along the edge normal. Zero-length
    edges keep their slot but are not drawn.
    """
    e = edges.withColumn("corridor", fx.pair_key(start, end))
    first = e.groupBy("corridor", route).agg(F.min(F.struct(order, start, end)).alias("_f"))
    first = first.select("corridor", route, F.col(f"_f.{order}").alias(order),
                         F.col(f"_f.{start}").alias(start), F.col(f"_f.{end}").alias(end))
    from pyspark.sql import Window
    slot = F.row_number().over(Window.partitionBy("corridor").orderBy(route, order)) - 1
    first = first.withColumn("offset_index", slot.cast("int"))
    if coords is not None:
        a = coords.select(F.col("name").alias(start), F.col("x").alias("x1"), F.col("y").alias("y1"))
        b = coords.select(F.col("name").alias(end), F.col("x").alias("x2"), F.col("y").alias("y2"))
        first = first.join(a, start, "inner").join(b, end, "inner")
    mag = F.when(F.col("offset_index") == 0, F.lit(0.0)).otherwise(
        F.when(F.col("offset_index") % 2 == 1, F.lit(spacing)).otherwise(F.lit(-spacing))
        * F.floor((F.col("offset_index") + 1) / 2))
    dx = F.col("x2") - F.col("x1")
    dy = F.col("y2") - F.col("y1")
    length = F.hypot(dx, dy)
    nx, ny = -dy / length, dx / length
    drawn = first.where(length > 0)
    return drawn.select(
        route, start, end, "corridor", "offset_index",
        (F.col("x1") + nx * mag).alias("x1"), (F.col("y1") + ny * mag).alias("y1"),
        (F.col("x2") + nx * mag).alias("x2"), (F.col("y2") + ny * mag).alias("y2"))


def map_edge_geometry(net: Network) -> DataFrame:
    """O-M20 on the network map: coordinates are the stations' map positions."""
    edges = _edges_in_order(net)
    coords = net.stations.select(F.col("station_name").alias("name"), F.col("map_x").cast("double").alias("x"),
                                 F.col("map_y").cast("double").alias("y")).distinct()
    return corridor_offsets(edges, coords=coords)


def clipped_positions(ev: Events, net: Network) -> DataFrame:
    """O-M21: live positions clipped to the longest track end."""
    pos = live_train_positions(ev, net)
    bound = track_extents(net).select(F.max("end_km")).scalar()
    return pos.withColumn("distance_from_start_km", fx.clip_upper(F.col("distance_from_start_km").cast("double"),
                                                                  bound))


ALL_PRODUCTS = {
    "clock_current": lambda ev, net: clock_current(ev),
    "trains_recent_state": lambda ev, net: trains_recent_state(ev),
    "segments_recent_state": lambda ev, net: segments_recent_state(ev),
    "station_passengers_recent_stats": station_passengers_recent_stats,
    "passengers_recent_state": lambda ev, net: passengers_recent_state(ev),
    "passengers_wait_times": lambda ev, net: passengers_wait_times(ev),
    "route_topology": lambda ev, net: route_topology(net),
    "trains_linear_positions": trains_linear_positions,
    "train_spacing": train_spacing,
    "trains_recent_utilization": trains_recent_utilization,
    "world_clock": lambda ev, net: world_clock_mart(ev),
    "live_train_positions": live_train_positions,
    "route_topology_mart": lambda ev, net: route_topology_mart(net),
    "system_topology_edges": lambda ev, net: system_topology_edges(net),
    "live_headways": live_headways,
    "live_system_kpis": live_system_kpis,
    "live_station_crowding": live_station_crowding,
    "live_wait_times": lambda ev, net: live_wait_times(ev),
    "track_extents": lambda ev, net: track_extents(net),
    "map_edge_geometry": lambda ev, net: map_edge_geometry(net),
    "clipped_positions": clipped_positions,
}
