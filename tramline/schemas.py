"""Declared schemas, natural keys and the topic -> table routing.

Static network tables are small dimension tables whose size is fixed by the
network configuration (stations, routes, trains, segments), not by the event
volume; the plans broadcast them. Event tables grow with time and fleet size
and are never broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

I = T.IntegerType()
S = T.StringType()
D = T.DoubleType()
TS = T.TimestampType()
INT_ARRAY = T.ArrayType(I)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# The column names and types of all tables below.

# ---- static network tables ------------------------------------------------

STATIONS = _struct(("station_id", I), ("station_name", S), ("map_x", I), ("map_y", I))
ROUTES = _struct(("route_id", I), ("stop_sequence", I), ("station_id", I))
TRAINS = _struct(("train_id", I), ("route_id", I), ("ordering", I), ("capacity", I))
RAIL_SEGMENTS = _struct(("segment_id", I), ("from_station_id", I), ("to_station_id", I),
                        ("distance_km", D), ("speed", D))
PASSENGER_ROUTES = _struct(("route_id", I), ("stop_sequence", I), ("station_id", I))
PASSENGER_ITINERARY = _struct(("id", I), ("passenger_route_id", I), ("start_arrival_hour", I),
                              ("arrival_minute", I), ("travel_code", S))

# ---- event tables (one row per tick and entity) -----------------------------

TRAIN_POSITION = _struct(("id", I), ("position_km", D))
TRAINS_PRESENT_DDL = "array<struct<id:int,position_km:double>>"

WORLD_CLOCK = _struct(("clock_tick", I), ("year", I), ("day_of_year", I), ("day_of_week", S),
                      ("hour_of_day", I), ("minute", I), ("created_at", TS))
TRAIN_STATE = _struct(("clock_tick", I), ("train_id", I), ("segment_id", I), ("station_id", I),
                      ("stops_seen_so_far", INT_ARRAY), ("passenger_count", I), ("created_at", TS))
PASSENGER_STATE = _struct(("clock_tick", I), ("passenger_id", I), ("train_id", I), ("station_id", I),
                          ("stops_seen_so_far", INT_ARRAY), ("created_at", TS))
SEGMENT_STATE = _struct(("clock_tick", I), ("segment_id", I),
                        ("trains_present", T.ArrayType(TRAIN_POSITION)), ("created_at", TS))
PLATFORM_STATE = _struct(("clock_tick", I), ("station_id", I), ("route_id", I),
                         ("platform_state", S), ("created_at", TS))
STATION_STATS = _struct(("station_id", I), ("clock_tick", I), ("total_passengers_in_station", I),
                        ("passengers_boarded_trains", I), ("passengers_entered_station", I),
                        ("passengers_waiting", I), ("trains_at_platform", I), ("created_at", TS))


@dataclass(frozen=True)
class EventTable:
    """A landing table: schema, natural key and the topic feeding it."""

    name: str
    topic: str
    schema: T.StructType
    keys: tuple[str, ...]

    @property
    def payload(self) -> list[str]:
        return [f.name for f in self.schema.fields if f.name not in self.keys and f.name != "created_at"]


# Topic names and natural keys of the six landing tables.
EVENT_TABLES: dict[str, EventTable] = {
    t.name: t
    for t in (
        EventTable("world_clock_state", "world_clock", WORLD_CLOCK, ("clock_tick",)),
        EventTable("train_state", "train_status", TRAIN_STATE, ("clock_tick", "train_id")),
        EventTable("passenger_state", "passenger_status", PASSENGER_STATE, ("clock_tick", "passenger_id")),
        EventTable("rail_segment_state", "rail_segments", SEGMENT_STATE, ("clock_tick", "segment_id")),
        EventTable("platform_state", "platform_status", PLATFORM_STATE, ("clock_tick", "station_id", "route_id")),
        EventTable("station_passenger_stats", "station_status", STATION_STATS, ("clock_tick", "station_id")),
    )
}

TOPIC_TO_TABLE = {t.topic: t for t in EVENT_TABLES.values()}

# Platform states in their cycle order, and weekday codes Monday..Sunday.
PLATFORM_STATES = ["Empty", "Arrival", "MovingPassengers", "Departure"]
WEEKDAY_CODES = ["M", "T", "W", "R", "F", "S", "U"]
