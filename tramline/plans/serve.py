"""The read edge (O-S10): marts with explicit columns, converted for a client.

``fetch`` is the only place a result leaves Spark; it is meant for the small,
already-aggregated marts (a few rows per route, station or train).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

# The column lists the dashboard reads from each mart.
MART_COLUMNS = {
    "world_clock": ["clock_tick", "year", "hour_of_day", "minute", "day_name", "month_name", "day_of_month"],
    "live_station_crowding": ["station_id", "station_name", "total_passengers_in_station", "passengers_waiting"],
    "live_train_positions": ["train_id", "route_id", "status", "passenger_count", "utilization_pct",
                             "distance_from_start_km"],
    "live_headways": ["train_id", "route_id", "train_ahead_id", "gap_km", "spacing_health"],
    "live_system_kpis": ["total_passengers_in_system", "total_passengers_riding", "total_passengers_waiting",
                         "avg_network_utilization_pct", "active_trains"],
    "route_topology_mart": ["route_id", "stop_sequence", "station_name", "segment_km", "distance_from_start_km"],
    "system_topology_edges": ["route_id", "station_name", "map_x", "map_y", "next_station_name"],
    "live_wait_times": ["metric", "wait_time"],
}

MART_ORDER = {
    "live_station_crowding": ["total_passengers_in_station"],
    "live_train_positions": ["route_id", "train_id"],
    "route_topology_mart": ["route_id", "stop_sequence"],
}
#: Rows a client gets at most; marts have a row per route, station or train.
FETCH_ROWS = 1_000_000


def shape(mart: str, df: DataFrame) -> DataFrame:
    """Project the mart to its client columns and presentation order."""
    out = df.select(*MART_COLUMNS[mart])
    order: Sequence[str] = MART_ORDER.get(mart, [])
    if mart == "live_station_crowding":
        return out.orderBy(out["total_passengers_in_station"].desc())
    return out.orderBy(*order) if order else out


def fetch(mart: str, df: DataFrame):
    """pandas frame of a shaped mart (Arrow transfer); a mart of more than ``FETCH_ROWS`` rows is an error."""
    got = shape(mart, df).limit(FETCH_ROWS + 1).toPandas()
    if len(got) > FETCH_ROWS:
        raise ValueError(f"{mart} has more than {FETCH_ROWS} rows; write it to a table instead")
    return got


def axis_max(column: str, fallback: float):
    """Aggregate: the column maximum, or ``fallback`` when it is missing or 0."""
    from pyspark.sql import functions as F
    return F.coalesce(F.nullif(F.max(column), F.lit(0)), F.lit(fallback))


def padded_axis(column: str, floor: float, factor: float):
    """Aggregate: ``max(floor, factor * max(column))`` (``floor`` when empty)."""
    from pyspark.sql import functions as F
    return F.greatest(F.lit(floor), F.max(column) * F.lit(factor))
