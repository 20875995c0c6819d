"""Build the ``Network`` and staged ``Events`` from a folder of seed CSVs,
optionally unioned with live landing tables."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from tramline.plans.transit import Events, Network, stage_events, stage_network
from tramline.schemas import (PASSENGER_ITINERARY, PASSENGER_ROUTES, PASSENGER_STATE, PLATFORM_STATE, RAIL_SEGMENTS, ROUTES,
                              SEGMENT_STATE, STATION_STATS, STATIONS, TRAIN_STATE, TRAINS, TRAINS_PRESENT_DDL,
                              WORLD_CLOCK)
from tramline.sources.landing import path_exists
from tramline.sources.seeds import read_seed


def empty_events(spark: SparkSession) -> Events:
    e = lambda s: spark.createDataFrame([], s)
    return Events(e(WORLD_CLOCK), e(TRAIN_STATE), e(PASSENGER_STATE), e(SEGMENT_STATE), e(PLATFORM_STATE),
                  e(STATION_STATS))


def load_seed_folder(spark: SparkSession, folder: str, live: Events | None = None) -> tuple[Network, Events]:
    p = lambda n: os.path.join(folder, f"{n}.csv")
    net = Network(
        stations=read_seed(spark, p("stations"), STATIONS),
        routes=read_seed(spark, p("routes"), ROUTES),
        trains=read_seed(spark, p("trains"), TRAINS),
        rail_segments=read_seed(spark, p("rail_segments"), RAIL_SEGMENTS),
        passenger_routes=read_seed(spark, p("passenger_routes"), PASSENGER_ROUTES)
        if path_exists(spark, p("passenger_routes")) else None,
        passenger_itinerary=read_seed(spark, p("passenger_itinerary"), PASSENGER_ITINERARY)
        if path_exists(spark, p("passenger_itinerary")) else None,
    )
    seed = Events(
        world_clock=read_seed(spark, p("world_clock_state"), WORLD_CLOCK),
        train_state=read_seed(spark, p("train_state"), TRAIN_STATE, array_cols=["stops_seen_so_far"]),
        passenger_state=read_seed(spark, p("passenger_state"), PASSENGER_STATE, array_cols=["stops_seen_so_far"]),
        rail_segment_state=read_seed(spark, p("rail_segment_state"), SEGMENT_STATE,
                                     json_cols={"trains_present": TRAINS_PRESENT_DDL}),
        platform_state=read_seed(spark, p("platform_state"), PLATFORM_STATE),
        station_stats=None,
    )
    return stage_network(net), stage_events(seed, live or empty_events(spark))
