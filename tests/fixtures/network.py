"""The shipped network and its tick-1 state, as CSV seed text.

Fixed values: these rows are the reference network's seed tables (4
stations, 6 segments, 3 routes of 5 stops, 11 trains, 9 platforms, the tick-1
clock, train and segment states). They must stay equal for the goldens in
FIXTURES.md to hold. The 2,370 passenger seed rows all share one shape (tick
1, no location, empty history) and are generated from that rule.
"""

from __future__ import annotations

import os

# Seed tables of the shipped network.
STATIONS_CSV = """station_id,station_name,map_x,map_y
1,North Park,100,150
2,Downtown Central,350,230
3,University,600,200
4,High Point,360,270
"""

RAIL_SEGMENTS_CSV = """segment_id,from_station_id,to_station_id,distance_km,speed
12,1,2,7.3,0.2
21,2,1,7.3,0.2
23,2,3,4.0,0.1
24,2,4,1.3,0.3
32,3,2,4.0,0.1
42,4,2,1.3,0.3
"""

ROUTES_CSV = """route_id,stop_sequence,station_id
1,0,1
1,1,2
1,2,3
1,3,2
1,4,1
2,0,3
2,1,2
2,2,1
2,3,2
2,4,3
3,0,4
3,1,2
3,2,1
3,3,2
3,4,4
"""

TRAINS_CSV = """train_id,route_id,ordering,capacity
101,1,1,10
102,1,2,10
103,1,3,5
104,1,4,10
201,2,1,10
202,2,2,10
203,2,3,15
204,2,4,15
301,3,1,10
302,3,2,15
303,3,3,15
"""

PASSENGER_ROUTES_CSV = """route_id,stop_sequence,station_id
1,0,1
1,1,2
1,2,3
2,0,3
2,1,2
2,2,4
"""

PLATFORM_STATE_CSV = """station_id,clock_tick,route_id,platform_state
1,1,1,Empty
1,1,2,Empty
1,1,3,Empty
2,1,1,Empty
2,1,2,Empty
2,1,3,Empty
3,1,1,Empty
3,1,2,Empty
4,1,3,Empty
"""

WORLD_CLOCK_CSV = """clock_tick,year,day_of_year,day_of_week,hour_of_day,minute
1,2026,54,M,8,0
"""

TRAIN_STATE_CSV = """clock_tick,train_id,segment_id,station_id,stops_seen_so_far,passenger_count
1,101,32,,"{1,2,3}",0
1,102,32,,"{1,2,3}",0
1,103,21,,"{1,2,3,2}",0
1,104,21,,"{1,2,3,2}",0
1,201,32,,{3},0
1,202,21,,"{3,2}",0
1,203,21,,"{3,2}",0
1,204,12,,"{3,2,1}",0
1,301,21,,"{4,2}",0
1,302,12,,"{4,2,1}",0
1,303,12,,"{4,2,1}",0
"""

RAIL_SEGMENT_STATE_CSV = '''segment_id,clock_tick,trains_present
12,1,"[{""id"": 204, ""position_km"": 0.4}, {""id"": 302, ""position_km"": 3.03}, {""id"": 303, ""position_km"": 4.35}]"
21,1,"[{""id"": 103, ""position_km"": 4.46}, {""id"": 104, ""position_km"": 5.37}, {""id"": 202, ""position_km"": 4.67}, {""id"": 203, ""position_km"": 5.22}, {""id"": 301, ""position_km"": 2.59}]"
23,1,[]
24,1,[]
32,1,"[{""id"": 101, ""position_km"": 0.7}, {""id"": 102, ""position_km"": 2.56}, {""id"": 201, ""position_km"": 2.46}]"
42,1,[]
'''

PASSENGER_SEED_COUNT = 2370

# Our own fixture; the shipped seeds have no itinerary.
PASSENGER_ITINERARY_CSV = """id,passenger_route_id,start_arrival_hour,arrival_minute,travel_code
1,1,7,30,M
1,2,17,30,M
2,2,8,0,M
3,1,9,15,S
"""


def passenger_state_csv() -> str:
    rows = ["clock_tick,passenger_id,train_id,station_id,stops_seen_so_far"]
    rows += [f"1,{i},,,{{}}" for i in range(1, PASSENGER_SEED_COUNT + 1)]
    return "\n".join(rows) + "\n"


SEEDS = {
    "stations": STATIONS_CSV,
    "rail_segments": RAIL_SEGMENTS_CSV,
    "routes": ROUTES_CSV,
    "trains": TRAINS_CSV,
    "passenger_routes": PASSENGER_ROUTES_CSV,
    "platform_state": PLATFORM_STATE_CSV,
    "world_clock_state": WORLD_CLOCK_CSV,
    "train_state": TRAIN_STATE_CSV,
    "rail_segment_state": RAIL_SEGMENT_STATE_CSV,
    "passenger_itinerary": PASSENGER_ITINERARY_CSV,
}


def write_seeds(folder: str) -> dict[str, str]:
    """Write every seed as ``<folder>/<name>.csv``; return name -> path."""
    os.makedirs(folder, exist_ok=True)
    paths = {}
    for name, text in {**SEEDS, "passenger_state": passenger_state_csv()}.items():
        p = os.path.join(folder, f"{name}.csv")
        with open(p, "w", encoding="utf-8") as fh:
            fh.write(text)
        paths[name] = p
    return paths
