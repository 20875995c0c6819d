"""The transit products and integrity checks run over the supplied tables.

One adapter reads whole tables as a network and its event logs: nations are
stations (a route is the nations with the same remainder by five), suppliers
are trains, customers hold itineraries, and the events table is the state log
of trains, passengers, platforms, segments and stations, a tick being six
hours. The functions registered here are the products and checks themselves;
``GIVEN`` is the same adapter as SQL, and each entry's SQL states the product
over it. The mapping leaves faults in on purpose (a route without stops, an
edge without return, odd codes), so that every check has something to find.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.plans import integrity, transit
from tramline.plans.catalog import register, us
from tramline.plans.exact import sql_pct_half_up
from tramline.plans.transit import Events, Network, stage_events, stage_network
from tramline.schemas import PLATFORM_STATES, WEEKDAY_CODES
from tramline.sources.tables import Tables

# Fixed values of the adapter.
TICK_US = 21_600_000_000  # six hours
EPOCH_US = 1_704_067_200_000_000  # 2024-01-01
DAYS = [*WEEKDAY_CODES, "X"]
STATES = [*PLATFORM_STATES, "Broken"]


def _pick(values: list[str], index):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def network(spark: SparkSession, d: str) -> Network:
    t = Tables(spark, d)
    k = F.col("n_nationkey")
    stations = t.nation.select(k.alias("station_id"), F.col("n_name").alias("station_name"),
                               (k * 7 % 100).alias("map_x"), (k * 13 % 100).alias("map_y"))
    routes = t.nation.select((k % 5).alias("route_id"), F.floor(k / 5).alias("stop_sequence"), k.alias("station_id"))
    s = F.col("s_suppkey")
    trains = t.supplier.select(s.alias("train_id"), (s % 6).alias("route_id"), s.alias("ordering"),
                               F.when(s % 17 == 0, 0).otherwise(40 + s % 50).alias("capacity"))
    ends = t.nation.select(k.alias("a"), F.explode(F.array(k + 5, k - 5)).alias("b")).where("b between 0 and 24 and not (a = 20 and b = 15)")
    segments = ends.select((F.col("a") * 100 + F.col("b")).alias("segment_id"), F.col("a").alias("from_station_id"),
                           F.col("b").alias("to_station_id"), (F.least("a", "b") % 7 + 1.5).alias("distance_km"), F.lit(1.0).alias("speed"))
    c = F.col("c_custkey")
    itinerary = t.customer.select(c.alias("id"), (F.col("c_nationkey") % 6).alias("passenger_route_id"),
                                  (c % 24).alias("start_arrival_hour"), (c % 60).alias("arrival_minute"),
                                  _pick(DAYS, c % 8).alias("travel_code"))
    return stage_network(Network(stations, routes, trains, segments, routes, itinerary))


def _ticks(spark: SparkSession, d: str) -> DataFrame:
    e = Tables(spark, d).events.select("event_id", "user_id", "event_type", ((us("ts") - EPOCH_US) / TICK_US).alias("x"))
    return e.select("event_id", "user_id", "event_type", F.floor("x").cast("int").alias("clock_tick"))


def events(spark: SparkSession, d: str) -> Events:
    e = _ticks(spark, d)
    tick, eid, user = F.col("clock_tick"), F.col("event_id"), F.col("user_id")
    clock = e.select("clock_tick").distinct().select(
        "clock_tick", F.lit(2024).alias("year"), (1 + F.floor(tick / 4)).alias("day_of_year"),
        _pick(WEEKDAY_CODES, F.floor(tick / 4) % 7).alias("day_of_week"), (tick % 4 * 6).alias("hour_of_day"), F.lit(0).alias("minute"))
    last = e.groupBy("clock_tick", "user_id").agg(F.max(F.struct("event_id", "event_type")).alias("e")).select(
        "clock_tick", "user_id", "e.event_id", "e.event_type")
    kind = F.col("event_type")
    off = F.when(eid % 31 == 0, 1).otherwise(0)
    seen = F.slice(F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: (user % 6 + 5 * i + off) % 25), 1, (eid % 6).cast("int"))
    segment = F.when(kind == "view", eid % 20 * 100 + eid % 20 + 5)
    station = F.when(kind.isin("purchase", "signup"), eid % 25)
    train = last.select("clock_tick", user.alias("train_id"), segment.alias("segment_id"), station.alias("station_id"),
                        seen.alias("stops_seen_so_far"), (eid % 60).alias("passenger_count"))
    passenger = last.select("clock_tick", user.alias("passenger_id"), F.when(kind == "purchase", user % 100 + 1).alias("train_id"),
                            F.when(kind.isin("view", "click"), eid % 25).alias("station_id"), seen.alias("stops_seen_so_far"))
    on = train.where("segment_id is not null").groupBy("clock_tick", "segment_id").agg(F.array_sort(F.collect_list(F.struct(
        F.col("train_id").cast("int").alias("id"), (F.col("train_id") % 3 + 0.25).cast("double").alias("position_km")))).alias("trains_present"))
    # an empty list at each tick that is a multiple of five, for a segment that is not used
    idle = e.where("clock_tick % 5 = 0").select("clock_tick").distinct().select("clock_tick", F.lit(2015).alias("segment_id"), F.array().cast(
        "array<struct<id:int,position_km:double>>").alias("trains_present"))
    place = e.groupBy("clock_tick", (eid % 25).alias("station_id"))
    platform = place.agg(F.max("event_id").alias("m")).select(
        "clock_tick", "station_id", F.when(F.col("m") % 41 == 0, 9).otherwise(F.col("station_id") % 5).alias("route_id"),
        _pick(STATES, F.when(F.col("m") % 97 == 0, 4).otherwise(F.col("m") % 4)).alias("platform_state"))

    def number(name: str):
        return F.sum((kind == name).cast("int"))

    stats = place.agg(F.count("*").alias("total_passengers_in_station"), number("purchase").alias("passengers_boarded_trains"),
                      number("view").alias("passengers_entered_station"), number("click").alias("passengers_waiting"))
    return stage_events(None, Events(clock, train, passenger, on.unionByName(idle), platform, stats))


def _codes(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


GIVEN = f"""
with e as (
  select event_id, user_id, event_type, cast((epoch_us(ts) - {EPOCH_US}) // {TICK_US} as integer) as clock_tick from events
), stations as (
  select cast(n_nationkey as integer) as station_id, n_name as station_name, cast(n_nationkey * 7 % 100 as integer) as map_x,
         cast(n_nationkey * 13 % 100 as integer) as map_y from nation
), routes as (
  select cast(n_nationkey % 5 as integer) as route_id, cast(n_nationkey // 5 as integer) as stop_sequence,
         cast(n_nationkey as integer) as station_id from nation
), trains as (
  select cast(s_suppkey as integer) as train_id, cast(s_suppkey % 6 as integer) as route_id,
         cast(case when s_suppkey % 17 = 0 then 0 else 40 + s_suppkey % 50 end as integer) as capacity from supplier
), segments as (
  select a * 100 + b as segment_id, a as from_station_id, b as to_station_id, cast(least(a, b) % 7 + 1.5 as double) as distance_km
  from (select cast(x.n_nationkey as integer) as a, cast(y.n_nationkey as integer) as b from nation x join nation y
        on abs(x.n_nationkey - y.n_nationkey) = 5) where not (a = 20 and b = 15)
), itinerary as (
  select cast(c_custkey as integer) as id, cast(c_nationkey % 6 as integer) as passenger_route_id, c_custkey % 24 as start_arrival_hour,
         c_custkey % 60 as arrival_minute, {_codes(DAYS)}[cast(c_custkey % 8 + 1 as integer)] as travel_code from customer
), clock as (
  select clock_tick, 2024 as year, 1 + clock_tick // 4 as day_of_year, {_codes(WEEKDAY_CODES)}[clock_tick // 4 % 7 + 1] as day_of_week,
         clock_tick % 4 * 6 as hour_of_day, 0 as minute from (select distinct clock_tick from e)
), now as (select max(clock_tick) as t from clock
), last as (
  select *, list_transform(range(0, event_id % 6), lambda i: cast((user_id % 6 + 5 * i + (case when event_id % 31 = 0 then 1 else 0 end)) % 25
         as integer)) as seen
  from (select *, row_number() over (partition by clock_tick, user_id order by event_id desc) as rn from e) where rn = 1
), train_state as (
  select clock_tick, cast(user_id as integer) as train_id,
         cast(case when event_type = 'view' then event_id % 20 * 100 + event_id % 20 + 5 end as integer) as segment_id,
         cast(case when event_type in ('purchase', 'signup') then event_id % 25 end as integer) as station_id, seen,
         cast(event_id % 60 as integer) as passenger_count from last
), passenger_state as (
  select clock_tick, cast(user_id as integer) as passenger_id,
         cast(case when event_type = 'purchase' then user_id % 100 + 1 end as integer) as train_id,
         cast(case when event_type in ('view', 'click') then event_id % 25 end as integer) as station_id, seen from last
), segment_rows as (
  select clock_tick, segment_id, train_id as id, cast(train_id % 3 + 0.25 as double) as position_km from train_state
  where segment_id is not null
  union all select distinct clock_tick, 2015, null, null from e where clock_tick % 5 = 0
), platform_state as (
  select clock_tick, station_id, case when m % 41 = 0 then 9 else station_id % 5 end as route_id,
         {_codes(STATES)}[cast((case when m % 97 = 0 then 4 else m % 4 end) + 1 as integer)] as platform_state
  from (select clock_tick, cast(event_id % 25 as integer) as station_id, max(event_id) as m from e group by 1, 2)
), station_stats as (
  select clock_tick, cast(event_id % 25 as integer) as station_id, cast(count(*) as integer) as total_passengers_in_station,
         cast(count(*) filter (event_type = 'purchase') as integer) as passengers_boarded_trains,
         cast(count(*) filter (event_type = 'view') as integer) as passengers_entered_station,
         cast(count(*) filter (event_type = 'click') as integer) as passengers_waiting from e group by 1, 2
), topo as (
  select route_id, stop_sequence, station_id, station_name, map_x, map_y, segment_km,
         sum(segment_km) over (partition by route_id order by stop_sequence) as distance_from_start_km
  from (select r.*, s.station_name, s.map_x, s.map_y, coalesce(g.distance_km, 0) as segment_km
        from (select *, lag(station_id) over (partition by route_id order by stop_sequence) as prev from routes) r
        join stations s using (station_id)
        left join segments g on g.from_station_id = r.prev and g.to_station_id = r.station_id)
), train_now as (
  select train_id, station_id, segment_id, seen, passenger_count,
         case when segment_id is not null and station_id is null then 'MOVING'
              when segment_id is null and station_id is not null then 'IN_STATION' else 'UNKNOWN' end as status,
         cast(greatest(len(seen) - 1, 0) as integer) as stop_index
  from (select *, row_number() over (partition by train_id order by clock_tick desc) as rn from train_state, now
        where clock_tick >= t - 5) where rn = 1
), segment_now as (
  select segment_id, id as train_id, position_km as train_position, clock_tick as last_updated_tick
  from (select *, max(clock_tick) over (partition by segment_id) as last_tick from segment_rows, now where clock_tick >= t - 5)
  where clock_tick = last_tick
), station_now as (
  select x.station_id, s.station_name, total_passengers_in_station, passengers_boarded_trains, passengers_entered_station, passengers_waiting
  from (select *, row_number() over (partition by station_id order by clock_tick desc) as rn from station_stats, now where clock_tick >= t - 5) x
  left join stations s on s.station_id = x.station_id where rn = 1
), waits as (
  select passenger_id, clock_tick - prev_tick as wait_time_ticks
  from (select *, lag(clock_tick) over w as prev_tick, lag(train_id) over w as prev_train from passenger_state
        where station_id is not null or train_id is not null window w as (partition by passenger_id order by clock_tick))
  where train_id is not null and prev_train is null and prev_tick is not null
), positions as (
  select n.train_id, t.route_id, status, passenger_count,
         o.distance_from_start_km + coalesce(g.train_position, 0) as distance_from_start_km
  from train_now n join trains t using (train_id) join topo o on o.route_id = t.route_id and o.stop_sequence = n.stop_index
  left join segment_now g on g.segment_id = n.segment_id and g.train_id = n.train_id
), utilization as (
  select n.train_id, n.passenger_count, t.capacity,
         {sql_pct_half_up("n.passenger_count", "t.capacity")} as utilization_pct
  from train_now n left join trains t using (train_id)
), spacing as (
  select p.train_id, p.route_id, p.distance_from_start_km,
         coalesce(lead(train_id) over w, first_value(train_id) over w) as train_ahead_id,
         coalesce(lead(distance_from_start_km) over w - distance_from_start_km,
                  l.total_route_km - distance_from_start_km + first_value(distance_from_start_km) over w) as gap_to_next_train_km
  from positions p join (select route_id, max(distance_from_start_km) as total_route_km from topo group by 1) l using (route_id)
  window w as (partition by p.route_id order by distance_from_start_km, train_id)
), train_snap as (
  select * from (select *, row_number() over (partition by train_id order by clock_tick desc) as rn from train_state) where rn = 1
), passenger_snap as (
  select * from (select *, row_number() over (partition by passenger_id order by clock_tick desc) as rn from passenger_state) where rn = 1
), plans as (
  select id as passenger_id, passenger_route_id as route from itinerary, (select day_of_week, hour_of_day * 60 + minute as m
    from clock, now where clock_tick = t) c
  where travel_code = c.day_of_week and start_arrival_hour * 60 + arrival_minute <= c.m
), pairs as (
  select route_id as route, station_id as from_station, lead(station_id) over (partition by route_id order by stop_sequence) as to_station from routes
)
"""


def product(name: str, operators: tuple[str, ...], sql: str, finish=lambda df: df):
    """Register a product function of ``transit`` over the supplied tables."""
    def query(spark: SparkSession, d: str) -> DataFrame:
        return finish(transit.ALL_PRODUCTS[name](events(spark, d), network(spark, d)))

    register(f"product_{name}", operators, GIVEN + sql)(query)


def _text(column: str):
    return lambda df: df.withColumn(column, F.concat_ws(",", F.transform(column, lambda x: x.cast("string"))))


product("clock_current", ("O-M1", "O-P12"), "select clock_tick, year, day_of_year, day_of_week, hour_of_day, minute from clock, now where clock_tick = t")
product("trains_recent_state", ("O-M2", "O-P7"), """select train_id, station_id, segment_id, array_to_string(seen, ',') as stops_seen_so_far,
  passenger_count, status, stop_index as recent_stop_sequence from train_now""", _text("stops_seen_so_far"))
product("segments_recent_state", ("O-M3",), "select * from segment_now")
product("station_passengers_recent_stats", ("O-M4", "O-P1"), "select * from station_now")
product("passengers_recent_state", ("O-M5", "O-P10"), "select clock_tick, passenger_id, train_id, station_id from passenger_state, now where clock_tick >= t - 100")
product("passengers_wait_times", ("O-M6",), "select * from waits")
product("route_topology", ("O-M7", "O-P2"), """select route_id, stop_sequence, station_name, map_x, map_y, segment_km, distance_from_start_km,
  max(distance_from_start_km) over () as max_system_length_km from topo""")
product("trains_linear_positions", ("O-M8", "O-P3"), "select * from positions")
product("train_spacing", ("O-M9",), "select * from spacing")
product("trains_recent_utilization", ("O-M10", "O-X3"), "select * from utilization")
product("world_clock", ("O-M11",), """select clock_tick, year, hour_of_day, minute, dayname(d) as day_name, monthname(d) as month_name,
  cast(day(d) as integer) as day_of_month from (select *, make_date(year, 1, 1) + (day_of_year - 1) as d from clock, now where clock_tick = t)""")
product("live_train_positions", ("O-M12",), """select p.train_id, route_id, status, p.passenger_count, utilization_pct, distance_from_start_km
  from positions p left join utilization u on u.train_id = p.train_id""")
product("route_topology_mart", ("O-M13", "O-O1"), "select route_id, stop_sequence, station_name, segment_km, distance_from_start_km from topo")
product("system_topology_edges", ("O-M14",), """select * from (select route_id, station_name, map_x, map_y,
  lead(station_name) over (partition by route_id order by stop_sequence) as next_station_name from topo) where next_station_name is not null""")
product("live_headways", ("O-M15",), f"""select train_id, route_id, train_ahead_id,
  cast(round(cast(gap_to_next_train_km as decimal(20,10)), 2) as decimal(18,2)) as gap_km,
  case {' '.join(f"when gap_to_next_train_km < {limit} then '{label}'" for limit, label in transit.HEALTH_BANDS)}
       else '{transit.HEALTH_DEFAULT}' end as spacing_health from spacing""")
product("live_system_kpis", ("O-M16",), """select riding + waiting as total_passengers_in_system, riding as total_passengers_riding,
  waiting as total_passengers_waiting, avg_util as avg_network_utilization_pct, active_trains
  from (select cast(coalesce(sum(p.passenger_count), 0) as bigint) as riding, count(*) as active_trains,
          cast(coalesce((2 * sum(cast(utilization_pct * 10 as bigint)) + count(utilization_pct)) // nullif(2 * count(utilization_pct), 0), 0)
               * 0.1 as decimal(18,1)) as avg_util
        from positions p left join utilization u on u.train_id = p.train_id),
       (select cast(coalesce(sum(passengers_waiting), 0) as bigint) as waiting from station_now)""")
product("live_station_crowding", ("O-M17",), "select station_id, station_name, total_passengers_in_station, passengers_waiting from station_now")
product("live_wait_times", ("O-M18",), """select m.metric, cast(case m.metric when 'Max' then hi when 'Min' then lo else av end as decimal(18,1)) as wait_time
  from (select coalesce(max(wait_time_ticks), 0) as hi, coalesce(min(wait_time_ticks), 0) as lo,
          coalesce((20 * sum(wait_time_ticks) + count(*)) // nullif(2 * count(*), 0), 0) * 0.1 as av from waits),
       (values ('Max'), ('Avg'), ('Min')) m(metric)""")
product("track_extents", ("O-M19",), "select route_id, min(distance_from_start_km) as start_km, max(distance_from_start_km) as end_km from topo group by 1")
product("clipped_positions", ("O-M21",), """select p.train_id, route_id, status, p.passenger_count, utilization_pct,
  least(distance_from_start_km, (select max(distance_from_start_km) from topo)) as distance_from_start_km
  from positions p left join utilization u on u.train_id = p.train_id""")
product("map_edge_geometry", ("O-M20",), """select route_id, station_name, next_station_name, 0 as offset_index,
  cast(x1 as double) as x1, cast(y1 as double) as y1, cast(x2 as double) as x2, cast(y2 as double) as y2
  from (select route_id, station_name, map_x as x1, map_y as y1, lead(station_name) over w as next_station_name, lead(map_x) over w as x2,
          lead(map_y) over w as y2 from topo window w as (partition by route_id order by stop_sequence))
  where next_station_name is not null""", lambda df: df.drop("corridor"))


@register("product_staged_segments", ("O-P4",), GIVEN + """select segment_id, from_station_id, to_station_id,
  cast(round(distance_km) as integer) as distance_km, cast(1 as decimal(18,6)) as speed from segments""")
def staged_segments(spark: SparkSession, d: str) -> DataFrame:
    return transit.staged_segments(network(spark, d))


def check(name: str, operators: tuple[str, ...], sql: str):
    """Register a check of ``integrity`` over the supplied tables."""
    fn = getattr(integrity, name)

    def query(spark: SparkSession, d: str) -> DataFrame:
        have = {"net": lambda: network(spark, d), "ev": lambda: events(spark, d)}
        return fn(*[have[a]() for a in fn.__code__.co_varnames[:fn.__code__.co_argcount]])

    register(f"check_{name}", operators, GIVEN + sql)(query)


def _found(check_id: str, severity: str, table: str, column: str, entity: str, rest: str) -> str:
    return (f"select '{check_id}' as check_id, '{severity}' as severity, '{table}' as table_name, '{column}' as column_name, "
            f"cast({entity} as varchar) as entity {rest}")


def _history(snap: str, entity: str, plan: str, stops: str = "routes") -> str:
    """Entities whose history is not a prefix of their route."""
    return (f"from (select distinct x.{entity} from (select {entity}, route, unnest(seen) as station, "
            f"unnest(range(0, len(seen))) as seq from {snap} join ({plan}) p using ({entity})) x "
            f"left join {stops} r on r.route_id = x.route and r.stop_sequence = x.seq "
            f"where r.station_id is null or r.station_id <> x.station)")


_TRAIN_PLAN = "select train_id, route_id as route from trains"
_PASSENGER_PLAN = "select passenger_id, route from plans"
_AT_NOW = "(select * from {0}, now where clock_tick = t)"

check("q4_clock_present", ("O-Q4",), _found("clock_empty", "state", "world_clock", "", "'world_clock'", "from (select count(*) as n from clock) where n = 0"))
check("q5_itinerary_without_state", ("O-Q5", "O-P6"), _found("passenger_without_state", "state", "passenger_itinerary", "id", "id",
      "from (select distinct id from itinerary) where id not in (select passenger_id from passenger_snap)"))
check("q6_itinerary_codes", ("O-Q6", "O-P5"), _found("itinerary_unknown_route", "config", "passenger_itinerary", "passenger_route_id", "id",
      "from itinerary where passenger_route_id not in (select route_id from routes)") + " union all "
      + _found("itinerary_unknown_day", "config", "passenger_itinerary", "travel_code", "id", "from itinerary where travel_code = 'X'"))
check("q7_train_without_state", ("O-Q7",), _found("train_without_state", "state", "trains", "train_id", "train_id",
      f"from trains where train_id not in (select train_id from {_AT_NOW.format('train_state')})"))
check("q8_train_route_undefined", ("O-Q8",), _found("train_route_undefined", "config", "trains", "route_id", "train_id",
      "from trains where route_id not in (select route_id from routes)"))
check("q9_train_history", ("O-Q9",), _found("train_history_not_on_route", "state", "train_state", "stops_seen_so_far", "train_id",
      _history("train_snap", "train_id", _TRAIN_PLAN)))
check("q10_train_unlocated", ("O-Q10",), _found("train_unlocated", "state", "train_state", "station_id,segment_id", "train_id",
      "from train_snap where station_id is null and segment_id is null"))
check("q11_station_connectivity", ("O-Q11",), _found("station_no_incoming", "config", "stations", "station_id", "station_id",
      "from stations where station_id not in (select to_station_id from segments)") + " union all "
      + _found("station_no_outgoing", "config", "stations", "station_id", "station_id",
               "from stations where station_id not in (select from_station_id from segments)"))
check("q12_platforms", ("O-Q12", "O-P11"), _found("station_without_platform_state", "state", "stations", "station_id", "station_id",
      f"from stations where station_id not in (select station_id from {_AT_NOW.format('platform_state')})") + " union all "
      + _found("unknown_platform_state", "state", "platform_state", "platform_state", "station_id || ',' || route_id",
               f"from {_AT_NOW.format('platform_state')} where platform_state = 'Broken'"))
check("q13_passenger_history", ("O-Q13", "O-R3"), _found("passenger_history_not_on_route", "state", "passenger_state", "stops_seen_so_far", "passenger_id",
      _history("passenger_snap", "passenger_id", _PASSENGER_PLAN)))
check("q14_segment_lists", ("O-Q14",), _found(
    "segment_train_mismatch", "state", "rail_segment_state", "trains_present",
    "concat_ws(',', segment_id, train_id, case when a < b then 'missing_in_a' else 'missing_in_b' end)",
    """from (select segment_id, train_id, sum(a) as a, sum(b) as b from (
         select segment_id, id as train_id, 1 as a, 0 as b from (select *, max(clock_tick) over (partition by segment_id) as m from segment_rows)
         where clock_tick = m and id is not null
         union all select segment_id, train_id, 0, 1 from train_snap where segment_id is not null) group by 1, 2) where a <> b"""))
check("q15_train_station_defined", ("O-Q15",), _found("train_at_undefined_station", "config", "train_state", "station_id", "train_id",
      "from train_snap where station_id is not null and station_id not in (select station_id from stations)"))
check("q16_symmetric_segments", ("O-Q16",), _found("segment_without_return", "config", "rail_segments", "from_station_id,to_station_id",
      "from_station_id || ',' || to_station_id",
      "from segments a where not exists (select 1 from segments b where b.from_station_id = a.to_station_id and b.to_station_id = a.from_station_id)"))
check("q17_trains_on_route_segments", ("O-Q17",), _found("train_on_undefined_segment", "config", "train_state", "segment_id", "train_id",
      "from train_snap join trains using (train_id) where segment_id is not null and segment_id not in (select segment_id from segments)") + " union all "
      + _found("train_segment_not_on_route", "config", "train_state", "segment_id", "s.train_id",
               """from train_snap s join trains t using (train_id) join segments g using (segment_id)
                  where not exists (select 1 from (select * from pairs where to_station is not null union all
                    select route_id, max_by(station_id, stop_sequence), min_by(station_id, stop_sequence) from routes group by 1) p
                  where p.route = t.route_id and p.from_station = g.from_station_id and p.to_station = g.to_station_id)"""))
check("q18_passenger_location", ("O-Q18",), " union all ".join([
    _found("passenger_lost", "state", "passenger_state", "station_id,train_id", "passenger_id",
           "from passenger_snap where len(seen) > 0 and station_id is null and train_id is null"),
    _found("passenger_without_past_plan", "state", "passenger_state", "stops_seen_so_far", "passenger_id",
           "from passenger_snap where len(seen) > 0 and passenger_id in (select id from itinerary) and passenger_id not in (select passenger_id from plans)"),
    _found("passenger_off_route", "config", "passenger_state", "station_id", "passenger_id",
           """from passenger_snap s join plans using (passenger_id) where station_id is not null
              and not exists (select 1 from routes r where r.route_id = route and r.station_id = s.station_id)"""),
    _found("passenger_on_undefined_train", "config", "passenger_state", "train_id", "passenger_id",
           "from passenger_snap where train_id is not null and train_id not in (select train_id from trains)").replace("'config'", "'state'")]))
check("q19_route_stations", ("O-Q19",), _found("route_undefined_station", "config", "routes", "station_id", "route_id || ',' || station_id",
      "from routes where station_id not in (select station_id from stations)") + " union all "
      + _found("route_station_without_platform", "config", "routes", "station_id", "r.route_id || ',' || r.station_id",
               "from routes r where not exists (select 1 from platform_state p where p.station_id = r.station_id and p.route_id = r.route_id)"))
check("q20_platform_routes", ("O-Q20",), _found("platform_undefined_route", "config", "platform_state", "route_id", "station_id || ',' || route_id",
      "from (select distinct station_id, route_id from platform_state) where route_id not in (select route_id from routes)"))
check("q21_route_connectivity", ("O-Q21",), " union all ".join(
    _found("route_pair_without_segment", "config", f"{kind}_routes", "station_id", "concat_ws(',', route, from_station, to_station)",
           """from pairs p where to_station is not null and not exists
              (select 1 from segments g where g.from_station_id = from_station and g.to_station_id = to_station)""")
    + " union all " + _found("route_too_short", "config", f"{kind}_routes", "route_id", "route_id",
                             "from (select route_id, count(*) as n from routes group by 1) where n < 2") for kind in ("train", "passenger")))
check("q22_platform_occupancy", ("O-Q22",), _found("platform_double_occupied", "state", "train_state", "station_id,route_id", "station_id || ',' || route_id",
      "from (select station_id, route_id, count(*) as n from train_snap join trains using (train_id) where station_id is not null group by 1, 2) where n > 1"))


@register("rule_next_stop_history", ("O-R1",), GIVEN + """select s.train_id, t.route_id as route, array_to_string(seen, ',') as history,
  r.station_id as next_station, len(seen) = l.n as complete
  from train_snap s join trains t using (train_id) left join routes r on r.route_id = t.route_id and r.stop_sequence = len(seen)
  left join (select route_id, count(*) as n from routes group by 1) l on l.route_id = t.route_id""")
def next_stop_history(spark: SparkSession, d: str) -> DataFrame:
    from tramline.plans.rules import next_stop_from_history
    net, ev = network(spark, d), events(spark, d)
    trains = integrity.snapshot(ev.train_state, ["train_id"], ev).join(
        net.trains.select("train_id", F.col("route_id").alias("route")), "train_id")
    got = next_stop_from_history(trains, integrity.route_rows(net.routes), "train_id", "route", "stops_seen_so_far")
    history = F.concat_ws(",", F.transform("stops_seen_so_far", lambda x: x.cast("string")))
    return got.select("train_id", "route", history.alias("history"), "next_station", "complete")
