"""Station counters and boarding over the supplied tables.

Users are riders and events their log: a purchase puts a user into a vehicle,
any other event at a station, one station holding a third of these rows.
Vehicles dock by the clicks and leave by the signups of the same log. Orders
wait to be carried by suppliers with as many seats as they have free.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.operators.occupancy import board, station_counters
from tramline.plans.catalog import register, us
from tramline.sources.tables import Tables

# Fixed values of the mapping: a tick is an hour; stations 0..50, vehicles 0..39.
HOUR_US = 3_600_000_000

_LOG = f"""with e as (
  select event_id, user_id, event_type, epoch_us(ts) // {HOUR_US} as tick, epoch_us(ts) as us from events
), r as (
  select user_id as rider, tick, us, event_id, case when event_type <> 'purchase' then case when event_id % 3 = 0 then 0 else event_id % 50 + 1 end end as station,
    case when event_type = 'purchase' then event_id % 40 end as vehicle from e
), s as (
  select *, lead(tick) over w as until, lag(station) over w as prev_station, lag(vehicle) over w as prev_vehicle
  from r window w as (partition by rider order by tick, us, event_id)
), d as (
  select vehicle, tick, station, lead(tick) over (partition by vehicle order by tick) as until from (
    select event_id % 40 as vehicle, tick, max_by(case when event_type = 'click' then event_id // 7 % 51 end, case when event_type = 'click' then event_id end)
      as station from e where event_type in ('click', 'signup') group by 1, 2)
), last as (select max(tick) as t from r),
waits as (select station, tick as a, coalesce(until, (select t + 1 from last)) as b from s where station is not null),
docked as (
  select d.station, greatest(d.tick, s.tick) as a, least(coalesce(d.until, (select t + 1 from last)), coalesce(s.until, (select t + 1 from last))) as b
  from s join d on d.vehicle = s.vehicle and d.tick < coalesce(s.until, (select t + 1 from last)) and s.tick < coalesce(d.until, (select t + 1 from last))
  where d.station is not null
), moves as (
  select case when vehicle is not null then prev_station else station end as station, tick, vehicle is not null as boards from s
  where (vehicle is not null and prev_station is not null) or (station is not null and prev_vehicle is not null)
), first as (
  select station, min(a) as a from (select station, a from waits where a < b union all select station, a from docked where a < b
    union all select station, tick from moves) group by 1
), grid as (select station, unnest(range(a, (select t + 1 from last))) as tick from first)
"""


@register("station_counters", ("O-R6", "O-A14", "O-W5"), _LOG + """
select g.station, g.tick, coalesce(w.n, 0) as waiting, coalesce(w.n, 0) + coalesce(o.n, 0) as on_premises,
  coalesce(m.boarded, 0) as boarded, coalesce(m.entered, 0) as entered
from grid g
left join (select station, tick, count(*) as n from (select station, unnest(range(a, b)) as tick from waits) group by 1, 2) w using (station, tick)
left join (select station, tick, count(*) as n from (select station, unnest(range(a, b)) as tick from docked) group by 1, 2) o using (station, tick)
left join (select station, tick, count(*) filter (boards) as boarded, count(*) filter (not boards) as entered from moves group by 1, 2) m using (station, tick)
""")
def station_counters_q(spark, d):
    e = Tables(spark, d).events.select("event_id", "user_id", "event_type", us("ts").alias("us"))
    e = e.withColumn("tick", F.floor(F.col("us") / F.lit(HOUR_US)))
    eid, kind = F.col("event_id"), F.col("event_type")
    riders = e.select(F.col("user_id").alias("rider"), "tick", "us", "event_id",
                      F.when(kind != "purchase", F.when(eid % 3 == 0, 0).otherwise(eid % 50 + 1)).alias("station"),
                      F.when(kind == "purchase", eid % 40).alias("vehicle"))
    # of a vehicle's rows in an hour the last click says where it stands; only signups: under way
    stop = F.when(kind == "click", F.struct(eid.alias("id"), F.floor(eid / 7) % 51))
    docks = e.where(kind.isin("click", "signup")).groupBy((eid % 40).alias("vehicle"), "tick").agg(F.max(stop).alias("s")).select(
        "vehicle", "tick", F.col("s.col2").alias("station"))
    return station_counters(riders, docks, ["us", "event_id"])


@register("boarding", ("O-R4", "O-R7"), """
with q as (
  select o_orderkey as rider, case when o_orderkey % 3 = 0 then 0 else c_nationkey end as station, (c_nationkey + 1 + o_orderkey % 3) % 25 as next_stop,
    row_number() over (partition by case when o_orderkey % 3 = 0 then 0 else c_nationkey end, (c_nationkey + 1 + o_orderkey % 3) % 25
                       order by o_orderdate, o_orderkey) as rank
  from orders join customer on o_custkey = c_custkey
), v as (
  select s_suppkey as vehicle, s_nationkey * (s_suppkey % 2) as station, (s_nationkey + 1 + s_suppkey % 3) % 25 as next_stop,
    greatest(10 + s_suppkey % 40 - coalesce(n, 0), 0) as free
  from supplier left join (select l_suppkey, count(*) as n from lineitem where l_linenumber = 7 and l_linestatus = 'O' group by 1) on l_suppkey = s_suppkey
), seats as (
  select *, sum(free) over (partition by station, next_stop order by vehicle) as upto from v where free > 0
)
select q.rider, cast(q.station as bigint) as station, q.next_stop, vehicle, rank as place_in_queue
from q join seats using (station, next_stop) where rank <= upto and rank > upto - free
""")
def boarding_q(spark, d):
    t = Tables(spark, d)
    key, nation = F.col("o_orderkey"), F.col("c_nationkey")
    waiting = t.orders.select("o_orderkey", "o_custkey", "o_orderdate").join(
        t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey").select(
        key.alias("rider"), F.when(key % 3 == 0, 0).otherwise(nation).alias("station"), ((nation + 1 + key % 3) % 25).alias("next_stop"),
        "o_orderdate", "o_orderkey")
    riding = t.lineitem.where("l_linenumber = 7 and l_linestatus = 'O'").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count(F.lit(1)).alias("riders"))
    s, at = F.col("s_suppkey"), F.col("s_nationkey")
    vehicles = t.supplier.join(riding, "s_suppkey", "left").select(
        s.alias("vehicle"), (at * (s % 2)).alias("station"), ((at + 1 + s % 3) % 25).alias("next_stop"), (10 + s % 40).alias("capacity"), "riders")
    return board(waiting, vehicles, ["o_orderdate", "o_orderkey"], ["vehicle"])
