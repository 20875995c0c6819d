"""Every operator of the inventory, run over the supplied tables.

Each entry pairs a Spark plan (built from ``tramline.operators``, the same
code the transit products use) with an independent SQL statement that a
DuckDB oracle runs on the same Parquet files. Both sides name every output
column identically. Timestamps leave as epoch microseconds, money as
``decimal(18,2)`` from the 2-decimal source columns, and means through the
exact half-up helpers, so results compare value for value.

All queries read whole tables; no filter here exists to make a check
cheaper. Filters that *are* the feature (a look-back window, a filtered side
that creates anti-join gaps, an empty input) say so.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramline import functions as fx
from tramline.operators import checks
from tramline.operators.gaps import circular_gap, with_global_max
from tramline.operators.nested import explode_json
from tramline.operators.sequence import neighbors, running_total
from tramline.operators.sets import ordered_list, typed_union, unpivot_row
from tramline.operators.state import as_of, current_rows, latest_by_key, recent
from tramline.operators.upsert import merge_latest
from tramline.plans.exact import avg_half_up, pct_half_up, sql_avg_half_up, sql_pct_half_up
from tramline.plans.transit import corridor_offsets
from tramline.sources.tables import Tables

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    fn: QueryFn
    sql: str | None
    operators: tuple[str, ...]


CATALOG: dict[str, Entry] = {}


def register(name: str, operators: tuple[str, ...], sql: str | None):
    def wrap(fn: QueryFn) -> QueryFn:
        CATALOG[name] = Entry(fn, sql, operators)
        return fn
    return wrap


def us(col):
    """Epoch microseconds of a wall-clock (timestamp_ntz) column.

    A difference of two NTZ values, so the session time zone plays no part.
    """
    c = F.col(col) if isinstance(col, str) else col
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, c)


def money(col: str):
    return F.col(col).cast("decimal(15,2)")


# Fixed values used by several queries below.
AS_OF_TIME = "2024-01-15 12:00:00"
SEED_CUTOFF = "2024-01-10 00:00:00"
EVENT_CYCLE = ["signup", "view", "click", "purchase"]
CHAT_TEMPLATE = ["user", "assistant", "user", "assistant", "user", "assistant"]
GUIDED_TEMPLATE = ["system", "user", "assistant", "user", "assistant", "user"]
CLOCK_START = (2026, 54, "M", 8, 0)  # year, day of year, weekday code, hour, minute


def _sql_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


# ---------------------------------------------------------------------------
# anchors, look-back, latest state
# ---------------------------------------------------------------------------

@register("current_clock", ("O-A1", "O-F1", "O-J5", "O-M1"), """
select event_id, epoch_us(ts) as ts_us, user_id, event_type
from events where ts = (select max(ts) from events)
""")
def current_clock(spark, d):
    e = Tables(spark, d).events
    return current_rows(e, "ts").select("event_id", us("ts").alias("ts_us"), "user_id", "event_type")


@register("recent_window", ("O-F2", "O-J6", "O-J7", "O-M5"), """
select event_id, user_id, event_type, cast(value as decimal(15,2)) as value
from events where ts >= (select max(ts) from events) - interval 2 day
""")
def recent_window(spark, d):
    e = Tables(spark, d).events
    rows = recent(e, "ts", F.expr("INTERVAL 2 DAYS"))
    return rows.select("event_id", "user_id", "event_type", money("value").alias("value"))


@register("latest_state", ("O-W1", "O-F5", "O-F2", "O-M2", "O-T3"), """
select user_id, event_id, event_type, epoch_us(ts) as ts_us, cast(value as decimal(15,2)) as value
from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn
      from events where ts >= (select max(ts) from events) - interval 5 day) t
where rn = 1
""")
def latest_state(spark, d):
    e = Tables(spark, d).events
    rows = recent(e, "ts", F.expr("INTERVAL 5 DAYS"))
    last = latest_by_key(rows, ["user_id"], ["ts", "event_id"], ["event_id", "event_type", "ts", "value"])
    return last.select("user_id", "event_id", "event_type", us("ts").alias("ts_us"), money("value").alias("value"))


@register("distinct_on_latest", ("O-A7", "O-A8", "O-O3", "O-O4"), """
select o_custkey, o_orderkey, epoch_us(o_orderdate) as o_orderdate_us,
       cast(o_totalprice as decimal(15,2)) as o_totalprice, o_orderstatus
from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn
      from orders) t where rn = 1
""")
def distinct_on_latest(spark, d):
    o = Tables(spark, d).orders
    last = latest_by_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"],
                         ["o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus"])
    return last.select("o_custkey", "o_orderkey", us("o_orderdate").alias("o_orderdate_us"),
                       money("o_totalprice").alias("o_totalprice"), "o_orderstatus")


@register("as_of_snapshot", ("O-F3", "O-A7"), f"""
select user_id, event_id, event_type, epoch_us(ts) as ts_us
from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn
      from events where ts <= timestamp '{AS_OF_TIME}') t where rn = 1
""")
def as_of_snapshot(spark, d):
    e = Tables(spark, d).events
    rows = as_of(e, "ts", F.lit(AS_OF_TIME).cast("timestamp_ntz"))
    last = latest_by_key(rows, ["user_id"], ["ts", "event_id"], ["event_id", "event_type", "ts"])
    return last.select("user_id", "event_id", "event_type", us("ts").alias("ts_us"))


# ---------------------------------------------------------------------------
# unions, upsert
# ---------------------------------------------------------------------------

@register("seed_live_union", ("O-U1", "O-X1", "O-P8", "O-P9"), f"""
select event_id, user_id, substr(event_type, 1, 5) as event_type,
       cast(value as decimal(15,2)) as value, 'seed' as origin
from events where ts < timestamp '{SEED_CUTOFF}'
union all
select event_id, user_id, substr(event_type, 1, 5) as event_type,
       cast(value as decimal(15,2)) as value, 'live' as origin
from events where ts >= timestamp '{SEED_CUTOFF}'
""")
def seed_live_union(spark, d):
    from pyspark.sql import types as T
    e = Tables(spark, d).events
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                           T.StructField("event_type", T.StringType()), T.StructField("value", T.DecimalType(15, 2)),
                           T.StructField("origin", T.StringType())])
    cut = F.lit(SEED_CUTOFF).cast("timestamp_ntz")
    # varchar(5) semantics: an explicit cast truncates
    shaped = e.withColumn("event_type", F.substring("event_type", 1, 5))
    seed = shaped.where(F.col("ts") < cut).withColumn("origin", F.lit("seed"))
    live = shaped.where(F.col("ts") >= cut).withColumn("origin", F.lit("live"))
    return typed_union([seed, live], schema)


@register("upsert_last_write", ("O-S7", "O-T2", "O-A8"), """
with ranked as (
  select *, row_number() over (partition by l_orderkey, l_linenumber
      order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_quantity desc, l_extendedprice desc,
               l_discount desc, l_tax desc, l_returnflag desc, l_linestatus desc) as rn
  from lineitem),
firsts as (
  select l_orderkey, l_linenumber, min(l_shipdate) as first_ship, count(*) as n_writes
  from lineitem group by 1, 2)
select r.l_orderkey, r.l_linenumber, r.l_partkey, r.l_suppkey,
       cast(r.l_quantity as decimal(15,2)) as l_quantity,
       cast(r.l_extendedprice as decimal(15,2)) as l_extendedprice,
       epoch_us(f.first_ship) as first_write_us, epoch_us(r.l_shipdate) as last_write_us, f.n_writes
from ranked r join firsts f using (l_orderkey, l_linenumber) where r.rn = 1
""")
def upsert_last_write(spark, d):
    li = Tables(spark, d).lineitem
    seq = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
           "l_returnflag", "l_linestatus"]
    writes = li.withColumn("created_at", F.col("l_shipdate"))
    merged = merge_latest(writes, ["l_orderkey", "l_linenumber"], seq,
                          ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"],
                          first_cols=["created_at"], count_alias="n_writes")
    return merged.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                         money("l_quantity").alias("l_quantity"), money("l_extendedprice").alias("l_extendedprice"),
                         us("created_at").alias("first_write_us"), us("l_shipdate").alias("last_write_us"),
                         "n_writes")


# ---------------------------------------------------------------------------
# sequences: waits, topology, edges
# ---------------------------------------------------------------------------

_WAITS_SQL = """
select user_id, event_id, epoch_us(ts) - epoch_us(prev_ts) as wait_us
from (select *, lag(ts) over w as prev_ts, lag(event_type) over w as prev_type
      from events window w as (partition by user_id order by ts, event_id)) t
where event_type = 'purchase' and prev_type = 'view'
"""


def _waits(spark, d) -> DataFrame:
    e = Tables(spark, d).events.select("user_id", "event_id", "ts", "event_type")
    seq = neighbors(e, ["user_id"], ["ts", "event_id"], ["ts", "event_type"], "prev")
    done = seq.where((F.col("event_type") == "purchase") & (F.col("prev_event_type") == "view"))
    return done.select("user_id", "event_id", (us("ts") - us("prev_ts")).alias("wait_us"))


@register("wait_times", ("O-W2", "O-F6", "O-M6", "O-X14"), _WAITS_SQL)
def wait_times(spark, d):
    return _waits(spark, d)


@register("wait_summary", ("O-A5", "O-U2", "O-X4", "O-M18", "O-S11"), f"""
with w as ({_WAITS_SQL}), s as (
  select coalesce(max(wait_us // 1000000), 0) as max_wait,
         {sql_avg_half_up('wait_us // 1000000', 1, 0, default=0)} as avg_wait,
         coalesce(min(wait_us // 1000000), 0) as min_wait from w)
select 'Max' as metric, cast(max_wait as decimal(18,1)) as wait_time from s
union all select 'Avg', avg_wait from s
union all select 'Min', cast(min_wait as decimal(18,1)) from s
""")
def wait_summary(spark, d):
    secs = _waits(spark, d).select((F.col("wait_us") / F.lit(1000000)).cast("long").alias("s"))
    stats = secs.agg(F.coalesce(F.max("s"), F.lit(0)).alias("max_wait"),
                     avg_half_up(F.col("s"), 1, 0, default=0).alias("avg_wait"),
                     F.coalesce(F.min("s"), F.lit(0)).alias("min_wait"))
    return unpivot_row(stats, [("Max", "max_wait"), ("Avg", "avg_wait"), ("Min", "min_wait")],
                       "metric", "wait_time", value_type="decimal(18,1)")


@register("route_topology", ("O-W3", "O-W4", "O-W5", "O-M7", "O-M13", "O-O1"), """
select conv_id, turn, role, prev_role, running_chars, max(running_chars) over () as max_running_chars
from (select conv_id, turn, role, lag(role) over w as prev_role,
             cast(sum(length(text)) over (w rows between unbounded preceding and current row) as bigint) as running_chars
      from conversations window w as (partition by conv_id order by turn)) t
""")
def route_topology_q(spark, d):
    from tramline.operators.sequence import with_chunks
    base = Tables(spark, d).conversations.select("conv_id", "turn", "role",
                                                 F.length("text").cast("long").alias("n"))
    c = with_chunks(base, ["conv_id"], ["turn"])  # one set of chunks for both sequence operators
    c = neighbors(c, ["conv_id"], ["turn"], ["role"], "prev")
    c = running_total(c, ["conv_id"], ["turn"], "n", "running_chars")
    c = c.select("conv_id", "turn", "role", "prev_role", "running_chars")
    # lengths are non-negative: the largest running total is the largest per-key total
    totals = base.groupBy("conv_id").agg(F.sum("n").alias("total"))
    return with_global_max(c, "running_chars", "max_running_chars", totals, "total")


@register("topology_edges", ("O-W8", "O-F4", "O-M14"), """
select conv_id, turn, role, next_role
from (select conv_id, turn, role, lead(role) over (partition by conv_id order by turn) as next_role
      from conversations) t
where next_role is not null
""")
def topology_edges(spark, d):
    c = Tables(spark, d).conversations.select("conv_id", "turn", "role")
    c = neighbors(c, ["conv_id"], ["turn"], ["role"], "next")
    return c.where(F.col("next_role").isNotNull())


# ---------------------------------------------------------------------------
# circular spacing and bands
# ---------------------------------------------------------------------------

# The loop length and the offset that makes balances non-negative.
LOOP_LENGTH = 11000
BALANCE_OFFSET = 1000
GAP_BANDS = [(20, "bunched"), (200, "gapped")]

_GAPS_SQL = f"""
with s as (select s_suppkey, s_nationkey,
                  cast(s_acctbal as decimal(15,2)) + {BALANCE_OFFSET} as pos from supplier),
o as (select *, lead(pos) over w as next_pos, lead(s_suppkey) over w as next_id,
             first_value(pos) over (w rows between unbounded preceding and unbounded following) as first_pos,
             first_value(s_suppkey) over (w rows between unbounded preceding and unbounded following) as first_id
      from s window w as (partition by s_nationkey order by pos, s_suppkey))
select s_suppkey, s_nationkey, coalesce(next_id, first_id) as ahead_suppkey,
       cast(case when next_pos is not null then next_pos - pos
                 else ({LOOP_LENGTH} - pos) + first_pos end as decimal(18,2)) as gap
from o join nation n on o.s_nationkey = n.n_nationkey
"""


def _gaps(spark, d) -> DataFrame:
    t = Tables(spark, d)
    s = t.supplier.select("s_suppkey", "s_nationkey",
                          (money("s_acctbal") + F.lit(BALANCE_OFFSET)).alias("pos"))
    # one loop per nation; nation is a fixed 25-row dimension
    loops = t.nation.select(F.col("n_nationkey").alias("s_nationkey"),
                            F.lit(LOOP_LENGTH).cast("decimal(18,2)").alias("loop"))
    g = circular_gap(s, ["s_nationkey"], "pos", "s_suppkey", F.broadcast(loops), "loop",
                     "ahead_suppkey", "gap")
    return g.select("s_suppkey", "s_nationkey", "ahead_suppkey", F.col("gap").cast("decimal(18,2)").alias("gap"))


@register("circular_gaps", ("O-W6", "O-W7", "O-X8", "O-M9", "O-A2"), _GAPS_SQL)
def circular_gaps(spark, d):
    return _gaps(spark, d)


@register("gap_health", ("O-X7", "O-X4", "O-M15"), f"""
select s_suppkey, ahead_suppkey, gap,
       case when gap < 20 then 'bunched' when gap < 200 then 'gapped' else 'optimal' end as health
from ({_GAPS_SQL}) g
""")
def gap_health(spark, d):
    g = _gaps(spark, d)
    return g.select("s_suppkey", "ahead_suppkey", "gap", fx.bands("gap", GAP_BANDS, "optimal").alias("health"))


# ---------------------------------------------------------------------------
# joins
# ---------------------------------------------------------------------------

@register("linear_position", ("O-J1", "O-J3", "O-J4", "O-X2", "O-M8", "O-M12"), """
select l.l_orderkey, l.l_linenumber, l.l_suppkey, c.c_nationkey, r.r_name,
       cast(o.o_totalprice as decimal(15,2)) + coalesce(cast(s.s_acctbal as decimal(15,2)), 0) as position
from lineitem l
join orders o on l.l_orderkey = o.o_orderkey
join customer c on o.o_custkey = c.c_custkey
left join nation n on c.c_nationkey = n.n_nationkey
left join region r on n.n_regionkey = r.r_regionkey
left join supplier s on l.l_suppkey = s.s_suppkey and c.c_nationkey = s.s_nationkey
""")
def linear_position(spark, d):
    t = Tables(spark, d)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey")
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    # orders meet customers first: lineitem moves once for its order and once for its supplier
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_totalprice").join(c, "o_custkey")
    geo = t.nation.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"), "left") \
        .select(F.col("n_nationkey").alias("c_nationkey"), "r_name")
    s = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("c_nationkey"),
                          "s_acctbal")
    x = li.join(o, "l_orderkey").join(F.broadcast(geo), "c_nationkey", "left")
    x = x.join(s, ["l_suppkey", "c_nationkey"], "left")
    return x.select("l_orderkey", "l_linenumber", "l_suppkey", "c_nationkey", "r_name",
                    (money("o_totalprice") + F.coalesce(money("s_acctbal"), F.lit(0))).alias("position"))


@register("utilization", ("O-X3", "O-X4", "O-X16", "O-J3", "O-M10", "O-M12"), f"""
select l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_size as capacity,
       {sql_pct_half_up('l.l_quantity', 'p.p_size', 1)} as utilization_pct,
       cast(trunc(l.l_extendedprice / l.l_quantity * 1000) as bigint) / 1000.0 as unit_price
from lineitem l left join part p on l.l_partkey = p.p_partkey
""")
def utilization(spark, d):
    t = Tables(spark, d)
    p = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_size").alias("capacity"))
    x = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice") \
        .join(p, "l_partkey", "left")
    return x.select("l_orderkey", "l_linenumber", "l_partkey", "capacity",
                    pct_half_up(F.col("l_quantity"), F.col("capacity"), 1).alias("utilization_pct"),
                    fx.truncate_to(F.col("l_extendedprice") / F.col("l_quantity"), 3).alias("unit_price"))


@register("status_case", ("O-X5", "O-X6", "O-X18", "O-X22"), """
select o_orderkey,
       case when seg is not null and st is null then 'MOVING'
            when seg is null and st is not null then 'IN_STATION' else 'UNKNOWN' end as status,
       cast(greatest(coalesce(len(string_split_regex(o_orderpriority, '[- ]')), 0) - 1, 0) as integer) as recent_stop_sequence
from (select o_orderkey, o_orderpriority,
             case when o_orderstatus = 'O' then o_orderkey end as seg,
             case when o_orderstatus = 'F' then o_custkey end as st
      from orders) t
""")
def status_case(spark, d):
    o = Tables(spark, d).orders
    seg = F.when(F.col("o_orderstatus") == "O", F.col("o_orderkey"))
    st = F.when(F.col("o_orderstatus") == "F", F.col("o_custkey"))
    return o.select("o_orderkey", fx.entity_status(seg, st).alias("status"),
                    fx.stop_index(F.split("o_orderpriority", "[- ]")).alias("recent_stop_sequence"))


# ---------------------------------------------------------------------------
# aggregates
# ---------------------------------------------------------------------------

def _kpi_sql(where: str) -> str:
    return f"""
with lines as (
  select coalesce(sum(cast(l_quantity as decimal(15,2))), 0) as total_qty,
         {sql_avg_half_up('round(l_discount * 100)', 4, 2, default=0)} as avg_discount,
         count(l_orderkey) as n_lines
  from lineitem {where}),
ords as (select coalesce(sum(cast(o_totalprice as decimal(15,2))), 0) as total_price,
                count(o_orderkey) as n_orders from orders {where.replace('l_quantity', 'o_totalprice')})
select cast(total_qty as decimal(38,2)) as total_qty, avg_discount, n_lines,
       cast(total_price as decimal(38,2)) as total_price, n_orders,
       n_lines + n_orders as n_rows
from lines cross join ords
"""


def _kpis(li: DataFrame, o: DataFrame) -> DataFrame:
    lines = li.agg(F.coalesce(F.sum(money("l_quantity").cast("decimal(28,2)")), F.lit(0)).cast("decimal(38,2)").alias("total_qty"),
                   avg_half_up(F.round(F.col("l_discount") * 100), 4, 2, default=0).alias("avg_discount"),
                   F.count("l_orderkey").alias("n_lines"))
    ords = o.agg(F.coalesce(F.sum(money("o_totalprice").cast("decimal(28,2)")), F.lit(0)).cast("decimal(38,2)").alias("total_price"),
                 F.count("o_orderkey").alias("n_orders"))
    # the other single row comes in as a scalar subquery, not by a join
    other = ords.select(F.struct("total_price", "n_orders")).scalar()
    return lines.select("total_qty", "avg_discount", "n_lines", other["total_price"].alias("total_price"),
                        other["n_orders"].alias("n_orders"), (F.col("n_lines") + other["n_orders"]).alias("n_rows"))


@register("network_kpis", ("O-A3", "O-A4", "O-J8", "O-M16"), _kpi_sql(""))
def network_kpis(spark, d):
    t = Tables(spark, d)
    return _kpis(t.lineitem, t.orders)


@register("kpis_empty", ("O-A3", "O-A5"), _kpi_sql("where l_quantity < 0"))
def kpis_empty(spark, d):
    t = Tables(spark, d)
    # the empty input is the feature under test: aggregates still give one row of zeros
    return _kpis(t.lineitem.where(F.col("l_quantity") < 0), t.orders.where(F.col("o_totalprice") < 0))


@register("group_extents", ("O-A2", "O-A6", "O-M19", "O-S2"), """
select c_mktsegment, cast(min(c_acctbal) as decimal(15,2)) as start_bal,
       cast(max(c_acctbal) as decimal(15,2)) as end_bal, count(*) as n
from customer group by c_mktsegment
""")
def group_extents(spark, d):
    c = Tables(spark, d).customer
    return c.groupBy("c_mktsegment").agg(F.min(money("c_acctbal")).alias("start_bal"),
                                         F.max(money("c_acctbal")).alias("end_bal"), F.count("*").alias("n"))


@register("crowding_rank", ("O-O2", "O-M17", "O-M4", "O-S10"), """
select event_type, count(*) as n_users
from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) t
where rn = 1 group by event_type
""")
def crowding_rank(spark, d):
    e = Tables(spark, d).events
    last = latest_by_key(e, ["user_id"], ["ts", "event_id"], ["event_type"])
    return last.groupBy("event_type").agg(F.count("*").alias("n_users")).orderBy(F.desc("n_users"), "event_type")


@register("ordered_collect", ("O-A11", "O-J10", "O-A9", "O-A10"), """
with counts as (select c_nationkey, count(*) as n from customer group by c_nationkey)
select r.r_name,
       string_agg(n.n_name || ':' || cast(coalesce(c.n, 0) as varchar), ',' order by n.n_nationkey) as nation_list,
       cast(sum(coalesce(c.n, 0)) as bigint) as n_customers
from nation n join region r on n.n_regionkey = r.r_regionkey
left join counts c on c.c_nationkey = n.n_nationkey
group by r.r_name
""")
def ordered_collect(spark, d):
    t = Tables(spark, d)
    counts = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("n"))
    # nations per region: a fixed 25-row dimension, so each list is bounded
    x = t.nation.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey")) \
        .join(counts, "n_nationkey", "left") \
        .withColumn("n", F.coalesce(F.col("n"), F.lit(0)).cast("long")) \
        .withColumn("entry", F.concat_ws(":", "n_name", F.col("n").cast("string")))
    lists = ordered_list(x, ["r_name"], "n_nationkey", "entry", "nations")
    totals = x.groupBy("r_name").agg(F.sum("n").cast("long").alias("n_customers"))
    return lists.join(totals, "r_name").select("r_name", F.array_join("nations", ",").alias("nation_list"),
                                               "n_customers")


# ---------------------------------------------------------------------------
# calendar
# ---------------------------------------------------------------------------

@register("clock_calendar", ("O-X11", "O-X12", "O-X13", "O-M11"), """
select distinct cast(year(o_orderdate) as integer) as year, cast(dayofyear(o_orderdate) as integer) as day_of_year,
       dayname(make_date(year(o_orderdate), 1, 1) + (dayofyear(o_orderdate) - 1) * interval 1 day) as day_name,
       monthname(make_date(year(o_orderdate), 1, 1) + (dayofyear(o_orderdate) - 1) * interval 1 day) as month_name,
       cast(day(make_date(year(o_orderdate), 1, 1) + (dayofyear(o_orderdate) - 1) * interval 1 day) as integer)
         as day_of_month
from orders
""")
def clock_calendar(spark, d):
    o = Tables(spark, d).orders
    yd = o.select(F.year("o_orderdate").alias("year"), F.dayofyear("o_orderdate").alias("day_of_year")).distinct()
    cal = fx.calendar_parts("year", "day_of_year")
    return yd.select("year", "day_of_year", cal["day_name"].alias("day_name"),
                     cal["month_name"].alias("month_name"), cal["day_of_month"].alias("day_of_month"))


def _sql_tick_calendar(n: str) -> str:
    y, doy, wd, h, m = CLOCK_START
    codes = ["M", "T", "W", "R", "F", "S", "U"]
    total = f"({h * 60 + m} + {n})"
    days = f"({total} // 1440)"
    doy_off = f"({doy - 1} + {days})"
    return (f"cast({total} % 60 as integer) as minute, cast(({total} // 60) % 24 as integer) as hour_of_day, "
            f"[{_sql_list(codes)}][(({codes.index(wd)} + {days}) % 7) + 1] as day_of_week, "
            f"cast({doy_off} % 365 + 1 as integer) as day_of_year, cast({y} + {doy_off} // 365 as integer) as year")


@register("clock_range", ("O-R5", "O-X20", "O-X17"), f"""
select event_id, tick, {_sql_tick_calendar('tick')},
       lpad(cast(cast(((({CLOCK_START[3] * 60 + CLOCK_START[4]}) + tick) // 60) % 24 as integer) as varchar), 2, '0')
         || ':' || lpad(cast(cast((({CLOCK_START[3] * 60 + CLOCK_START[4]}) + tick) % 60 as integer) as varchar), 2, '0')
         as clock_text
from (select event_id, (epoch_us(ts) - (select epoch_us(min(ts)) from events)) // 60000000 as tick from events) t
""")
def clock_range(spark, d):
    e = Tables(spark, d).events
    start = e.select(F.min(us("ts"))).scalar()
    ticks = e.select("event_id", ((us("ts") - start) / F.lit(60000000)).cast("long").alias("tick"))
    y, doy, wd, h, m = CLOCK_START
    cal = fx.tick_calendar("tick", y, doy, wd, h, m)
    return ticks.select("event_id", "tick", cal["minute"].alias("minute"), cal["hour_of_day"].alias("hour_of_day"),
                        cal["day_of_week"].alias("day_of_week"), cal["day_of_year"].alias("day_of_year"),
                        cal["year"].alias("year"),
                        fx.clock_text(cal["hour_of_day"], cal["minute"]).alias("clock_text"))


@register("event_type_windows", ("O-T8",), """
select epoch_us(time_bucket(interval 1 day, ts)) as window_start_us, event_type, count(*) as n
from events group by 1, 2
""")
def event_type_windows(spark, d):
    e = Tables(spark, d).events
    w = e.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"))
    return w.select(us(F.col("w.start")).alias("window_start_us"), "event_type", "n")


# ---------------------------------------------------------------------------
# JSON
# ---------------------------------------------------------------------------

@register("json_unnest", ("O-J9", "O-X9", "O-X10", "O-M3", "O-P12"), """
select l_orderkey, l_linenumber, k, cast(v as decimal(15,2)) as v from (
  select l_orderkey, l_linenumber, 'discount' as k, l_discount as v, 0 as pos from lineitem where l_discount > 0
  union all
  select l_orderkey, l_linenumber, 'tax', l_tax, 1 from lineitem where l_tax > 0
  union all
  select l_orderkey, l_linenumber, null, null, 2 from lineitem where l_discount <= 0 and l_tax <= 0) t
""")
def json_unnest(spark, d):
    li = Tables(spark, d).lineitem
    items = F.filter(F.array(F.struct(F.lit("discount").alias("k"), F.col("l_discount").alias("v")),
                             F.struct(F.lit("tax").alias("k"), F.col("l_tax").alias("v"))),
                     lambda x: x["v"] > 0)
    docs = li.select("l_orderkey", "l_linenumber", F.to_json(items).alias("charges"))
    flat = explode_json(docs, "charges", "array<struct<k:string,v:double>>", alias="c", outer=True)
    return flat.select("l_orderkey", "l_linenumber", F.col("c.k").alias("k"), money("c.v").alias("v"))


@register("json_field", ("O-X9", "O-X1"), """
select event_type, cast(sum(cast(props->>'k' as integer)) as bigint) as k_sum, count(*) as n
from events group by event_type
""")
def json_field(spark, d):
    e = Tables(spark, d).events
    k = F.from_json("props", "struct<k:int>", {"mode": "FAILFAST"})["k"]
    return e.groupBy("event_type").agg(F.sum(k).alias("k_sum"), F.count("*").alias("n"))


# ---------------------------------------------------------------------------
# quality and integrity checks
# ---------------------------------------------------------------------------

@register("dq_not_null", ("O-Q1", "O-J3"), """
select 'not_null' as check_id, 'error' as severity, 'orders_lines' as table_name,
       'l_linenumber' as column_name, cast(o.o_orderkey as varchar) as entity
from orders o left join lineitem l on o.o_orderkey = l.l_orderkey
where l.l_linenumber is null
""")
def dq_not_null(spark, d):
    t = Tables(spark, d)
    joined = t.orders.select("o_orderkey").join(
        t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber"), "o_orderkey", "left")
    return checks.not_null(joined, "orders_lines", ["l_linenumber"], entity=["o_orderkey"])


@register("dq_unique", ("O-Q2",), """
select 'unique_combination' as check_id, 'error' as severity, 'documents' as table_name,
       'text_md5,text_len' as column_name, md5(text) as entity, count(*) as n
from documents where text is not null group by text having count(*) > 1
""")
def dq_unique(spark, d):
    # group on a digest of the whole text (plus its length), not the text itself:
    # the shuffle moves 32-character keys instead of whole documents
    docs = Tables(spark, d).documents.where(F.col("text").isNotNull()) \
        .select(F.md5("text").alias("text_md5"), F.length("text").alias("text_len"))
    return checks.unique(docs, "documents", ["text_md5", "text_len"], entity_expr=F.col("text_md5"))


@register("dq_unique_combo", ("O-Q3", "O-Q22"), """
select 'unique_combination' as check_id, 'error' as severity, 'lineitem' as table_name,
       'l_orderkey,l_linenumber' as column_name,
       cast(l_orderkey as varchar) || ',' || cast(l_linenumber as varchar) as entity, count(*) as n
from lineitem group by l_orderkey, l_linenumber having count(*) > 1
""")
def dq_unique_combo(spark, d):
    li = Tables(spark, d).lineitem
    return checks.unique(li, "lineitem", ["l_orderkey", "l_linenumber"])


@register("orphans", ("O-Q5", "O-Q7", "O-Q8", "O-Q15", "O-Q18", "O-J11", "O-U3"), """
select o_orderkey, o_custkey from orders o
where not exists (select 1 from customer c where c.c_custkey = o.o_custkey and c.c_mktsegment <> 'BUILDING')
""")
def orphans(spark, d):
    t = Tables(spark, d)
    # the filtered side is the feature: it creates the missing references
    known = t.customer.where(F.col("c_mktsegment") != "BUILDING").select(F.col("c_custkey").alias("o_custkey"))
    return t.orders.select("o_orderkey", "o_custkey").join(known, "o_custkey", "left_anti") \
        .select("o_orderkey", "o_custkey")


# Trade between nations over all rows is complete in both directions, so a few
# chosen edges are taken out (a nation does not sell to the one after it in
# every third nation) to give the check something to find.
_TRADE_EDGES_SQL = """
select distinct c.c_nationkey as from_nation, s.s_nationkey as to_nation
from lineitem l join orders o on l.l_orderkey = o.o_orderkey
join customer c on o.o_custkey = c.c_custkey join supplier s on l.l_suppkey = s.s_suppkey
where not (c.c_nationkey % 3 = 0 and s.s_nationkey = c.c_nationkey + 1)
"""


def _trade_edges(spark, d) -> DataFrame:
    t = Tables(spark, d)
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("from_nation"))
    # orders meet customers first, so lineitem moves once for its order and once for its supplier
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey").join(c, "o_custkey")
    s = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("to_nation"))
    x = t.lineitem.select("l_orderkey", "l_suppkey").join(o, "l_orderkey")
    # one row for each nation and supplier before the supplier join
    x = x.select("from_nation", "l_suppkey").distinct().join(s, "l_suppkey")
    chosen = (F.col("from_nation") % 3 == 0) & (F.col("to_nation") == F.col("from_nation") + 1)
    return x.where(~chosen).select("from_nation", "to_nation").distinct()


@register("asymmetric_edges", ("O-Q16", "O-U4", "O-J11"), f"""
with e as ({_TRADE_EDGES_SQL})
select from_nation, to_nation from e
where not exists (select 1 from e r where r.from_nation = e.to_nation and r.to_nation = e.from_nation)
""")
def asymmetric_edges(spark, d):
    return checks.asymmetric_edges(_trade_edges(spark, d), "from_nation", "to_nation")


def _sql_cycle_map() -> str:
    pairs = ", ".join(f"'{EVENT_CYCLE[i]}': '{EVENT_CYCLE[(i + 1) % len(EVENT_CYCLE)]}'"
                      for i in range(len(EVENT_CYCLE)))
    return "map {" + pairs + "}"


_INVALID_SQL = f"""
select user_id, event_id, prev_type, event_type from (
  select user_id, event_id, event_type, lag(event_type) over (partition by user_id order by ts, event_id) as prev_type
  from events) t
where prev_type is not null and prev_type <> event_type
  and coalesce({_sql_cycle_map()}[prev_type], '') <> event_type
"""


@register("invalid_transitions", ("O-Q17", "O-Q21", "O-R8", "O-X19"), _INVALID_SQL)
def invalid_transitions(spark, d):
    e = Tables(spark, d).events.select("user_id", "event_id", "ts", "event_type")
    return checks.invalid_transitions(e, ["user_id"], ["ts", "event_id"], "event_type", EVENT_CYCLE,
                                      ["user_id", "event_id"]) \
        .select("user_id", "event_id", "prev_type", "event_type")


_TEMPLATES_SQL = " union all ".join(
    [f"select 'chat' as route, {i} as pos, '{r}' as role" for i, r in enumerate(CHAT_TEMPLATE)]
    + [f"select 'guided', {i}, '{r}'" for i, r in enumerate(GUIDED_TEMPLATE)])


def _templates(spark) -> DataFrame:
    rows = [("chat", i, r) for i, r in enumerate(CHAT_TEMPLATE)] + \
           [("guided", i, r) for i, r in enumerate(GUIDED_TEMPLATE)]
    return spark.createDataFrame(rows, "route string, turn long, role string")


@register("prefix_check", ("O-Q9", "O-Q13", "O-X18", "O-R1"), f"""
with t as ({_TEMPLATES_SQL}),
c as (select conv_id, turn, role,
             case when first_value(role) over (partition by conv_id order by turn) = 'system'
                  then 'guided' else 'chat' end as route
      from conversations),
bad as (select c.conv_id, c.turn from c left join t on t.route = c.route and t.pos = c.turn
        where t.role is null or t.role <> c.role)
select conv_id, min(turn) as first_bad_turn, count(*) as n_bad from bad group by conv_id
""")
def prefix_check(spark, d):
    c = Tables(spark, d).conversations.select("conv_id", "turn", "role")
    from tramline.operators.sequence import attach, first_in_group
    first = first_in_group(c, ["conv_id"], ["turn"], ["role"])
    c = attach(c, first, ["conv_id"]).withColumn(
        "route", F.when(F.col("first_role") == "system", F.lit("guided")).otherwise(F.lit("chat")))
    return checks.prefix_violations(c, _templates(spark), "conv_id", "route", "turn", "role")


@register("state_disagreement", ("O-Q14",), """
with a as (select distinct l_orderkey, l_suppkey from lineitem where l_returnflag = 'R'),
     b as (select distinct l_orderkey, l_suppkey from lineitem where l_linestatus = 'O')
select coalesce(a.l_orderkey, b.l_orderkey) as l_orderkey, coalesce(a.l_suppkey, b.l_suppkey) as l_suppkey,
       case when a.l_orderkey is null then 'missing_in_a' else 'missing_in_b' end as side
from a full outer join b on a.l_orderkey = b.l_orderkey and a.l_suppkey = b.l_suppkey
where a.l_orderkey is null or b.l_orderkey is null
""")
def state_disagreement(spark, d):
    li = Tables(spark, d).lineitem
    return checks.flag_disagreement(li, ["l_orderkey", "l_suppkey"], F.col("l_returnflag") == "R", F.col("l_linestatus") == "O")


@register("next_stop", ("O-R1", "O-J2", "O-O5"), """
with r as (select n_regionkey, n_nationkey,
                  row_number() over (partition by n_regionkey order by n_nationkey) - 1 as seq from nation)
select c.c_custkey, cast(cur.seq as integer) as stop_index, nxt.n_nationkey as next_nationkey
from customer c join r cur on c.c_nationkey = cur.n_nationkey
left join r nxt on nxt.n_regionkey = cur.n_regionkey and nxt.seq = cur.seq + 1
""")
def next_stop(spark, d):
    t = Tables(spark, d)
    # a region's nations in key order form a route (fixed 25-row dimension)
    r = t.nation.select("n_regionkey", "n_nationkey",
                        (F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey")) - 1)
                        .alias("seq"))
    from tramline.plans.rules import next_stop as next_stop_rule
    return next_stop_rule(t.customer.select("c_custkey", F.col("c_nationkey").alias("station")),
                          F.broadcast(r.select(F.col("n_regionkey").alias("route"),
                                               F.col("seq"), F.col("n_nationkey").alias("station"))),
                          entity="c_custkey") \
        .select("c_custkey", F.col("seq").alias("stop_index"), F.col("next_station").alias("next_nationkey"))


@register("trips_due", ("O-R2", "O-J2", "O-A12"), """
with clock as (select distinct cast(dayofweek(ts) as integer) as wd, cast(hour(ts) as integer) as hh,
                      cast(minute(ts) as integer) as mm from events
               where ts is not null),
plans as (select user_id, event_id, cast(dayofweek(ts) as integer) as wd, cast(hour(ts) as integer) as hh,
                  cast(minute(ts) as integer) as mm from events),
due as (select p.*, row_number() over (partition by p.user_id, p.wd, p.hh, p.mm order by p.event_id) as rn
        from plans p join clock c on p.wd = c.wd and p.hh = c.hh and p.mm = c.mm)
select user_id, wd, hh, mm, event_id from due where rn = 1
""")
def trips_due(spark, d):
    e = Tables(spark, d).events
    parts = lambda df: df.select("*", (F.dayofweek("ts") - 1).alias("wd"), F.hour("ts").alias("hh"),
                                 F.minute("ts").alias("mm"))
    # the whole clock: 7 x 24 x 60 distinct minutes at most, a proven bound for the broadcast
    clock = parts(e.select("ts").where("ts is not null")).select("wd", "hh", "mm").distinct()
    from tramline.plans.rules import trips_due as trips_rule
    return trips_rule(parts(e).select("user_id", "event_id", "wd", "hh", "mm"), F.broadcast(clock),
                      ["wd", "hh", "mm"], "user_id", "event_id").select("user_id", "wd", "hh", "mm", "event_id")


@register("as_of_plan", ("O-R3", "O-J6"), """
with probes as (select distinct date_trunc('year', o_orderdate) as probe from orders)
select o_custkey, epoch_us(probe) as probe_us, o_orderkey, epoch_us(o_orderdate) as o_orderdate_us
from (select o.o_custkey, p.probe, o.o_orderkey, o.o_orderdate,
             row_number() over (partition by o.o_custkey, p.probe order by o.o_orderdate desc, o.o_orderkey desc) rn
      from orders o join probes p on o.o_orderdate <= p.probe) t
where rn = 1
""")
def as_of_plan(spark, d):
    o = Tables(spark, d).orders.select("o_custkey", "o_orderkey", "o_orderdate")
    probes = o.select(F.date_trunc("year", F.col("o_orderdate")).cast("timestamp_ntz").alias("probe")).distinct()
    from tramline.plans.rules import as_of_latest
    got = as_of_latest(o, probes, "o_custkey", "o_orderdate", "probe", ["o_orderkey"])
    return got.select("o_custkey", us("probe").alias("probe_us"), "o_orderkey",
                      us("o_orderdate").alias("o_orderdate_us"))


@register("as_of_views", ("O-R3", "O-W1"), """
select p.event_id, p.user_id, v.event_id as view_id, epoch_us(p.ts) - epoch_us(v.ts) as since_us
from (select * from events where event_type = 'purchase') p
left join (select * from events where event_type = 'view') v on v.event_id = (
  select max_by(x.event_id, (x.ts, x.event_id)) from events x
  where x.event_type = 'view' and x.user_id = p.user_id and x.ts <= p.ts)
""")
def as_of_views(spark, d):
    """Each purchase with the user's latest view up to then: an as-of merge on the user."""
    from tramline.operators.asof import as_of_merge
    e = Tables(spark, d).events.select("event_id", "user_id", "event_type", us("ts").alias("t"))
    views = e.where("event_type = 'view'").withColumnRenamed("event_id", "view_id")
    got = as_of_merge(e.where("event_type = 'purchase'"), views, ["user_id"], "t", "t", ["view_id"], ["view_id", "t"])
    return got.select("event_id", "user_id", F.col("asof_view_id").alias("view_id"), (F.col("t") - F.col("asof_t")).alias("since_us"))


@register("capacity_allocation", ("O-R4",), """
select o_custkey, o_orderkey, rn as slot from (
  select o.o_custkey, o.o_orderkey,
         row_number() over (partition by o.o_custkey order by o.o_orderdate, o.o_orderkey) as rn,
         greatest(cast(floor(c.c_acctbal / 1000) as bigint), 0) as cap
  from orders o join customer c on o.o_custkey = c.c_custkey) t
where rn <= cap
""")
def capacity_allocation(spark, d):
    t = Tables(spark, d)
    cap = t.customer.select(F.col("c_custkey").alias("o_custkey"),
                            F.greatest(F.floor(F.col("c_acctbal") / 1000).cast("long"), F.lit(0)).alias("cap"))
    from tramline.plans.rules import allocate
    return allocate(t.orders.select("o_custkey", "o_orderkey", "o_orderdate"), cap, "o_custkey",
                    ["o_orderdate", "o_orderkey"], "cap", "slot").select("o_custkey", "o_orderkey", "slot")


@register("corridor_offsets", ("O-M20", "O-X21", "O-A9"), """
with e as (
  select l.l_returnflag as route, cn.n_name as a, sn.n_name as b, min(l.l_orderkey) as ord,
         any_value(cn.n_nationkey) as ak, any_value(cn.n_regionkey) as ar,
         any_value(sn.n_nationkey) as bk, any_value(sn.n_regionkey) as br
  from lineitem l join orders o on l.l_orderkey = o.o_orderkey join customer c on o.o_custkey = c.c_custkey
  join supplier s on l.l_suppkey = s.s_suppkey
  join nation cn on c.c_nationkey = cn.n_nationkey join nation sn on s.s_nationkey = sn.n_nationkey
  group by 1, 2, 3),
f as (select *, least(a, b) || '|' || greatest(a, b) as corridor,
             row_number() over (partition by least(a, b), greatest(a, b), route order by ord) as k
      from e),
g as (select *, cast(row_number() over (partition by corridor order by route, ord) - 1 as integer) as offset_index
      from f where k = 1),
h as (select *, ak * 10.0 as x1, ar * 10.0 as y1, bk * 10.0 as x2, br * 10.0 as y2,
             case when offset_index = 0 then 0.0
                  else (case when offset_index % 2 = 1 then 12.0 else -12.0 end) * ((offset_index + 1) // 2) end as mag
      from g),
n as (select *, sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) as len from h)
select route, a as station_name, b as next_station_name, corridor, offset_index,
       round(x1 + (-(y2 - y1) / len) * mag, 6) as x1, round(y1 + ((x2 - x1) / len) * mag, 6) as y1,
       round(x2 + (-(y2 - y1) / len) * mag, 6) as x2, round(y2 + ((x2 - x1) / len) * mag, 6) as y2
from n where len > 0
""")
def corridor_offsets_q(spark, d):
    t = Tables(spark, d)
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey").join(c, "o_custkey")
    s = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    x = t.lineitem.select("l_orderkey", "l_suppkey", "l_returnflag").join(o, "l_orderkey")
    # the least order of each flag, nation and supplier, before the suppliers' nations are looked up
    x = x.groupBy("l_returnflag", "c_nationkey", "l_suppkey").agg(F.min("l_orderkey").alias("l_orderkey")).join(s, "l_suppkey")
    names = F.broadcast(t.nation.select("n_nationkey", "n_name"))
    edges = (x.groupBy(F.col("l_returnflag").alias("route_id"), "c_nationkey", "s_nationkey")
             .agg(F.min("l_orderkey").alias("ord"))
             .join(names.withColumnsRenamed({"n_nationkey": "c_nationkey", "n_name": "station_name"}), "c_nationkey")
             .join(names.withColumnsRenamed({"n_nationkey": "s_nationkey", "n_name": "next_station_name"}),
                   "s_nationkey"))
    coords = t.nation.select(F.col("n_name").alias("name"), (F.col("n_nationkey") * 10.0).alias("x"),
                             (F.col("n_regionkey") * 10.0).alias("y"))
    got = corridor_offsets(edges, "route_id", "ord", "station_name", "next_station_name", coords)
    r6 = lambda c: F.round(F.col(c), 6).alias(c)
    return got.select(F.col("route_id").alias("route"), "station_name", "next_station_name",
                      F.array_join("corridor", "|").alias("corridor"), "offset_index",
                      r6("x1"), r6("y1"), r6("x2"), r6("y2"))


@register("clipped_positions", ("O-M21", "O-X15", "O-A13"), """
select o_orderkey, cast(least(o_totalprice, (select max(c_acctbal) from customer)) as decimal(15,2)) as position
from orders
""")
def clipped_positions(spark, d):
    t = Tables(spark, d)
    bound = t.customer.select(F.max("c_acctbal")).scalar()
    return t.orders.select("o_orderkey", fx.clip_upper("o_totalprice", bound).cast("decimal(15,2)").alias("position"))


# ---------------------------------------------------------------------------
# operating rules over the supplied tables
# ---------------------------------------------------------------------------

@register("travel_ticks", ("O-R9", "O-W4"), """
select l_orderkey, l_linenumber, l_partkey, ticks,
       cast(sum(coalesce(ticks, 0)) over (partition by l_orderkey
            order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_shipdate
            rows between unbounded preceding and current row) as bigint) as ticks_from_start
from (select *, cast(ceil(l_quantity / nullif(l_discount, 0)) as bigint) as ticks from lineitem) t
""")
def travel_ticks_q(spark, d):
    from tramline.plans.rules import travel_ticks
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                          "l_discount", "l_shipdate")
    t = travel_ticks(li, "l_quantity", "l_discount").withColumn("ticks", F.col("travel_ticks").cast("long"))
    t = t.withColumn("_t0", F.coalesce(F.col("ticks"), F.lit(0).cast("long")))
    cum = running_total(t, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount",
                                            "l_shipdate"], "_t0", "ticks_from_start")
    return cum.select("l_orderkey", "l_linenumber", "l_partkey", "ticks", "ticks_from_start")


_RIDER_SQL = """
select user_id, event_id, ts,
       case when event_type <> 'purchase' then event_type end as station,
       case when event_type = 'purchase' then user_id end as vehicle
from events
"""


@register("station_counts", ("O-R6", "O-A14"), f"""
with r as ({_RIDER_SQL}),
s as (select *, lag(station) over w as prev_station, lag(vehicle) over w as prev_vehicle
      from r window w as (partition by user_id order by ts, event_id)),
b as (select cast(ts as date) as day, prev_station as station, 1 as b, 0 as e from s
      where vehicle is not null and prev_station is not null
      union all
      select cast(ts as date), station, 0, 1 from s where station is not null and prev_vehicle is not null)
select day, station, cast(sum(b) as bigint) as boarded, cast(sum(e) as bigint) as entered
from b group by day, station
""")
def station_counts_q(spark, d):
    from tramline.plans.rules import station_counts
    e = Tables(spark, d).events
    riders = e.select("user_id", "event_id", "ts",
                      F.when(F.col("event_type") != "purchase", F.col("event_type")).alias("station"),
                      F.when(F.col("event_type") == "purchase", F.col("user_id")).alias("vehicle"))
    counts = station_counts(riders, "user_id", "ts", "station", "vehicle", tiebreak=["event_id"],
                            period=F.to_date)
    return counts.select(F.col("ts").alias("day"), F.col("station_id").alias("station"),
                         F.col("passengers_boarded_trains").alias("boarded"),
                         F.col("passengers_entered_station").alias("entered"))


@register("alighting", ("O-R7", "O-J1"), """
select l.l_orderkey, l.l_linenumber, l.l_suppkey
from lineitem l join orders o on l.l_orderkey = o.o_orderkey
join customer c on o.o_custkey = c.c_custkey
left join supplier s on l.l_suppkey = s.s_suppkey
where s.s_nationkey is null or s.s_nationkey <> c.c_nationkey
""")
def alighting_q(spark, d):
    from tramline.plans.rules import alighting
    t = Tables(spark, d)
    riders = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey").join(
        t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("want")),
        "l_suppkey", "left")
    vehicles = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey").join(
        t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("next_stop")),
        "o_custkey").select("l_orderkey", "next_stop")
    return alighting(riders, vehicles, "l_orderkey", "want", "next_stop") \
        .select("l_orderkey", "l_linenumber", "l_suppkey")


@register("transition_audit", ("O-R8", "O-X19", "O-W2"), f"""
with t as (select user_id, event_id, event_type,
                  (epoch_us(ts) - (select epoch_us(min(ts)) from events)) // 60000000 as tick from events),
s as (select *, lag(event_type) over w as prev_state, lag(tick) over w as prev_tick
      from t window w as (partition by user_id order by tick, event_id))
select user_id, event_id, tick, prev_state, event_type,
       case when tick - prev_tick > 1 then 'gap' else 'invalid' end as verdict
from s
where prev_tick is not null
  and (tick - prev_tick > 1
       or not (prev_state = event_type or coalesce({_sql_cycle_map()}[prev_state], '') = event_type))
""")
def transition_audit_q(spark, d):
    from tramline.plans.rules import platform_transition_audit
    e = Tables(spark, d).events
    start = e.select(F.min(us("ts"))).scalar()
    t = e.select("user_id", "event_id", "event_type",
                 ((us("ts") - start) / F.lit(60000000)).cast("long").alias("tick"))
    return platform_transition_audit(t, ["user_id"], "tick", "event_type", EVENT_CYCLE, tiebreak=["event_id"]) \
        .select("user_id", "event_id", "tick", "prev_state", "event_type", "verdict")


# ---------------------------------------------------------------------------
# staging, seeds, semi joins and configuration checks
# ---------------------------------------------------------------------------

@register("seed_scan", ("O-S1", "O-X1", "O-X9"), """
select event_id, user_id, cast(user_id as integer) as first_id, cast(2 as integer) as n_ids,
       cast(props->>'k' as integer) as k
from events
""")
def seed_scan(spark, d):
    from pyspark.sql import types as T
    from tramline.session import scratch_path
    from tramline.sources.seeds import read_seed
    e = Tables(spark, d).events
    # the events as a seed file: an array-literal cell and a quoted JSON cell
    csv = e.select("event_id", "user_id",
                   F.concat(F.lit("{"), F.col("user_id").cast("string"), F.lit(","),
                            F.col("event_id").cast("string"), F.lit("}")).alias("ids"), "props")
    path = scratch_path(spark, "seed")
    csv.write.option("header", True).option("escape", '"').csv(path)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                           T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("props", T.StructType([T.StructField("k", T.IntegerType())]))])
    seed = read_seed(spark, path, schema, array_cols=["ids"], json_cols={"props": "struct<k:int>"})
    return seed.select("event_id", "user_id", F.col("ids")[0].alias("first_id"),
                       F.size("ids").alias("n_ids"), F.col("props.k").alias("k"))


@register("staging_casts", ("O-X1",), """
select cast(p_partkey as integer) as part_id, substr(p_name, 1, 10) as name10,
       cast(round(p_retailprice / 100) as integer) as price_hundreds,
       cast(p_size as decimal(18,6)) as size_num, p_brand
from part
""")
def staging_casts(spark, d):
    p = Tables(spark, d).part
    # varchar(10): an explicit cast truncates; integer length: rounded half away from zero
    return p.select(F.col("p_partkey").cast("int").alias("part_id"), F.substring("p_name", 1, 10).alias("name10"),
                    F.round(F.col("p_retailprice") / 100).cast("int").alias("price_hundreds"),
                    F.col("p_size").cast("decimal(18,6)").alias("size_num"), "p_brand")


@register("semi_match", ("O-J12", "O-F7"), """
select c_custkey, c_mktsegment from customer c
where exists (select 1 from orders o where o.o_custkey = c.c_custkey and o.o_orderpriority = '1-URGENT')
""")
def semi_match(spark, d):
    t = Tables(spark, d)
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.join(urgent, "c_custkey", "left_semi").select("c_custkey", "c_mktsegment")


@register("dq_nonempty", ("O-Q4",), """
select 'table_empty' as check_id, 'error' as severity, 'events_unknown_type' as table_name,
       '' as column_name, 'events_unknown_type' as entity
where (select count(*) from events where event_type = 'unknown') = 0
union all
select 'table_empty', 'error', 'events', '', 'events' where (select count(*) from events) = 0
""")
def dq_nonempty(spark, d):
    e = Tables(spark, d).events
    # an empty selection is the feature under test
    return checks.suite(checks.is_empty(e.where(F.col("event_type") == "unknown"), "table_empty",
                                        "events_unknown_type"),
                        checks.is_empty(e, "table_empty", "events"))


@register("dq_state_codes", ("O-Q6", "O-Q10", "O-Q12", "O-X19"), f"""
select 'unknown_code' as check_id, 'error' as severity, 'events' as table_name, 'event_type' as column_name,
       cast(event_id as varchar) as entity
from events where event_type not in ({_sql_list(EVENT_CYCLE)}) or event_type is null
union all
select 'unlocated', 'error', 'orders', 'o_orderstatus', cast(o_orderkey as varchar)
from orders where not (o_orderstatus = 'O') and not (o_orderstatus = 'F')
""")
def dq_state_codes(spark, d):
    t = Tables(spark, d)
    e = t.events
    unknown = e.where(~F.col("event_type").isin(EVENT_CYCLE) | F.col("event_type").isNull())
    seg = F.when(F.col("o_orderstatus") == "O", F.col("o_orderkey"))
    st = F.when(F.col("o_orderstatus") == "F", F.col("o_custkey"))
    unlocated = t.orders.where(seg.isNull() & st.isNull())
    return checks.suite(
        checks.frame(unknown, "unknown_code", "events", "event_type", F.col("event_id").cast("string")),
        checks.frame(unlocated, "unlocated", "orders", "o_orderstatus", F.col("o_orderkey").cast("string")))


@register("dq_config_refs", ("O-Q11", "O-Q19", "O-Q20", "O-Q21"), f"""
with regions as (select r_regionkey from region where r_name <> 'ASIA'),
nations as (select n_nationkey from nation where n_name <> 'GERMANY'),
e as ({_TRADE_EDGES_SQL}),
r as (select n_regionkey as route, n_nationkey as station,
             row_number() over (partition by n_regionkey order by n_nationkey) - 1 as seq from nation),
pairs as (select a.route, a.station as from_station, b.station as to_station
          from r a join r b on a.route = b.route and b.seq = a.seq + 1)
select 'undefined_region' as check_id, 'error' as severity, 'nation' as table_name,
       'n_regionkey' as column_name, cast(n_nationkey as varchar) as entity
from nation where n_regionkey not in (select r_regionkey from regions)
union all
select 'undefined_nation', 'error', 'supplier', 's_nationkey', cast(s_suppkey as varchar)
from supplier where s_nationkey not in (select n_nationkey from nations)
union all
select 'no_outgoing', 'error', 'nation', 'n_nationkey', cast(n_nationkey as varchar)
from nation where n_nationkey not in (select from_nation from e)
union all
select 'no_incoming', 'error', 'nation', 'n_nationkey', cast(n_nationkey as varchar)
from nation where n_nationkey not in (select to_nation from e)
union all
select 'pair_without_edge', 'error', 'routes', 'station',
       cast(route as varchar) || ',' || cast(from_station as varchar) || ',' || cast(to_station as varchar)
from pairs p where not exists (select 1 from e where e.from_nation = p.from_station and e.to_nation = p.to_station)
""")
def dq_config_refs(spark, d):
    from tramline.plans.integrity import route_pairs
    t = Tables(spark, d)
    # filtered sides are the feature: they create the undefined references
    regions = t.region.where(F.col("r_name") != "ASIA").select(F.col("r_regionkey").alias("n_regionkey"))
    nations = t.nation.where(F.col("n_name") != "GERMANY").select(F.col("n_nationkey").alias("s_nationkey"))
    edges = _trade_edges(spark, d)
    nat = t.nation.select("n_nationkey", "n_regionkey")
    # in- and out-degree per nation in one aggregation over the edge set
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("from_nation").alias("n_nationkey"), F.lit(1).alias("o"), F.lit(0).alias("i")),
        F.struct(F.col("to_nation").alias("n_nationkey"), F.lit(0).alias("o"), F.lit(1).alias("i")))).alias("e"))
    degree = ends.select("e.*").groupBy("n_nationkey").agg(F.sum("o").alias("out_deg"), F.sum("i").alias("in_deg"))
    outgoing = degree.where(F.col("out_deg") > 0).select("n_nationkey")
    incoming = degree.where(F.col("in_deg") > 0).select("n_nationkey")
    routes = t.nation.select(F.col("n_regionkey").alias("route_id"), F.col("n_nationkey").alias("stop_sequence"),
                             F.col("n_nationkey").alias("station_id"))
    gaps = route_pairs(routes, wrap=False).join(
        edges.select(F.col("from_nation").alias("from_station"), F.col("to_nation").alias("to_station")),
        ["from_station", "to_station"], "left_anti")
    return checks.suite(
        checks.missing(nat, F.broadcast(regions), "n_regionkey", "undefined_region", "nation", ["n_nationkey"],
                       "n_regionkey"),
        checks.missing(t.supplier, F.broadcast(nations), "s_nationkey", "undefined_nation", "supplier",
                       ["s_suppkey"], "s_nationkey"),
        checks.missing(nat, outgoing, "n_nationkey", "no_outgoing", "nation", ["n_nationkey"]),
        checks.missing(nat, incoming, "n_nationkey", "no_incoming", "nation", ["n_nationkey"]),
        checks.frame(gaps, "pair_without_edge", "routes", "station",
                      F.concat_ws(",", "route", "from_station", "to_station")))


@register("axis_bounds", ("O-A13", "O-S10"), f"""
with c as (select event_type, count(*) as n from events group by event_type),
w as ({_WAITS_SQL})
select cast(coalesce(nullif((select max(n) from c), 0), 10) as bigint) as crowd_axis_max,
       greatest(cast(20 as double),
                cast((select max(wait_us // 1000000) from w) as double) * cast(1.2 as double)) as wait_axis_max
""")
def axis_bounds(spark, d):
    from tramline.plans.serve import axis_max, padded_axis
    counts = Tables(spark, d).events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    secs = _waits(spark, d).select((F.col("wait_us") / F.lit(1000000)).cast("long").alias("s"))
    crowd = counts.agg(axis_max("n", 10).cast("long").alias("crowd_axis_max"))
    wait = secs.agg(padded_axis("s", 20.0, 1.2).alias("wait_axis_max"))
    return crowd.select("crowd_axis_max", wait.scalar().alias("wait_axis_max"))


# these entries register themselves into CATALOG
from tramline.plans import crowd, declared, given, live_catalog, stream_catalog  # noqa: E402,F401
