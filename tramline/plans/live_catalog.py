"""The live marts kept by one streaming query over the supplied tables.

The adapter's six logs become messages of their six topics in the topic log,
two appends with a tick cut in two between them. One streaming query ingests
them, holds ticks back until the clock has gone past them, and publishes all
eight marts after every commit, wait times incrementally.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.plans import given, serve
from tramline.plans.catalog import CATALOG, register
from tramline.schemas import EVENT_TABLES, TOPIC_TO_TABLE
from tramline.session import scratch_path, settle
from tramline.sources.topics import append_messages, subscribe
from tramline.streaming.ingest import to_messages
from tramline.streaming.live import _EVENTS_FROM_TABLE, LIVE_MARTS, read_published, start_live

# A number of every mart that is added up.
MART_NUMBERS = {"world_clock": "clock_tick", "live_train_positions": "passenger_count", "live_headways": "100 * gap_km",
                "live_system_kpis": "total_passengers_in_system", "live_station_crowding": "total_passengers_in_station",
                "live_wait_times": "10 * wait_time", "route_topology_mart": "stop_sequence", "system_topology_edges": "map_x"}


def _mart_sql(mart: str) -> str:
    body = CATALOG[f"product_{mart}"].sql[len(given.GIVEN):]
    return f"select '{mart}' as mart, count(*) as n, cast(sum({MART_NUMBERS[mart]}) as bigint) as total from ({body}) x"


def messages(spark: SparkSession, d: str) -> DataFrame:
    """The adapter's logs as messages (topic, key, value, clock_tick, timestamp) and a last clock message behind them."""
    ev = given.events(spark, d)
    parts = []
    for field, name in _EVENTS_FROM_TABLE.items():
        table = EVENT_TABLES[name]
        rows = getattr(ev, field).select(*[f.name for f in table.schema.fields if f.name != "created_at"])
        if field == "world_clock":
            rows = rows.unionByName(rows.groupBy().agg(F.max(F.struct(*rows.columns)).alias("x")).select("x.*").withColumn(
                "clock_tick", F.col("clock_tick") + 1).where("clock_tick is not null"))
        keep = to_messages(rows, table.topic)
        parts.append(keep.select("topic", "key", "value", F.get_json_object("value", "$.clock_tick").cast("long").alias("clock_tick")))
    return reduce(DataFrame.unionByName, parts).withColumn("timestamp", F.timestamp_seconds("clock_tick"))


@register("live_marts", ("O-T4", "O-M18", "O-S10", "O-S11", "O-S8", "O-S4", "O-S12"),
          given.GIVEN + " union all ".join(_mart_sql(m) for m in LIVE_MARTS))
def live_marts(spark: SparkSession, d: str) -> DataFrame:
    every = settle(messages(spark, d), "messages")
    middle = every.agg(F.floor((F.max("clock_tick") + F.min("clock_tick")) / 2)).scalar()
    # the middle tick's clock message and half of its other messages come first
    early = (F.col("clock_tick") < middle) | ((F.col("clock_tick") == middle) & ((F.col("topic") == "world_clock") | (F.xxhash64("value") % 2 == 0)))
    log, out, ckpt, landing = (scratch_path(spark, n) for n in ("log", "marts", "ckpt", "landing"))
    net = given.network(spark, d)
    for part in (early, ~early):
        append_messages(every.where(part), log, "clock_tick")
        q = start_live(spark, subscribe(spark, log, list(TOPIC_TO_TABLE)), landing, out, ckpt, net, signals=["world_clock"])
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    marts = [serve.shape(m, read_published(spark, out, m)).agg(
        F.lit(m).alias("mart"), F.count(F.lit(1)).alias("n"), F.expr(f"cast(sum({MART_NUMBERS[m]}) as bigint)").alias("total")) for m in LIVE_MARTS]
    return reduce(DataFrame.unionByName, marts)
