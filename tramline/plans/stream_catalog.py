"""Streaming operators run over the supplied ``events`` table.

Each query replays the table as a stream -- Spark writes it into a fresh
folder under the shared checkpoint directory, and a file-stream source reads
it back -- runs the streaming operator to completion (``availableNow``), and
returns the sink's output read back from Parquet. Nothing passes through
the driver. The oracle is the batch SQL of the same semantics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.plans.catalog import register, us
from tramline.schemas import EventTable
from tramline.session import scratch_path
from tramline.sources.landing import SEQUENCE, LandingStore
from tramline.sources.tables import load_table
from tramline.streaming.ingest import start_ingest, to_messages
from tramline.streaming.stateful import latest_per_key, transition_waits

# Fixed value: the split that delivers the second half of January first.
LATE_SPLIT = "2024-01-16 00:00:00"

EVENTS_TABLE = EventTable(
    "events", "events",
    T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                  T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
                  T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
                  T.StructField("created_at", T.TimestampType())]),
    ("user_id",))


def _replay_parquet(spark: SparkSession, df: DataFrame, name: str) -> str:
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return path


def _run(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def _to_parquet(out: str):
    """A sink that writes one folder per batch, so a batch that is run again doubles no rows."""
    def sink(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
    return sink


@register("stream_upsert", ("O-T1", "O-T2", "O-T4", "O-T7", "O-S3", "O-S4", "O-S5", "O-S6", "O-S7", "O-S8",
                            "O-S11", "O-S12"), """
select e.user_id, e.event_id, e.event_type, cast(e.value as decimal(15,2)) as value, f.first_event_id, f.n_writes
from events e join (select user_id, max(event_id) as last_id, min(event_id) as first_event_id, count(*) as n_writes
                    from events group by user_id) f on e.event_id = f.last_id
""")
def stream_upsert(spark: SparkSession, d: str) -> DataFrame:
    from tramline.streaming.ingest import MESSAGE_SCHEMA
    from tramline.streaming.live import publish_frames, read_published
    events = load_table(spark, d, "events")
    msgs = _replay_parquet(spark, to_messages(events, "events", offset_col="event_id"), "msgs")
    source = spark.readStream.schema(MESSAGE_SCHEMA).parquet(msgs)
    store = LandingStore(spark, scratch_path(spark, "landing"))
    out = scratch_path(spark, "published")

    def refresh(batch_id: int) -> None:
        # the live product of this stream: the upserted state per user
        publish_frames(spark, {"user_state": _upserted(store.at(batch_id))}, out, batch_id)

    _run(start_ingest(source, store, scratch_path(spark, "ckpt"), topics={"events": EVENTS_TABLE},
                      on_committed=refresh))
    return read_published(spark, out, "user_state")


def _upserted(store: LandingStore) -> DataFrame:
    from tramline.operators.upsert import merge_latest
    w = store.writes(EVENTS_TABLE)
    merged = merge_latest(w.withColumn("first_event_id", F.col("event_id")), ["user_id"], SEQUENCE,
                          ["event_id", "event_type", "value"], first_cols=["first_event_id"], count_alias="n_writes")
    return merged.select("user_id", "event_id", "event_type", F.col("value").cast("decimal(15,2)").alias("value"),
                         "first_event_id", "n_writes")


# Topics of the tick replay, and days to a delivery.
TICK_TOPICS = [f"events_{k}" for k in range(5)]
DELIVERY_DAYS = 16
FIRST_DAY = "2024-01-01"


def _tick_table(topic: str) -> EventTable:
    fields = [("event_id", T.LongType()), ("clock_tick", T.IntegerType()), ("event_type", T.StringType()), ("created_at", T.TimestampType())]
    return EventTable(topic, topic, T.StructType([T.StructField(n, t) for n, t in fields]), ("event_id",))


@register("topic_ticks", ("O-S4", "O-S6", "O-S8", "O-S12", "O-T1"), f"""
with e as (select event_id, user_id % 5 as k, date_diff('day', date '{FIRST_DAY}', cast(ts as date)) as d from events)
select 'events_' || k as topic, cast(d as integer) as clock_tick, count(*) as n, max(event_id) as last_event_id,
  (select max((d + event_id % 2) // {DELIVERY_DAYS}) from e) + 1 - (d + 1) // {DELIVERY_DAYS} as n_reads, cast(0 as bigint) as n_half
from e where d < (select max(d) from e) group by k, d
""")
def topic_ticks(spark: SparkSession, d: str) -> DataFrame:
    """Six topics through the topic log: a day's rows come in two appends, its clock message before both
    are there; every run resumes from the checkpoint, and no commit shows half a day."""
    from tramline.sources.topics import append_messages, subscribe
    first = F.lit(FIRST_DAY).cast("date")
    events = load_table(spark, d, "events").select("event_id", "user_id", "event_type", F.date_diff(F.col("ts").cast("date"), first).alias("clock_tick"))
    rows = events.select(F.concat(F.lit("events_"), F.col("user_id") % 5).alias("topic"), F.col("user_id").cast("string").alias("key"),
                         F.to_json(F.struct("event_id", "clock_tick", "event_type")).alias("value"), "clock_tick", "event_id",
                         F.floor((F.col("clock_tick") + F.col("event_id") % 2) / DELIVERY_DAYS).alias("delivery"))
    ticks = events.select("clock_tick").distinct().select(
        F.lit("ticks").alias("topic"), F.lit(None).cast("string").alias("key"),
        F.to_json(F.struct(F.col("clock_tick").cast("long").alias("event_id"), "clock_tick", F.lit("tick").alias("event_type"))).alias("value"),
        "clock_tick", F.lit(-1).cast("long").alias("event_id"), F.floor(F.col("clock_tick") / DELIVERY_DAYS).alias("delivery"))
    stamped = rows.union(ticks).withColumn("timestamp", F.timestamp_seconds(F.col("clock_tick") * 86400))
    log, ckpt = scratch_path(spark, "log"), scratch_path(spark, "ckpt")
    store = LandingStore(spark, scratch_path(spark, "landing"))
    tables = {t: _tick_table(t) for t in [*TICK_TOPICS, "ticks"]}
    commits: list[int] = []
    last = rows.agg(F.max("delivery")).head()[0]
    for k in range(0 if last is None else int(last) + 1):
        append_messages(stamped.where(F.col("delivery") == k), log, "clock_tick")
        _run(start_ingest(subscribe(spark, log, list(tables)), store, ckpt, topics=tables, signals=["ticks"], on_committed=commits.append))
    whole = rows.groupBy("topic", "clock_tick").agg(F.count(F.lit(1)).alias("all"))
    reads = [store.at(b).state(tables[t]).groupBy("clock_tick").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_event_id"))
             .select(F.lit(t).alias("topic"), "clock_tick", "n", "last_event_id") for b in commits for t in TICK_TOPICS]
    read = reads[0] if reads else whole.select("topic", "clock_tick", F.col("all").alias("n"), F.col("all").alias("last_event_id"))
    for r in reads[1:]:
        read = read.union(r)
    half = F.when(F.col("n") < F.col("all"), 1).otherwise(0)
    return read.join(whole, ["topic", "clock_tick"]).groupBy("topic", "clock_tick").agg(
        F.max("n").alias("n"), F.max("last_event_id").alias("last_event_id"), F.count(F.lit(1)).alias("n_reads"), F.sum(half).alias("n_half"))


@register("purge_replay", ("O-S9", "O-S3", "O-S7"), f"""
select e.user_id, e.event_id, e.event_type, cast(e.value as decimal(15,2)) as value, f.first_event_id, f.n_writes
from events e join (select user_id, max(event_id) as last_id, min(event_id) as first_event_id, count(*) as n_writes
                    from events where ts >= timestamp '{LATE_SPLIT}' group by user_id) f on e.event_id = f.last_id
""")
def purge_replay(spark: SparkSession, d: str) -> DataFrame:
    from tramline.streaming.ingest import parse_topic
    events = load_table(spark, d, "events")
    split = F.lit(LATE_SPLIT).cast("timestamp_ntz")
    store = LandingStore(spark, scratch_path(spark, "landing"))
    # batch 0: the first half; purged; batch 1: the second half
    for batch_id, part in enumerate([events.where(F.col("ts") < split), events.where(F.col("ts") >= split)]):
        store.append(EVENTS_TABLE, parse_topic(to_messages(part, "events", offset_col="event_id"), EVENTS_TABLE),
                     batch_id)
        store.commit(batch_id)
        if batch_id == 0:
            store.purge(0)
    return _upserted(store)


@register("stream_latest", ("O-T3", "O-W1"), """
select user_id, event_id, event_type, epoch_us(ts) as ts_us
from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) t
where rn = 1
""")
def stream_latest(spark: SparkSession, d: str) -> DataFrame:
    events = load_table(spark, d, "events").select("user_id", "event_id", "event_type", "ts")
    src = spark.readStream.schema(events.schema).parquet(_replay_parquet(spark, events, "events"))
    latest = latest_per_key(src, ["user_id"], ["ts", "event_id"], ["event_id", "event_type", "ts"])
    out = scratch_path(spark, "latest")

    def changed_keys(df: DataFrame, batch_id: int) -> None:
        # update mode: only keys whose latest row changed, one idempotent folder per batch
        df.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    _run(latest.writeStream.outputMode("update").foreachBatch(changed_keys)
         .option("checkpointLocation", scratch_path(spark, "ckpt")).trigger(availableNow=True).start())
    from tramline.operators.state import latest_by_key
    got = latest_by_key(spark.read.parquet(out), ["user_id"], ["ts", "event_id"], ["event_id", "event_type", "ts"])
    return got.select("user_id", "event_id", "event_type", us("ts").alias("ts_us"))


DAY_MS = 86_400_000


@register("stream_recent", ("O-T3", "O-F2", "O-S11"), """
select user_id, event_id, event_type, epoch_us(ts) as ts_us
from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn
      from events where ts >= (select max(ts) from events) - interval 5 day) t
where rn = 1
""")
def stream_recent(spark: SparkSession, d: str) -> DataFrame:
    """The latest state of the users of the last five days, served from keyed state that expires."""
    from tramline.streaming.stateful import recent_per_key
    events = load_table(spark, d, "events").select("user_id", "event_id", "event_type", "ts")
    folder, out = scratch_path(spark, "arrivals"), scratch_path(spark, "recent")
    first = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    week = F.floor(F.timestamp_diff("DAY", first, F.col("ts")) / 8)
    events.where(week == 0).write.parquet(f"{folder}/delivery=0")
    src = spark.readStream.schema(events.schema).parquet(folder)
    state = recent_per_key(src, "user_id", us("ts"), "event_id", F.col("event_type"), "ts", 5 * DAY_MS, delay_ms=0)
    ckpt, store = scratch_path(spark, "ckpt"), f"{out}/batch="

    def changed(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{store}{batch_id}")

    for k in range(4):  # four deliveries, each read by a run that resumes from the checkpoint
        if k:
            events.where(week == k).write.parquet(f"{folder}/delivery={k}")
        _run(state.writeStream.outputMode("update").foreachBatch(changed).option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start())
    # served: of each key the newest output, if it is not gone and within the look-back of the newest row
    from tramline.operators.state import latest_by_key, max_of
    rows = spark.read.schema("key long, t long, tb long, ms long, payload string, gone boolean, batch long").parquet(out)
    last = latest_by_key(rows, ["key"], ["batch"], ["t", "tb", "payload", "gone"])
    return last.where(~F.col("gone") & (F.col("t") >= max_of(last, "t") - 5 * DAY_MS * 1000)).select(
        F.col("key").alias("user_id"), F.col("tb").alias("event_id"), F.col("payload").alias("event_type"), F.col("t").alias("ts_us"))


def _waits_stream(spark: SparkSession, src: DataFrame, out: str, ckpt: str, tolerance_days: int, once: bool = False) -> None:
    waits = transition_waits(src, "user_id", us("ts"), "event_id", F.col("event_type") == "view",
                             F.col("event_type") == "purchase", event_time="ts", tolerance_ms=tolerance_days * DAY_MS,
                             horizon_ms=60 * DAY_MS, once=once)
    _run(waits.writeStream.outputMode("append").foreachBatch(_to_parquet(out))
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())


@register("stream_waits", ("O-T5", "O-T6", "O-T7", "O-W2", "O-M6"), """
select user_id, event_id, epoch_us(ts) - epoch_us(prev_ts) as wait_us
from (select *, lag(ts) over w as prev_ts, lag(event_type) over w as prev_type
      from events window w as (partition by user_id order by ts, event_id)) t
where event_type = 'purchase' and prev_type = 'view'
""")
def stream_waits(spark: SparkSession, d: str) -> DataFrame:
    events = load_table(spark, d, "events").select("user_id", "event_id", "event_type", "ts")
    folder, out = scratch_path(spark, "arrivals"), scratch_path(spark, "waits")
    # deliveries of ten days; every second event comes one delivery late, within the tolerance,
    # and every message comes again with the delivery after its own
    first = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    delivery = F.floor(F.timestamp_diff("DAY", first, F.col("ts")) / 10) + F.col("event_id") % 2
    for k in range(5):
        events.where(delivery.isin(k, k - 1)).write.parquet(f"{folder}/delivery={k}")
    # a row of no user, later than all: what was held back becomes final
    last = events.agg(F.max("ts").alias("m")).select(
        F.lit(-1).cast("long").alias("user_id"), F.lit(-1).cast("long").alias("event_id"), F.lit("end").alias("event_type"),
        (F.col("m") + F.expr("interval 30 days")).alias("ts"))
    last.write.parquet(f"{folder}/delivery=9")
    src = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 8).parquet(folder)
    _waits_stream(spark, src, out, scratch_path(spark, "ckpt"), tolerance_days=21, once=True)
    got = spark.read.schema("key long, t long, tb long, wait long, kind string").parquet(out)
    return got.where(F.col("kind") == "wait").select(F.col("key").alias("user_id"), F.col("tb").alias("event_id"),
                                                     F.col("wait").alias("wait_us"))


@register("stream_late", ("O-T6",), f"""
select user_id, event_id from events
where ts < timestamp '{LATE_SPLIT}' and user_id in (
  select user_id from events
  where ts >= timestamp '{LATE_SPLIT}' and epoch_ms(ts) <= (select max(epoch_ms(ts)) from events) - {DAY_MS})
""")
def stream_late(spark: SparkSession, d: str) -> DataFrame:
    events = load_table(spark, d, "events").select("user_id", "event_id", "event_type", "ts")
    split = F.lit(LATE_SPLIT).cast("timestamp_ntz")
    folder = scratch_path(spark, "arrivals")
    out, ckpt = scratch_path(spark, "late"), scratch_path(spark, "ckpt")
    # first delivery: the later half; second delivery: the earlier half, late
    # for users with a row that is final by then (a day older than the newest)
    events.where(F.col("ts") >= split).write.parquet(f"{folder}/part=1")
    src = spark.readStream.schema(events.schema).parquet(folder)
    _waits_stream(spark, src, out, ckpt, tolerance_days=1)
    events.where(F.col("ts") < split).write.parquet(f"{folder}/part=2")
    src = spark.readStream.schema(events.schema).parquet(folder)
    _waits_stream(spark, src, out, ckpt, tolerance_days=1)
    got = spark.read.schema("key long, t long, tb long, wait long, kind string").parquet(out)
    return got.where(F.col("kind") == "late").select(F.col("key").alias("user_id"), F.col("tb").alias("event_id"))


@register("stream_windows", ("O-T8", "O-T1"), """
select epoch_us(time_bucket(interval 1 day, ts)) as window_start_us, event_type, count(*) as n
from events group by 1, 2
""")
def stream_windows(spark: SparkSession, d: str) -> DataFrame:
    events = load_table(spark, d, "events").select("event_type", "ts")
    # one replay delivery: the watermark advances only after the batch, so no
    # replayed row is late; later deliveries older than the watermark would be
    src = spark.readStream.schema(events.schema).parquet(_replay_parquet(spark, events, "events"))
    # event time as an instant built from epoch microseconds: independent of the session time zone
    timed = src.withColumn("event_ts", F.timestamp_micros(us("ts"))).withWatermark("event_ts", "1 hour")
    counts = timed.groupBy(F.window("event_ts", "1 day").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    out = scratch_path(spark, "windows")

    def updated(df: DataFrame, batch_id: int) -> None:
        # update mode: windows whose count changed in this batch
        df.select(F.unix_micros(F.col("w.start")).alias("window_start_us"), "event_type", "n") \
            .write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    _run(counts.writeStream.outputMode("update").foreachBatch(updated)
         .option("checkpointLocation", scratch_path(spark, "ckpt")).trigger(availableNow=True).start())
    # counts only grow: the last emitted value of a window is its largest
    return spark.read.parquet(out).groupBy("window_start_us", "event_type").agg(F.max("n").alias("n"))
