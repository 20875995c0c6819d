"""Live data products refreshed after every committed micro-batch.

All marts of one refresh are computed from one snapshot of the landing store
(fixed at the batch id just committed), written to ``<out>/<mart>/batch=<id>``,
and only then is ``<out>/_published/batch=<id>`` written. Readers take the
highest published batch, so they always see a complete, consistent set.

Wait times look at all history. With ``incremental`` they are kept instead of
computed anew: a refresh walks the passenger rows of the ticks that its batch
has completed after each passenger's last known row, and merges their maximum,
minimum, sum and count into those of the refresh before. It reads one row per
passenger and no older passenger rows. Ticks must be held back until they are
complete (``signals``); a later write to a tick already walked changes the
tables but not the wait summary.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.operators.sequence import neighbors
from tramline.operators.sets import unpivot_row
from tramline.operators.state import latest_by_key
from tramline.plans import transit as tp
from tramline.schemas import EVENT_TABLES
from tramline.sources.landing import LandingStore, path_exists

LIVE_MARTS = ("world_clock", "live_train_positions", "live_headways", "live_system_kpis",
              "live_station_crowding", "live_wait_times", "route_topology_mart", "system_topology_edges")

WAITS = "live_wait_times"

_EVENTS_FROM_TABLE = {"world_clock": "world_clock_state", "train_state": "train_state",
                      "passenger_state": "passenger_state", "rail_segment_state": "rail_segment_state",
                      "platform_state": "platform_state", "station_stats": "station_passenger_stats"}


# logs the live marts read only through the short look-back window
_RECENT_ONLY = ("train_state", "rail_segment_state", "station_stats", "platform_state")


def snapshot_events(store: LandingStore, seed: tp.Events | None = None, lookback: int | None = None) -> tp.Events:
    """Upserted event tables as one ``Events`` bundle (seed rows unioned in).

    With ``lookback``, the train, segment, station and platform logs are read
    from ``now - lookback`` on only: the bound is a scalar subquery over the
    clock, and it prunes ``tick_bucket`` folders. The passenger log stays
    whole (wait times use all history).
    """
    clock = store.state(EVENT_TABLES["world_clock_state"])
    bound = None
    if lookback is not None:
        ticks = clock.select("clock_tick")
        if seed is not None:
            ticks = ticks.unionByName(seed.world_clock.select(F.col("clock_tick").cast("int")))
        bound = ticks.select(F.coalesce(F.max("clock_tick"), F.lit(0)) - F.lit(lookback)).scalar()
    live = {}
    for f, t in _EVENTS_FROM_TABLE.items():
        if f == "world_clock":
            live[f] = clock
        else:
            live[f] = store.state(EVENT_TABLES[t], min_tick=bound if f in _RECENT_ONLY else None)
    return tp.stage_events(seed, tp.Events(**live))


def publish_frames(spark: SparkSession, frames: dict, out: str, batch_id: int) -> None:
    """Write named frames as version ``batch_id`` of each mart, then the marker.

    The marker is written last: readers never see a half-published set.
    """
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{out}/{name}/batch={batch_id}")
    spark.range(1).select(F.lit(batch_id).cast("long").alias("published")) \
        .write.mode("overwrite").json(f"{out}/_published/batch={batch_id}")


def publish(spark: SparkSession, store: LandingStore, net: tp.Network, out: str, batch_id: int,
            marts: Iterable[str] = LIVE_MARTS, seed: tp.Events | None = None, incremental: bool = False) -> None:
    """Refresh the transit marts from the snapshot at ``batch_id``."""
    snap = store.at(batch_id)
    ev = snapshot_events(snap, seed, lookback=tp.RECENT_TICKS)
    cached = tp.Events(**{k: getattr(ev, k).persist() for k in _EVENTS_FROM_TABLE})
    try:
        frames = {name: tp.ALL_PRODUCTS[name](cached, net) for name in marts if not (incremental and name == WAITS)}
        if incremental and WAITS in marts:
            frames[WAITS] = advance_waits(spark, snap, out, batch_id)
        publish_frames(spark, frames, out, batch_id)
    finally:
        for k in _EVENTS_FROM_TABLE:
            getattr(cached, k).unpersist()


_LAST_ROW = "passenger_id int, clock_tick int, train_id int"
_PARTS = "hi int, lo int, total decimal(38,0), n long, mark long"


def _published_before(spark: SparkSession, out: str, batch_id: int) -> int | None:
    if not path_exists(spark, f"{out}/_published"):
        return None
    done = spark.read.schema("published long, batch long").json(f"{out}/_published")
    return done.where(F.col("batch") < batch_id).agg(F.max("batch")).head()[0]


def advance_waits(spark: SparkSession, snap: LandingStore, out: str, batch_id: int) -> DataFrame:
    """O-M18 kept incrementally: the wait summary as of ``batch_id``.

    Reads the last refresh's one-row summary and last located row per
    passenger and the passenger rows of newly
    completed ticks; writes both anew for the next refresh, under the batch's
    own folders, so a refresh that is run again gives the same.
    """
    table = EVENT_TABLES["passenger_state"]
    before = _published_before(spark, out, batch_id)
    last = spark.createDataFrame([], _LAST_ROW)
    parts = spark.createDataFrame([], _PARTS)
    walked = None
    if before is not None:
        last = spark.read.schema(_LAST_ROW).parquet(f"{out}/_last_located/batch={before}")
        parts = spark.read.schema(_PARTS).parquet(f"{out}/_wait_parts/batch={before}")
        walked = parts.agg(F.max("mark")).head()[0]
    mark = snap.last_mark(F.lit(batch_id).cast("long"), snap.last_purge())
    rows = snap.state(table, min_tick=None if walked is None else int(walked) + 1)
    located = rows.where(F.col("station_id").isNotNull() | F.col("train_id").isNotNull()).select("passenger_id", "clock_tick", "train_id")
    merged = located.withColumn("fresh", F.lit(True)).unionByName(last.withColumn("fresh", F.lit(False)))
    seq = neighbors(merged, ["passenger_id"], ["clock_tick"], ["clock_tick", "train_id"], "prev")
    waits = seq.where("fresh and train_id is not null and prev_train_id is null and prev_clock_tick is not null").select(
        (F.col("clock_tick") - F.col("prev_clock_tick")).alias("w"))
    new = waits.agg(F.max("w").alias("hi"), F.min("w").alias("lo"), F.sum("w").cast("decimal(38,0)").alias("total"), F.count("w").alias("n"))
    summary = parts.drop("mark").unionByName(new).agg(F.max("hi").alias("hi"), F.min("lo").alias("lo"), F.sum("total").cast("decimal(38,0)").alias("total"),
                                                      F.sum("n").alias("n")).withColumn("mark", mark)
    summary.write.mode("overwrite").parquet(f"{out}/_wait_parts/batch={batch_id}")
    latest_by_key(merged, ["passenger_id"], ["clock_tick"], ["clock_tick", "train_id"]).select(
        *[F.col(c) for c in ("passenger_id", "clock_tick", "train_id")]).write.mode("overwrite").parquet(f"{out}/_last_located/batch={batch_id}")
    kept = spark.read.schema(_PARTS).parquet(f"{out}/_wait_parts/batch={batch_id}")
    mean = F.round(F.col("total") / F.nullif(F.col("n"), F.lit(0)), 1)
    shown = kept.select(*[F.coalesce(c, F.lit(0)).alias(a) for c, a in ((F.col("hi"), "hi"), (mean, "mean"), (F.col("lo"), "lo"))])
    return unpivot_row(shown, [("Max", "hi"), ("Avg", "mean"), ("Min", "lo")], "metric", "wait_time", value_type="decimal(18,1)")


def read_published(spark: SparkSession, out: str, mart: str) -> DataFrame:
    """The mart at the highest published batch."""
    pub = f"{out}/_published"
    if not path_exists(spark, pub):
        raise FileNotFoundError(f"nothing published under {out}")
    latest = spark.read.schema("published long, batch long").json(pub).select(F.max("batch")).scalar()
    df = spark.read.option("basePath", f"{out}/{mart}").parquet(f"{out}/{mart}")
    return df.where(F.col("batch") == latest).drop("batch")


def start_live(spark: SparkSession, source: DataFrame, landing: str, out: str, checkpoint: str,
               net: tp.Network, seed: tp.Events | None = None, available_now: bool = True,
               marts: Iterable[str] = LIVE_MARTS, signals: Sequence[str] = ()):
    """Ingest + publish in one query: each committed batch refreshes the marts.

    With ``signals`` (and no seed) ticks are held back until complete, and wait times are kept incrementally.
    """
    from tramline.streaming.ingest import start_ingest
    store = LandingStore(spark, landing)
    incremental = bool(signals) and seed is None
    return start_ingest(source, store, checkpoint, available_now=available_now, signals=signals,
                        on_committed=lambda b: publish(spark, store, net, out, b, marts, seed, incremental))
