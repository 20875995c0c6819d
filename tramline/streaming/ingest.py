"""Continuous ingest of the six event topics into the landing store.

One streaming query reads every topic (Kafka in production, a file stream in
tests), and each micro-batch is routed by topic inside ``foreachBatch``:
JSON values are parsed against the declared schema, stamped with (batch,
message time, partition and offset) as the write sequence, appended to the
landing store, and the batch is committed last. A batch that is run again
writes the same folders; another run over the same store has an epoch of its
own. Published messages carry the natural key, so a broker keeps the writes of
one entity in order. With ``signals`` a tick is held back until it is complete.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.schemas import TOPIC_TO_TABLE, EventTable
from tramline.sources.landing import LandingStore

#: Batches between two compactions of the landing store.
COMPACT_EVERY = 64
MESSAGE_SCHEMA = "topic string, value string, partition int, offset long, timestamp timestamp"


def kafka_source(spark: SparkSession, servers: str, topics=None, starting: str = "earliest") -> DataFrame:
    """Subscribe to the topics (the Kafka connector jar must be on the classpath)."""
    topics = topics or list(TOPIC_TO_TABLE)
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
           .option("subscribe", ",".join(topics)).option("startingOffsets", starting).load())
    return raw.select("topic", F.col("value").cast("string").alias("value"), "partition", "offset", "timestamp")


def file_source(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Messages as JSON lines ``{topic, value, partition, offset}`` dropped in a folder."""
    r = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.json(folder)


def _payload_schema(table: EventTable) -> T.StructType:
    return T.StructType([f for f in table.schema.fields if f.name != "created_at"])


def parse_topic(batch: DataFrame, table: EventTable) -> DataFrame:
    """Typed rows of one topic.

    ``created_at`` is the message's own timestamp (the broker's append time,
    stable across replays), else the ingest time. Sequence within the batch
    is the source position (partition, offset).
    """
    rows = batch.where(F.col("topic") == table.topic)
    stamp = F.col("timestamp") if "timestamp" in batch.columns else F.lit(None).cast("timestamp")
    parsed = rows.select(F.from_json("value", _payload_schema(table), {"mode": "FAILFAST"}).alias("m"),
                         "partition", "offset", stamp.alias("_stamp"))
    cols = [F.col(f"m.{f.name}").alias(f.name) if f.name != "created_at"
            else F.coalesce(F.col("_stamp"), F.current_timestamp()).alias("created_at")
            for f in table.schema.fields]
    seq = (F.coalesce(F.col("partition"), F.lit(0)).cast("long") * F.lit(1 << 40)
           + F.coalesce(F.col("offset"), F.lit(0)).cast("long"))
    time = F.coalesce(F.unix_micros("_stamp"), F.lit(0).cast("long"))
    return parsed.select(*cols, time.alias("_time"), seq.alias("_offset"))


def route_batch(store: LandingStore, on_committed: Callable[[int], None] | None = None,
                topics: dict[str, EventTable] | None = None, compact_every: int | None = COMPACT_EVERY,
                signals: Sequence[str] = ()):
    """The ``foreachBatch`` function: route, append, commit, publish, and every
    ``compact_every`` batches compact each table (bounds read cost; None: never).

    A topic that is unknown or null raises. ``on_committed`` gets the stored
    batch id.

    ``signals`` are topics that have a message for every tick (the clock): a
    tick becomes readable when each of them has gone past it, and is hidden
    until then, however its rows are spread over micro-batches. The low-water
    mark of these topics is kept in the commit markers, so a restarted run goes on from it.
    """
    topics = topics or TOPIC_TO_TABLE
    known = list(topics)

    def reached(batch: DataFrame, stored: int) -> dict[str, int] | None:
        if not signals:
            return None
        now = {t: store.seen(stored).get(t, -1) for t in signals}
        for topic in signals:  # one number a topic
            newest = parse_topic(batch, topics[topic]).agg(F.max("clock_tick")).head()[0]
            now[topic] = max(now[topic], -1 if newest is None else int(newest))
        return now

    def run(batch: DataFrame, batch_id: int) -> None:
        stored = store.sequence(batch_id)
        batch.persist()
        try:
            unknown = batch.where(~F.coalesce(F.col("topic").isin(known), F.lit(False))).select("topic").limit(1).collect()
            if unknown:
                raise ValueError(f"message for unknown topic {unknown[0].topic!r}")
            for table in topics.values():
                store.append(table, parse_topic(batch, table), stored)
            store.commit(stored, reached(batch, stored))
        finally:
            batch.unpersist()
        if on_committed is not None:
            on_committed(stored)
        if compact_every and (batch_id + 1) % compact_every == 0:
            for table in topics.values():
                store.compact(table, stored)

    return run


def start_ingest(source: DataFrame, store: LandingStore, checkpoint: str, available_now: bool = True,
                 processing_time: str | None = None, on_committed: Callable[[int], None] | None = None,
                 topics: dict[str, EventTable] | None = None, compact_every: int | None = COMPACT_EVERY,
                 signals: Sequence[str] = ()):
    """Start the ingest query; the checkpoint makes restarts resume, and a new
    checkpoint with an ``earliest`` source replays everything (backfill) in a
    later epoch, so its writes win whatever its batch boundaries are."""
    w = source.writeStream.foreachBatch(route_batch(
        store.run(checkpoint), on_committed, topics, compact_every, signals)) \
        .option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def to_messages(df: DataFrame, topic: str, offset_col: str | None = None, keys: list[str] | None = None) -> DataFrame:
    """Sink side (O-S6): rows as JSON messages of a topic, keyed by ``keys`` (the topic's natural key by default)."""
    payload = F.to_json(F.struct(*df.columns))
    if keys is None and topic in TOPIC_TO_TABLE:
        keys = [k for k in TOPIC_TO_TABLE[topic].keys if k != "clock_tick"]
    key = F.to_json(F.struct(*keys)) if keys else F.lit(None).cast("string")
    off = F.col(offset_col).cast("long") if offset_col else F.monotonically_increasing_id()
    return df.select(F.lit(topic).alias("topic"), key.alias("key"), payload.alias("value"), F.lit(0).alias("partition"),
                     off.alias("offset"), F.current_timestamp().alias("timestamp"))


def write_messages(df: DataFrame, servers: str | None = None, path: str | None = None) -> None:
    """Publish messages (``to_messages`` output) to Kafka, or to a folder of
    JSON lines that ``file_source`` can read (tests, replays)."""
    if servers:
        (df.select("topic", *[c for c in ("key",) if c in df.columns], "value").write.format("kafka")
         .option("kafka.bootstrap.servers", servers).save())
    elif path:
        df.write.mode("append").json(path)
    else:
        raise ValueError("give servers or path")
