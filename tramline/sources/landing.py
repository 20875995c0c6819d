"""Landing store for the six event tables: append-only, merge on read.

Layout under a base folder (any Hadoop file system path)::

    <base>/<table>/batch=<id>/tick_bucket=<k>/part-*.parquet
    <base>/_commits/batch=<id>/part-*.json

* Each micro-batch writes its rows of every table into ``batch=<id>`` with
  overwrite mode, so replaying a batch after a failure rewrites the same
  folder: the write is idempotent.
* A marker may carry a tick mark: the newest tick that is complete. Rows of
  later ticks are stored with their batch but not read before a later marker
  closes their tick, so no reader sees half a tick.
* The commit marker is written last. Readers only see batches with a marker,
  so all six tables are read at one consistent batch (no new clock with old
  trains).
* ``tick_bucket = clock_tick div BUCKET`` is a partition column: look-back
  filters on ``clock_tick`` also prune buckets.
* The upsert (last write wins per natural key, first ``created_at`` kept) is
  applied on read by ``merge_latest`` -- a partial aggregate -- ordered by
  ``SEQUENCE``: batch, then the message's time, then its place at the source,
  so within a batch a newer message wins whatever partition it came from.
* Batch ids of a run start at 0, so stored ids carry the run's *epoch* above
  them (``epoch * 2**32 + id``). ``run(checkpoint)`` gives a checkpoint its
  epoch, recorded once: a resumed run keeps it, a new run (after a purge, or a
  replay with other batch boundaries) gets a higher one and outranks whatever
  older runs have left.
* ``compact(table, upto)`` writes the merged state as of a committed batch to
  ``_compacted/<table>/upto=<id>`` and then a marker; reads merge that
  snapshot (one row per key) with the later batches only, so read cost
  follows the live data, not the length of the log.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.operators.upsert import merge_latest
from tramline.schemas import EVENT_TABLES, EventTable

BUCKET = 1440  # ticks per bucket: one simulated day
#: Order of writes.
SEQUENCE = ["_batch", "_time", "_offset"]


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


class LandingStore:
    def __init__(self, spark: SparkSession, base: str, upto: int | None = None, epoch: int = 0):
        self.spark = spark
        self.base = base.rstrip("/")
        self.upto = upto
        self.epoch = epoch

    def at(self, batch_id: int) -> "LandingStore":
        """A view of the store as of one committed batch (a fixed snapshot)."""
        return LandingStore(self.spark, self.base, batch_id, self.epoch)

    def run(self, checkpoint: str) -> "LandingStore":
        """The store for the streaming run of ``checkpoint``, in its own epoch."""
        folder = f"{self.base}/_epochs"
        known: dict[str, int] = {}
        if path_exists(self.spark, folder):  # one small row for each run ever started
            known = {r.checkpoint: r.number for r in self.spark.read.schema("checkpoint string, number int").json(folder).collect()}
        if checkpoint not in known:
            known[checkpoint] = max(known.values(), default=-1) + 1
            self.spark.createDataFrame([(checkpoint, known[checkpoint])], "checkpoint string, number int").write.mode(
                "overwrite").json(f"{folder}/epoch={known[checkpoint]}")
        return LandingStore(self.spark, self.base, self.upto, known[checkpoint])

    def sequence(self, batch_id: int) -> int:
        """The stored id of a run's batch."""
        return (self.epoch << 32) + batch_id

    # ---- writes ---------------------------------------------------------------

    def append(self, table: EventTable, rows: DataFrame, batch_id: int) -> None:
        """Write one batch of typed rows (schema of ``table``, ``_offset``, and ``_time`` if known)."""
        if "_time" not in rows.columns:
            rows = rows.withColumn("_time", F.lit(0).cast("long"))
        dest = f"{self.base}/{table.name}/batch={batch_id}"
        if "clock_tick" in rows.columns:
            out = rows.withColumn("tick_bucket", F.floor(F.col("clock_tick") / F.lit(BUCKET)).cast("int"))
            out.write.mode("overwrite").partitionBy("tick_bucket").parquet(dest)
        else:
            rows.write.mode("overwrite").parquet(dest)

    def purge(self, batch_id: int) -> None:
        """Empty every table as of ``batch_id`` (O-S9) without deleting files:
        a purge marker hides all writes of batches up to and including it."""
        marker = self.spark.range(1).select(F.lit(batch_id).cast("long").alias("purged"))
        marker.write.mode("overwrite").json(f"{self.base}/_purges/batch={batch_id}")

    def last_purge(self):
        if not path_exists(self.spark, f"{self.base}/_purges"):
            return F.lit(-1).cast("long")
        purges = self.spark.read.schema("purged long, batch long").json(f"{self.base}/_purges")
        return purges.select(F.coalesce(F.max("batch"), F.lit(-1)).cast("long")).scalar()

    def commit(self, batch_id: int, seen: dict[str, int] | None = None) -> None:
        """Make a batch visible. ``seen``: the newest tick that each topic which signals ticks has
        reached; ticks before the least of these are complete, later ones stay hidden."""
        mark = min(seen.values()) - 1 if seen else None
        marker = self.spark.range(1).select(
            F.lit(batch_id).cast("long").alias("committed"), F.lit(mark).cast("long").alias("mark"),
            F.lit(json.dumps(seen) if seen else None).cast("string").alias("seen"))
        marker.write.mode("overwrite").json(f"{self.base}/_commits/batch={batch_id}")

    def seen(self, batch_id: int) -> dict[str, int]:
        """What the last commit of this run before ``batch_id`` had seen (one small row)."""
        if not path_exists(self.spark, f"{self.base}/_commits"):
            return {}
        commits = self.spark.read.schema("seen string, batch long").json(f"{self.base}/_commits")
        last = commits.where((F.col("batch") < batch_id) & (F.col("batch") >= self.epoch << 32) & F.col("seen").isNotNull()).orderBy(
            F.desc("batch")).limit(1).collect()
        return json.loads(last[0].seen) if last else {}

    def last_mark(self, bound, purge):
        """Scalar subquery: the newest complete tick as of batch ``bound`` (null: no marker has one)."""
        if not path_exists(self.spark, f"{self.base}/_commits"):
            return F.lit(None).cast("long")
        commits = self.spark.read.schema("mark long, batch long").json(f"{self.base}/_commits")
        return commits.where((F.col("batch") <= bound) & (F.col("batch") > purge)).select(F.max("mark")).scalar()

    # ---- reads ----------------------------------------------------------------

    def last_committed(self):
        """Scalar subquery: the highest committed batch id (-1 when none)."""
        if not path_exists(self.spark, f"{self.base}/_commits"):
            return F.lit(-1).cast("long")
        commits = self.spark.read.schema("committed long, batch long").json(f"{self.base}/_commits")
        return commits.select(F.coalesce(F.max("batch"), F.lit(-1)).cast("long")).scalar()

    def _bucketed(self, table: EventTable) -> bool:
        return "clock_tick" in table.schema.fieldNames()

    def _last_compaction(self, table: EventTable, bound, purge):
        """Scalar subquery: the newest compaction usable under ``bound`` (-1 when none)."""
        path = f"{self.base}/_compactions/{table.name}"
        if not path_exists(self.spark, path):
            return F.lit(-1).cast("long")
        marks = self.spark.read.schema("compacted long, upto long").json(path)
        usable = marks.where((F.col("upto") <= bound) & (F.col("upto") > purge))
        return usable.select(F.coalesce(F.max("upto"), F.lit(-1)).cast("long")).scalar()

    def writes(self, table: EventTable, open_ticks: bool = False) -> DataFrame:
        """All committed writes of a table, with ``_batch`` and ``_offset``
        (batches covered by a compaction come from its snapshot); those of
        ticks that are not complete only with ``open_ticks``."""
        path = f"{self.base}/{table.name}"
        schema = T.StructType(list(table.schema.fields)).add("_time", "long").add("_offset", "long") \
            .add("batch", "long")
        if self._bucketed(table):
            schema = schema.add("tick_bucket", "integer")
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema).withColumnRenamed("batch", "_batch")
        df = self.spark.read.schema(schema).option("basePath", path).parquet(path)
        df = df.withColumnRenamed("batch", "_batch")
        bound = F.lit(self.upto).cast("long") if self.upto is not None else self.last_committed()
        purge = self.last_purge()
        compacted = self._last_compaction(table, bound, purge)
        if self._bucketed(table) and not open_ticks:
            mark = self.last_mark(bound, purge)
            df = df.where(mark.isNull() | (F.col("clock_tick") <= mark))
        recent = df.where((F.col("_batch") <= bound) & (F.col("_batch") > purge) & (F.col("_batch") > compacted))
        snap_path = f"{self.base}/_compacted/{table.name}"
        if not path_exists(self.spark, snap_path):
            return recent
        snap_schema = T.StructType(list(table.schema.fields)).add("_time", "long").add("_offset", "long") \
            .add("_src_batch", "long").add("upto", "long")
        if self._bucketed(table):
            snap_schema = snap_schema.add("tick_bucket", "integer")
        snap = self.spark.read.schema(snap_schema).option("basePath", snap_path).parquet(snap_path)
        if self._bucketed(table) and not open_ticks:
            snap = snap.where(mark.isNull() | (F.col("clock_tick") <= mark))
        snap = snap.where(F.col("upto") == compacted).withColumnRenamed("_src_batch", "_batch").drop("upto")
        return recent.unionByName(snap)

    def compact(self, table: EventTable, upto: int) -> None:
        """Write the merged state as of committed batch ``upto``, then its marker.

        Idempotent: a repeated compaction rewrites the same folder. The winning
        write keeps its own place in ``SEQUENCE``, so later batches still win.
        """
        as_of = self.at(upto)
        w = as_of.writes(table, open_ticks=True)
        merged = merge_latest(w, table.keys, SEQUENCE, [*table.payload, *SEQUENCE],
                              first_cols=["created_at"])
        out = merged.withColumnRenamed("_batch", "_src_batch")
        dest = f"{self.base}/_compacted/{table.name}/upto={upto}"
        if self._bucketed(table):
            out = out.withColumn("tick_bucket", F.floor(F.col("clock_tick") / F.lit(BUCKET)).cast("int"))
            out.write.mode("overwrite").partitionBy("tick_bucket").parquet(dest)
        else:
            out.write.mode("overwrite").parquet(dest)
        marker = self.spark.range(1).select(F.lit(upto).cast("long").alias("compacted"))
        marker.write.mode("overwrite").json(f"{self.base}/_compactions/{table.name}/upto={upto}")

    def state(self, table: EventTable, min_tick=None) -> DataFrame:
        """The upserted table: one row per natural key, last write wins.

        ``min_tick`` (an int or Column) restricts to recent ticks and prunes
        ``tick_bucket`` folders.
        """
        w = self.writes(table)
        if min_tick is not None:
            bound = min_tick if not isinstance(min_tick, int) else F.lit(min_tick)
            w = w.where((F.col("clock_tick") >= bound)
                        & (F.col("tick_bucket") >= F.floor(bound / F.lit(BUCKET))))
        merged = merge_latest(w, table.keys, SEQUENCE, table.payload, first_cols=["created_at"])
        return merged.select(*[f.name for f in table.schema.fields])

    def all_states(self) -> dict[str, DataFrame]:
        return {name: self.state(t) for name, t in EVENT_TABLES.items()}
