"""A message log of several topics over files, and a Spark data source that subscribes to it.

Messages are appended by ``append_messages``: each gets a partition from its
key and the next offsets of that partition, and the append becomes visible by
its marks, written last. ``spark.readStream.format("topic_log")`` reads any
number of topics of a log as one stream: offsets are kept per topic and
partition, a fresh checkpoint starts at the earliest (or latest) message, and
a restarted query resumes where its checkpoint stands. No broker and no port
are involved; the log lies on any file system that Arrow and Spark both reach.

Layout: ``<path>/append=<n>/topic=<t>/partition=<p>/*.parquet`` and
``<path>/_marks/append=<n>/*.json`` with the offset range of every topic and
partition of the append. An append that failed has no marks, and its number is
used again, in overwrite mode.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tramline.operators.sequence import running_total
from tramline.session import settle
from tramline.sources.landing import path_exists

PARTITIONS = 4
#: Offsets that one task reads at most.
ROWS_PER_TASK = 1_000_000
LOG_SCHEMA = "topic string, key string, value string, partition int, offset long, timestamp timestamp"
MARK_SCHEMA = "topic string, partition int, first long, end long, append int"


def _marks(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, f"{path}/_marks"):
        return spark.createDataFrame([], MARK_SCHEMA)
    return spark.read.schema(MARK_SCHEMA).json(f"{path}/_marks")


def append_messages(messages: DataFrame, path: str, order: str, partitions: int = PARTITIONS) -> None:
    """Append ``messages`` (topic, key, value, timestamp, and the number ``order``) to the log.

    Within a topic, messages of one key keep their ``order`` (a null key is a
    key like others). Offsets are running totals in chunks, so a topic or key
    with most of the messages is numbered by many tasks. One writer at a time.
    """
    spark = messages.sparkSession
    known = _marks(spark, path)
    number = known.agg(F.coalesce(F.max("append") + 1, F.lit(0))).head()[0]
    base = known.groupBy("topic", "partition").agg(F.max("end").alias("base"))
    part = F.pmod(F.xxhash64(F.coalesce("key", F.lit(""))), F.lit(partitions)).cast("int")
    rows = messages.withColumn("partition", part).withColumn("_one", F.lit(1).cast("long"))
    placed = running_total(rows, ["topic", "partition"], [order, "key", "value"], "_one", "_n").join(
        base, ["topic", "partition"], "left").withColumn("offset", F.coalesce("base", F.lit(0)) + F.col("_n") - 1)
    placed = settle(placed.select("topic", "key", "value", "partition", "offset", "timestamp"), "messages")
    placed.repartitionByRange("topic", "partition", "offset").sortWithinPartitions("topic", "partition", "offset").write.mode(
        "overwrite").partitionBy("topic", "partition").parquet(f"{path}/append={number}")
    placed.groupBy("topic", "partition").agg(F.min("offset").alias("first"), (F.max("offset") + 1).alias("end")).coalesce(1).write.mode(
        "overwrite").json(f"{path}/_marks/append={number}")


def _open(path: str):
    """The Arrow file system of a path, and the path there."""
    from pyarrow import fs
    local = re.sub(r"^file:/+", "/", path)
    return (fs.LocalFileSystem(), local) if local.startswith("/") else fs.FileSystem.from_uri(path)


@dataclass
class Range(InputPartition):
    """Offsets lo (inclusive) to hi of one topic and partition, in one append."""

    folder: str
    topic: str
    partition: int
    lo: int
    hi: int


class _Log:
    """What both readers share: marks, ranges and rows of a log."""

    def __init__(self, options: dict) -> None:
        self.path = options["path"].rstrip("/")
        self.topics = [t.strip() for t in options["topics"].split(",") if t.strip()]
        self.earliest = options.get("startingOffsets", options.get("startingoffsets", "earliest")) == "earliest"

    def marks(self) -> list[dict]:
        from pyarrow import fs
        store, root = _open(f"{self.path}/_marks")
        out = []
        for info in store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            if info.is_file and info.base_name.endswith(".json"):
                append = int(re.search(r"append=(\d+)/", info.path)[1])
                with store.open_input_stream(info.path) as f:
                    out += [{**json.loads(line), "append": append} for line in f.read().decode().splitlines()]
        return [m for m in out if m["topic"] in self.topics]

    def ends(self) -> dict:
        out: dict = {}
        for m in self.marks():
            name = f"{m['topic']}/{m['partition']}"
            out[name] = max(out.get(name, 0), m["end"])
        return out

    def ranges(self, start: dict, end: dict) -> list[Range]:
        out = []
        for m in self.marks():
            name = f"{m['topic']}/{m['partition']}"
            lo, hi = max(m["first"], start.get(name, 0)), min(m["end"], end.get(name, 0))
            folder = f"{self.path}/append={m['append']}/topic={m['topic']}/partition={m['partition']}"
            out += [Range(folder, m["topic"], m["partition"], a, min(a + ROWS_PER_TASK, hi)) for a in range(lo, hi, ROWS_PER_TASK)]
        return out

    @staticmethod
    def rows(p: Range) -> Iterator:
        import pyarrow as pa
        import pyarrow.dataset as ds
        store, folder = _open(p.folder)
        table = ds.dataset(folder, filesystem=store, format="parquet")
        inside = (ds.field("offset") >= p.lo) & (ds.field("offset") < p.hi)
        for batch in table.to_batches(columns=["key", "value", "offset", "timestamp"], filter=inside):
            if batch.num_rows:
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p.topic] * n), batch.column(0), batch.column(1), pa.array([p.partition] * n, pa.int32()), batch.column(2),
                     batch.column(3).cast(pa.timestamp("us", tz="UTC"))], names=["topic", "key", "value", "partition", "offset", "timestamp"])


class TopicLogStream(DataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self.log = _Log(options)

    def initialOffset(self) -> dict:
        return {} if self.log.earliest else self.log.ends()

    def latestOffset(self) -> dict:
        return self.log.ends()

    def partitions(self, start: dict, end: dict) -> list[Range]:
        return self.log.ranges(start, end)

    def read(self, partition: Range) -> Iterator:
        return self.log.rows(partition)

    def commit(self, end: dict) -> None:
        """Nothing to do: the checkpoint holds the offsets."""


class TopicLogBatch(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.log = _Log(options)

    def partitions(self) -> list[Range]:
        return self.log.ranges({}, self.log.ends())

    def read(self, partition: Range) -> Iterator:
        return self.log.rows(partition)


class TopicLog(DataSource):
    """``format("topic_log")`` with options ``path``, ``topics`` (comma-separated) and ``startingOffsets``."""

    @classmethod
    def name(cls) -> str:
        return "topic_log"

    def schema(self) -> str:
        return LOG_SCHEMA

    def streamReader(self, schema) -> TopicLogStream:
        return TopicLogStream(self.options)

    def reader(self, schema) -> TopicLogBatch:
        return TopicLogBatch(self.options)


def subscribe(spark: SparkSession, path: str, topics: list[str], starting: str = "earliest") -> DataFrame:
    """The topics of a log as one stream of messages."""
    # Spark plans the source in a Python process that does not see this package: ship the classes themselves
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(TopicLog)
    return spark.readStream.format("topic_log").option("path", path).option("topics", ",".join(topics)).option(
        "startingOffsets", starting).load()
