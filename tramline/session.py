"""Session construction and the shared scratch location.

Intermediate tables that cut lineage are written under the folder named by
``spark.checkpoint.dir``: on a cluster that setting points at shared storage
every executor can reach. We only choose a folder ourselves when the session
has none (local tests).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # runtime broadcast only after AQE has measured the small side
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Sizing for a large cluster (about 1000 executors, ~100 TB of Parquet input).
# Scan splits of 256 MB give ~400k map tasks over 100 TB; AQE starts shuffles
# at 20k partitions and coalesces toward 256 MB each, so a reduce partition
# fits comfortably in an executor's memory and spills cleanly if not; skewed
# join partitions are split past 5x the median. A sequence-operator key is
# split once it exceeds 5M rows (roughly one 256 MB task of event rows).
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.broadcastTimeout": "600",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "tramline.sequence.chunkRows": "5000000",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "tramline", extra: dict | None = None, profile: str = "local",
              shared_dir: str | None = None) -> SparkSession:
    """Build (or get) the session. ``profile="cluster"`` applies ``CLUSTER_CONF``.

    ``shared_dir`` is the folder for checkpoints and scratch tables that all
    executors reach (``spark.checkpoint.dir``); off a local master one must be
    configured.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if shared_dir:
        conf["spark.checkpoint.dir"] = shared_dir
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and lineage-cutting tables.

    Read from the session. Only a local master, where driver and executors are
    one process, gets a temporary folder when nothing is configured; anywhere
    else that would scatter the data over the nodes' own disks, so it raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share (master {sc.master})")
        configured = tempfile.mkdtemp(prefix="tramline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/tramline/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove this application's scratch tables; call it when their frames are no longer read."""
    jvm, root = spark.sparkContext._jvm, _scratch_root(spark)
    path = jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tramline`` importable on Python workers (for Pandas-backed operators).

    Zips the package once per SparkContext and registers it with
    ``addPyFile``, which distributes it with the job like any dependency.
    """
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import shutil
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="tramline-pyfile-")
    archive = shutil.make_archive(os.path.join(out, "tramline"), "zip", os.path.dirname(pkg_dir), "tramline")
    sc.addPyFile(archive)
    _SHIPPED.add(key)



def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared scratch folder and read it back.

    This cuts the lineage: what is built on it neither computes it again for
    each of its uses nor depends on an executor that may be lost. It runs a job.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
