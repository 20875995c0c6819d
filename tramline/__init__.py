"""tramline: fleet-state analytics on Spark.

Event logs of a moving fleet (clock, vehicles, riders, track segments,
platforms, stations) are kept as append-only Parquet, merged to the latest
state per entity on read, joined to the static network and turned into live
data products. Generic operators live in ``tramline.operators``; the transit
products that compose them live in ``tramline.plans``.
"""

from tramline.session import checkpoint_dir, get_spark, scratch_path

__all__ = ["checkpoint_dir", "get_spark", "scratch_path"]
