"""Keyed upsert as merge-on-read.

Writes are appended (one directory per micro-batch, overwritten on replay,
so a repeated batch is idempotent). The upsert's result -- last write wins
on the payload, the first write's value kept for ``first_cols`` -- is a
grouped aggregate over all writes of a key, computed partially on each map
task. No file is rewritten in place, so readers never see half a merge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_latest(writes: DataFrame, keys: Sequence[str], seq: Sequence[str], payload: Sequence[str] | None = None,
                 first_cols: Sequence[str] = ("created_at",), count_alias: str | None = None) -> DataFrame:
    """Per key: ``payload`` from the write with the greatest ``seq`` tuple,
    ``first_cols`` from the write with the least, optionally the write count.

    ``seq`` must order writes totally within a key (e.g. batch id, offset).
    """
    keys, seq = list(keys), list(seq)
    first_cols = [c for c in first_cols if c in writes.columns]
    if payload is None:
        payload = [c for c in writes.columns if c not in keys and c not in seq and c not in first_cols]
    last_fields = seq + [c for c in payload if c not in seq]
    aggs = [F.max(F.struct(*last_fields)).alias("_last")]
    aggs += [F.min(F.struct(*seq, F.col(c).alias("_v"))).alias(f"_first_{c}") for c in first_cols]
    if count_alias:
        aggs.append(F.count(F.lit(1)).alias(count_alias))
    merged = writes.groupBy(*keys).agg(*aggs)
    out = [*keys, *[F.col(f"_last.{c}").alias(c) for c in payload],
           *[F.col(f"_first_{c}._v").alias(c) for c in first_cols]]
    if count_alias:
        out.append(count_alias)
    return merged.select(*out)
