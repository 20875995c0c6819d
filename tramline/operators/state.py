"""Anchors and latest-state selection over event logs.

"Now" is the largest tick of an anchor table. Bounds against it are written
as scalar subqueries, so the plan is one small aggregate job followed by a
filtered scan -- no join, no nested-loop join against a one-row table.

Latest-per-key is a grouped ``max`` over a struct whose first fields are the
ordering columns: the aggregate is computed partially on every map task
before the shuffle, so a hot key sends one row per task, never its history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def max_of(df: DataFrame, column: str, default=None) -> Column:
    """Scalar subquery ``(select max(column) from df)``; ``default`` when empty."""
    agg = F.max(column)
    if default is not None:
        agg = F.coalesce(agg, F.lit(default))
    return df.select(agg).scalar()


def current_rows(df: DataFrame, column: str, anchor: DataFrame | None = None,
                 anchor_column: str | None = None) -> DataFrame:
    """Rows whose ``column`` equals the anchor's maximum (default: ``df`` itself)."""
    anchor = df if anchor is None else anchor
    return df.where(F.col(column) == max_of(anchor, anchor_column or column))


def recent(df: DataFrame, column: str, lookback, anchor: DataFrame | None = None,
           anchor_column: str | None = None) -> DataFrame:
    """Rows with ``column >= max(anchor) - lookback`` (inclusive).

    ``lookback`` is a number for integer ticks or a Column (an interval) for
    timestamps. The bound is a scalar subquery, evaluated once.
    """
    anchor = df if anchor is None else anchor
    bound = max_of(anchor, anchor_column or column) - (lookback if isinstance(lookback, Column) else F.lit(lookback))
    return df.where(F.col(column) >= bound)


def as_of(df: DataFrame, column: str, bound) -> DataFrame:
    """Rows at or before ``bound`` (a literal or Column)."""
    return df.where(F.col(column) <= (bound if isinstance(bound, Column) else F.lit(bound)))


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  columns: Sequence[str] | None = None, pick: str = "max") -> DataFrame:
    """One row per key: the row with the greatest (``pick='max'``) or least
    ``order`` tuple. Remaining columns break ties, so the pick is deterministic.

    Partial aggregation happens before the shuffle (map-side combine).
    """
    keys, order = list(keys), list(order)
    cols = [c for c in (columns or df.columns) if c not in keys]
    ordered = order + [c for c in cols if c not in order]
    fn = F.max if pick == "max" else F.min
    packed = df.groupBy(*keys).agg(fn(F.struct(*ordered)).alias("_pick"))
    return packed.select(*keys, *[F.col(f"_pick.{c}").alias(c) for c in cols])


def first_write_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str) -> DataFrame:
    """Per key, the value of ``column`` on the earliest row by ``order``."""
    picked = df.groupBy(*keys).agg(F.min(F.struct(*order, F.col(column))).alias("_first"))
    return picked.select(*keys, F.col(f"_first.{column}").alias(column))
