"""Circular spacing along a closed line and whole-result maxima."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.operators.sequence import attach, first_in_group, neighbors


def with_global_max(df: DataFrame, column: str, alias: str, source: DataFrame | None = None,
                    source_column: str | None = None) -> DataFrame:
    """Add ``max(column)`` over the whole frame as a constant column.

    Written as a scalar subquery instead of ``max() over ()``, which would
    pull every row into a single task. ``source`` may give a cheaper frame
    with the same maximum (e.g. per-key totals for a running sum of
    non-negative values), so the subquery does not recompute ``df``.
    """
    src = df if source is None else source
    return df.withColumn(alias, src.select(F.max(source_column or column)).scalar())


def circular_gap(df: DataFrame, part: Sequence[str], position: str, ident: str,
                 length: DataFrame, length_col: str, ahead_alias: str = "ahead_id",
                 gap_alias: str = "gap", bounded: bool = False) -> DataFrame:
    """Leader and distance to it for members ordered by ``position`` on a loop.

    Within each ``part``, order by (position, ident) -- ident breaks ties. A
    member's leader is the next one; the last member's leader is the first,
    and its gap wraps: ``(loop length - position) + first position``. A lone
    member leads itself with a gap of the whole loop. ``length`` holds one
    row per ``part`` with the loop length; members of a part without a
    length are dropped (inner join).
    """
    part = list(part)
    seq = neighbors(df, part, [position, ident], [position, ident], "next", prefix="_next_", bounded=bounded)
    first = first_in_group(df, part, [position, ident], [position, ident], prefix="_first_")
    seq = attach(seq, first, part)
    seq = seq.join(length.select(*part, F.col(length_col).alias("_loop")), part, "inner")
    gap = (F.when(F.col(f"_next_{position}").isNotNull(), F.col(f"_next_{position}") - F.col(position))
           .otherwise(F.col("_loop") - F.col(position) + F.col(f"_first_{position}")))
    return seq.select(*df.columns,
                      F.coalesce(F.col(f"_next_{ident}"), F.col(f"_first_{ident}")).alias(ahead_alias),
                      gap.alias(gap_alias))
