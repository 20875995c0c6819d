"""Typed unions, unpivots and ordered collection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s columns from ``df`` with explicit casts; missing ones are null."""
    cols = []
    for f in schema.fields:
        src = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(src.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def typed_union(frames: Sequence[DataFrame], schema: T.StructType) -> DataFrame:
    """UNION ALL of frames after casting each to one schema (no dedupe)."""
    parts = [conform(f, schema) for f in frames]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def unpivot_row(df: DataFrame, items: Sequence[tuple[str, str]], label: str, value: str,
                value_type: str | None = None, order_alias: str | None = None) -> DataFrame:
    """One output row per ``(label_text, column)`` item, for every input row.

    All values are cast to one type (``value_type``, or Spark's widening).
    ``order_alias`` adds the item's position so callers can keep item order.
    """
    pairs = []
    for i, (text, col) in enumerate(items):
        v = F.col(col) if value_type is None else F.col(col).cast(value_type)
        fields = [F.lit(text).alias(label), v.alias(value)]
        if order_alias:
            fields.append(F.lit(i).alias(order_alias))
        pairs.append(F.struct(*fields))
    return df.select(F.inline(F.array(*pairs)))


def ordered_list(df: DataFrame, keys: Sequence[str], order: str, value: str, alias: str) -> DataFrame:
    """Per key, ``value`` as an array ordered by ``order``.

    Only for groups bounded by configuration (a route's stops, a region's
    nations): the whole group becomes one array in one row.
    """
    packed = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(order), F.col(value)))).alias("_l"))
    return packed.select(*keys, F.transform("_l", lambda x: x[value]).alias(alias))
