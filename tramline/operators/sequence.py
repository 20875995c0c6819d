"""Ordered per-key sequences: previous/next row, running totals, first row.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task, so
a key holding a third of the log becomes a third of the job on one core. These
operators therefore always work in *chunks*, by one algorithm for every input:

1. the first ordering column is cut at quantiles, one chunk for every
   ``tramline.sequence.chunkRows`` rows. Row count and quantiles come from one
   sketch (``percentile_approx``) in a scalar subquery of the same query: no
   job runs while a frame is built, and Spark evaluates the subquery once, so
   all branches and retries of a query see the same ids. Values far out or
   crowded in a corner of the range move the split points only. Where more
   chunks than QUANTILES are needed, each interval is cut in equal steps;
2. the window runs inside ``(key, chunk)`` groups -- one shuffle;
3. rows at chunk edges are fixed from a per-(key, chunk) summary (one row per
   chunk that a key has), windowed per key and joined on the window's own
   partitioning keys.

No list of keys is made and none is capped: any number of keys of any weight
are cut alike. Nulls in the first ordering column are a chunk before all
others, as they sort first. A key can only be cut at distinct values of that
column, which must be a number, date or time; give text a dense number first.
``bounded=True`` is for inputs whose groups are bounded by configuration (a
route's stops, a fleet's latest state), where one shuffle on the key is the
cheaper plan; it takes any order.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK = "_chunk"
#: The key columns as one struct: never null itself, so null keys join and are cut like others.
KEY = "_key"
DEFAULT_CHUNK_ROWS = 1_000_000
#: Intervals of equal weight that the sketch cuts an input into, and the sketch's accuracy (rank error: its inverse).
QUANTILES, ACCURACY = 512, 8192


def _number(df: DataFrame, name: str) -> Column:
    """A double that never falls while the column rises; null stays null."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.NumericType):
        return F.col(name).cast("double")
    if isinstance(dtype, T.DateType):
        return F.unix_date(name).cast("double")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(name).cast("double")
    if isinstance(dtype, T.TimestampNTZType):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    raise TypeError(f"order sequences first by a number, date or time, not by {name} ({dtype.simpleString()}); "
                    "give a dense number for it, or bounded=True for small groups")


def with_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add the chunk id once for several sequence operators over the same order; drop ``_chunk`` at the end."""
    if CHUNK in df.columns:
        return df
    x = _number(df, order[0])
    rows = int(df.sparkSession.conf.get("tramline.sequence.chunkRows", str(DEFAULT_CHUNK_ROWS)))
    known = df.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    points = [i / QUANTILES for i in range(1, QUANTILES)]
    sketch = known.agg(F.struct(
        F.ceil(F.count("x") / F.lit(rows)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"),
        F.percentile_approx("x", points, ACCURACY).alias("q"))).scalar()
    placed = df.withColumns({"_x": x, "_sketch": sketch})
    at, q, n = F.col("_x"), F.col("_sketch.q"), F.col("_sketch.n")
    # a binary search: how many of the split points are at or below x
    steps = F.array(*[F.lit(1 << k) for k in reversed(range((QUANTILES - 1).bit_length()))])
    found = F.aggregate(steps, F.lit(0), lambda found, step: F.when(
        F.get(q, found + step - 1) <= at, found + step).otherwise(found))
    placed = placed.withColumn("_found", found)
    few = F.floor(F.col("_found") * n / QUANTILES)
    parts = F.ceil(n / QUANTILES)
    lo, hi = F.coalesce(F.get(q, F.col("_found") - 1), "_sketch.lo"), F.coalesce(F.get(q, "_found"), "_sketch.hi")
    step = F.when(hi > lo, F.least(F.floor((at - lo) / (hi - lo) * parts), parts - 1)).otherwise(0)
    chunk = F.when(at.isNull(), F.lit(-1)).when(F.isnan(at), F.greatest(n, QUANTILES * parts)).otherwise(
        F.when(n <= QUANTILES, few).otherwise(F.col("_found") * parts + step))
    return placed.withColumn(CHUNK, chunk.cast("long")).drop("_x", "_sketch", "_found")


def _dedupe(*groups: Sequence[str]) -> list[str]:
    out: list[str] = []
    for g in groups:
        out += [c for c in g if c not in out]
    return out


def neighbors(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str],
              direction: str = "prev", prefix: str | None = None, bounded: bool = False) -> DataFrame:
    """Add ``<prefix><col>`` = value of ``col`` on the previous (``prev``) or
    next (``next``) row of the same key by ``order``; null at the ends.

    ``order`` must be a total order within a key (add tie-breaks) so results
    are deterministic. A frame from ``with_chunks`` keeps its chunk ids.
    """
    keys, order, columns = list(keys), list(order), list(columns)
    prefix = prefix if prefix is not None else f"{direction}_"
    shift = F.lag if direction == "prev" else F.lead
    base_cols = df.columns

    if bounded:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.select("*", *[shift(c).over(w).alias(prefix + c) for c in columns])

    ch = with_chunks(df, keys, order).withColumn(KEY, F.struct(*keys) if keys else F.struct(F.lit(0)))
    w = Window.partitionBy(CHUNK, KEY).orderBy(*order)
    local = ch.select("*", *[shift(c).over(w).alias(prefix + c) for c in columns],
                      shift(F.lit(True)).over(w).isNull().alias("_edge"))

    edge_struct = F.struct(*_dedupe(order, columns))
    summary = local.groupBy(CHUNK, KEY).agg(
        (F.max if direction == "prev" else F.min)(edge_struct).alias("_end"))
    carry = summary.select(CHUNK, KEY, shift("_end").over(Window.partitionBy(KEY).orderBy(CHUNK)).alias("_carry"))

    # on the window's own partitioning keys: the large side is not shuffled again
    joined = local.join(carry, [CHUNK, KEY], "left")
    fixed = [F.when(F.col("_edge"), F.col(f"_carry.{c}")).otherwise(F.col(prefix + c)).alias(prefix + c)
             for c in columns]
    return joined.select(*base_cols, *fixed)


def running_total(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                  alias: str | None = None, bounded: bool = False) -> DataFrame:
    """Add the sum of ``value`` from the key's first row through the current row.

    As for a plain window, nulls are left out and the total is null until the first value.
    """
    keys, order = list(keys), list(order)
    alias = alias or f"running_{value}"
    base_cols = df.columns
    if bounded:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(alias, F.sum(value).over(w))

    ch = with_chunks(df, keys, order).withColumn(KEY, F.struct(*keys) if keys else F.struct(F.lit(0)))
    w = Window.partitionBy(CHUNK, KEY).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ch.withColumn("_local", F.sum(value).over(w))
    totals = local.groupBy(CHUNK, KEY).agg(F.sum(value).alias("_tot"))
    before = Window.partitionBy(KEY).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(CHUNK, KEY, F.sum("_tot").over(before).alias("_offset"))
    joined = local.join(offsets, [CHUNK, KEY], "left")
    zero = F.lit(0).cast(local.schema["_local"].dataType)
    total = F.when(F.col("_local").isNotNull() | F.col("_offset").isNotNull(),
                   F.coalesce("_local", zero) + F.coalesce("_offset", zero))
    return joined.select(*base_cols, total.alias(alias))


def carry_forward(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str],
                  prefix: str = "last_") -> DataFrame:
    """Add ``<prefix><col>`` = the last value of ``col`` that is not null, up to and including the row.

    Chunks carry their last values to the chunks after them, whatever lies between.
    """
    keys, order, columns = list(keys), list(order), list(columns)
    base_cols = df.columns
    ch = with_chunks(df, keys, order).withColumn(KEY, F.struct(*keys) if keys else F.struct(F.lit(0)))
    w = Window.partitionBy(CHUNK, KEY).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ch.select("*", *[F.last(c, ignorenulls=True).over(w).alias(f"_{prefix}{c}") for c in columns])
    ends = local.groupBy(CHUNK, KEY).agg(*[
        F.max(F.when(F.col(c).isNotNull(), F.struct(*order, F.col(c).alias("_v")))).alias(f"_end_{c}") for c in columns])
    earlier = Window.partitionBy(KEY).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(CHUNK, KEY, *[F.last(f"_end_{c}", ignorenulls=True).over(earlier).alias(f"_carry_{c}") for c in columns])
    joined = local.join(carry, [CHUNK, KEY], "left")
    return joined.select(*base_cols, *[F.coalesce(f"_{prefix}{c}", F.col(f"_carry_{c}")["_v"]).alias(prefix + c) for c in columns])


def first_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str],
                   prefix: str = "first_") -> DataFrame:
    """Per key, the values on the first row by ``order`` (partial aggregate)."""
    keys, order, columns = list(keys), list(order), list(columns)
    first = df.groupBy(*keys).agg(F.min(F.struct(*_dedupe(order, columns))).alias("_first"))
    return first.select(*keys, *[F.col(f"_first.{c}").alias(prefix + c) for c in columns])


def attach(df: DataFrame, summary: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join a per-key summary back onto the rows (null-safe on the keys)."""
    keys = list(keys)
    renamed = summary.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    cond = reduce(lambda a, b: a & b, [df[k].eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    out = df.join(renamed, cond, how)
    return out.drop(*[f"_k_{k}" for k in keys])


def transitions(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str],
                bounded: bool = False) -> DataFrame:
    """Previous values of ``columns`` per key (``prev_<col>``)."""
    return neighbors(df, keys, order, columns, "prev", bounded=bounded)


def completed_waits(df: DataFrame, key: str, tick: str, vehicle: str, place: str,
                    out_key: str | None = None, out_wait: str = "wait_time_ticks",
                    bounded: bool = False) -> DataFrame:
    """Waits ended by boarding.

    Over located rows only (``place`` or ``vehicle`` set), ordered by tick per
    key: a row on a vehicle whose previous located row was not on one ends a
    wait of ``tick - previous tick``. One row per completed wait.
    """
    located = df.where(F.col(place).isNotNull() | F.col(vehicle).isNotNull()).select(key, tick, vehicle)
    seq = neighbors(located, [key], [tick], [tick, vehicle], "prev", bounded=bounded)
    done = seq.where(F.col(vehicle).isNotNull() & F.col(f"prev_{vehicle}").isNull()
                     & F.col(f"prev_{tick}").isNotNull())
    return done.select(F.col(key).alias(out_key or key),
                       (F.col(tick) - F.col(f"prev_{tick}")).alias(out_wait))
