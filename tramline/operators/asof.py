"""As-of lookups without range joins.

``as_of_merge`` merges rows and probes into one ordered sequence and carries
the last row along it, so neither side is broadcast, both may grow, and a hot
key is cut into chunks like any sequence. ``latest_at_probes`` asks all keys
for the same times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.operators.sequence import carry_forward, neighbors
from tramline.operators.state import latest_by_key


def as_of_merge(probes: DataFrame, rows: DataFrame, keys: Sequence[str], probe_time: str, row_time: str,
                row_order: Sequence[str], columns: Sequence[str], prefix: str = "asof_", strict: bool = False) -> DataFrame:
    """Each probe with ``columns`` of the last row of its key at or before its time (``strict``: before it).

    Rows at one time are ordered by ``row_order``. A probe without such a row,
    with a null time, or with a key that has no rows gets nulls; null keys are
    keys like others. Every probe comes out once. Probe columns keep their names.
    """
    keys, row_order, columns = list(keys), list(row_order), list(columns)
    times = {probes.schema[probe_time].dataType, rows.schema[row_time].dataType}
    if len(times) > 1:
        raise TypeError(f"probe and row times differ in type: {times}")
    order = [f"_o{i}" for i in range(len(row_order))]
    state = F.struct(*[F.col(c).alias(c) for c in columns])
    row_side, probe_side = (1, 0) if strict else (0, 1)
    # the probe as a struct, so its columns cannot clash with the merge's own
    a = rows.where(F.col(row_time).isNotNull()).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(row_time).alias("_t"), F.lit(row_side).alias("_side"),
        *[F.col(c).alias(o) for c, o in zip(row_order, order, strict=True)], state.alias("_state"))
    b = probes.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(probe_time).alias("_t"),
                      F.lit(probe_side).alias("_side"), F.struct(*probes.columns).alias("_probe"))
    merged = a.unionByName(b, allowMissingColumns=True)
    carried = carry_forward(merged, [f"_k{i}" for i in range(len(keys))], ["_t", "_side", *order], ["_state"], "_last")
    found = carried.where("_probe is not null")
    known = F.when(F.col("_t").isNotNull(), F.col("_last_state"))
    return found.select("_probe.*", *[known[c].alias(prefix + c) for c in columns])


def latest_at_probes(rows: DataFrame, probes: DataFrame, key: str, time: str, probe: str,
                     tiebreak: Sequence[str]) -> DataFrame:
    """Per key and probe time, the latest row with ``time <= probe`` (none: no row): key, probe, time, tiebreak.

    The result has up to a row for every key and probe, so the list of distinct
    probes is small beside it: it comes as a sorted array, in one scalar
    subquery. (For probes of their own keys, however many, use ``as_of_merge``.)

    1. a row's place is the first probe at or after it, by binary search; of a
       key's rows at one place the latest stays, as a partial aggregate;
    2. a row that stays answers the probes from its place until the next place
       of its key: an explode of that run, no join.
    """
    tiebreak = list(tiebreak)
    distinct = probes.select(F.col(probe).alias("_t")).where("_t is not null").distinct()
    listed = distinct.agg(F.array_sort(F.collect_list("_t"))).scalar()
    kept = rows.select(key, time, *tiebreak).where(F.col(time).isNotNull()).withColumn("_probes", listed)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(31))])
    before = F.aggregate(steps, F.lit(0), lambda n, step: F.when(
        (step <= F.size("_probes") - n) & (F.get("_probes", n + step - 1) < F.col(time)), n + step).otherwise(n))
    placed = kept.withColumn("_place", before).where(F.col("_place") < F.size("_probes"))
    winners = latest_by_key(placed.drop("_probes"), [key, "_place"], [time, *tiebreak], [time, *tiebreak])
    # a key has a winner for each place at most
    until = neighbors(winners, [key], ["_place"], ["_place"], "next", prefix="_next", bounded=True).withColumn("_probes", listed)
    run = F.slice("_probes", F.col("_place") + 1, F.coalesce("_next_place", F.size("_probes")) - F.col("_place"))
    return until.withColumn(probe, F.explode(run)).select(key, probe, time, *tiebreak)
