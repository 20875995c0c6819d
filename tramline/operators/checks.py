"""Data-quality and integrity checks as joins.

Every check returns violating rows in one shape -- ``check_id, severity,
table_name, column_name, entity`` (plus check-specific columns) -- so a suite
is a ``unionByName`` and all failures are seen at once. Nothing is collected;
``raise_on_violation`` is the only action, and it asks for one row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.operators.sequence import neighbors

CHECK_COLUMNS = ["check_id", "severity", "table_name", "column_name", "entity"]


def _entity(cols: Sequence[str]) -> Column:
    parts = [F.col(c).cast("string") for c in cols]
    return parts[0] if len(parts) == 1 else F.concat_ws(",", *parts)


def frame(df: DataFrame, check_id: str, table: str, column: str, entity: Column, severity: str = "error",
          extra: Sequence[Column] = ()) -> DataFrame:
    """Shape violating rows into the common check frame."""
    return df.select(F.lit(check_id).alias("check_id"), F.lit(severity).alias("severity"),
                     F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
                     entity.alias("entity"), *extra)


def not_null(df: DataFrame, table: str, columns: Sequence[str], entity: Sequence[str],
             severity: str = "error") -> DataFrame:
    """One row per (row, column) where the column is null."""
    frames = [frame(df.where(F.col(c).isNull()), "not_null", table, c, _entity(entity), severity)
              for c in columns]
    return reduce(DataFrame.unionByName, frames)


def unique(df: DataFrame, table: str, columns: Sequence[str], entity_expr: Column | None = None,
           severity: str = "error") -> DataFrame:
    """Key values occurring more than once (rows with a null key part excluded).

    A grouped count: partial aggregation before the shuffle, so a hot key
    costs one row per task.
    """
    cols = list(columns)
    present = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))
    ent = entity_expr if entity_expr is not None else _entity(cols)
    counted = present.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    dup = counted.where(F.col("n") > 1)
    check_id = "unique" if len(cols) == 1 else "unique_combination"
    return frame(dup, check_id, table, ",".join(cols), ent, severity, [F.col("n")])


def declared_tests(df: DataFrame, tests: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(table_name, test, column_name, failures) of all ``tests`` on one frame, in one pass over it.

    A test is (table name, ``not_null`` | ``unique`` | ``unique_combination``,
    column or comma-separated columns). Failures are null rows of a
    ``not_null``, and values (or combinations, nulls being values there) that
    occur more than once. Each row yields one key per uniqueness test and one
    for every null that a ``not_null`` forbids; keys are counted with a partial
    aggregate, so a clean ``not_null`` moves nothing and a hot key one row a
    task. Every test has a row, whatever the frame holds.
    """
    entries = []
    for i, (_, kind, columns) in enumerate(tests):
        cols = [F.col(c) for c in columns.split(",")]
        key = F.to_json(F.struct(*[c.alias(f"c{k}") for k, c in enumerate(cols)]))
        entry = F.struct(F.lit(i).alias("i"), (F.lit("") if kind == "not_null" else key).alias("key"))
        when = {"not_null": cols[0].isNull(), "unique": cols[0].isNotNull(), "unique_combination": F.lit(True)}[kind]
        entries.append(F.when(when, entry))
    each = df.select(F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e")).select("e.i", "e.key")
    counted = each.groupBy("i", "key").agg(F.count(F.lit(1)).alias("n"))
    failed = counted.groupBy("i").agg(F.sum(F.when(F.col("key") == "", F.col("n")).when(F.col("n") > 1, 1).otherwise(0)).alias("failures"))
    declared = df.sparkSession.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(t).alias("table_name"), F.lit(k).alias("test"), F.lit(c).alias("column_name"))
        for i, (t, k, c) in enumerate(tests)])).alias("t")).select("t.*")
    return declared.join(failed, "i", "left").select(
        "table_name", "test", "column_name", F.coalesce("failures", F.lit(0)).cast("long").alias("failures"))


def missing(left: DataFrame, right: DataFrame, on: Sequence[str] | Column, check_id: str, table: str,
            entity: Sequence[str], column: str = "", severity: str = "error") -> DataFrame:
    """Rows of ``left`` without a match in ``right`` (anti join)."""
    orphans = left.join(right, on, "left_anti")
    return frame(orphans, check_id, table, column or ",".join(entity), _entity(entity), severity)


def is_empty(df: DataFrame, check_id: str, table: str) -> DataFrame:
    """One row when ``df`` has no rows (a one-row aggregate, no collect)."""
    counted = df.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == 0)
    return frame(counted, check_id, table, "", F.lit(table))


def asymmetric_edges(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """Distinct edges ``a -> b`` whose reverse ``b -> a`` is absent.

    One aggregation over unordered pairs, with a flag for each direction; the
    edges are read once. Loops are their own reverse; edges with a null end
    have no reverse.
    """
    a, b = F.col(src), F.col(dst)
    forward = F.when(a.isNull() | b.isNull(), a.isNotNull()).otherwise(a <= b)
    pairs = edges.groupBy(F.least(a, b).alias("_lo"), F.greatest(a, b).alias("_hi"),
                          F.when(a.isNull() | b.isNull(), forward).alias("_null_side")).agg(
        F.max(forward).alias("_f"), F.max(a >= b).alias("_b"))
    one = pairs.where(F.col("_null_side").isNotNull() | (F.col("_f") != F.col("_b")))
    known = F.col("_null_side").isNull()
    return one.select(
        F.when(known, F.when(F.col("_f"), F.col("_lo")).otherwise(F.col("_hi")))
        .when(F.col("_null_side"), F.col("_lo")).alias(src),
        F.when(known, F.when(F.col("_f"), F.col("_hi")).otherwise(F.col("_lo")))
        .when(~F.col("_null_side"), F.col("_lo")).alias(dst))


def invalid_transitions(df: DataFrame, keys: Sequence[str], order: Sequence[str], state: str,
                        cycle: Sequence[str], entity: Sequence[str], bounded: bool = False) -> DataFrame:
    """Consecutive states per key that are neither equal nor the cycle successor.

    States outside the cycle have no successor, so any change from them is
    reported. Adds ``prev_type`` (previous state) to the check frame.
    """
    seq = neighbors(df, keys, order, [state], "prev", prefix="_prev_", bounded=bounded)
    succ = F.create_map(*[F.lit(x) for i in range(len(cycle)) for x in (cycle[i], cycle[(i + 1) % len(cycle)])])
    prev = F.col(f"_prev_{state}")
    bad = seq.where(prev.isNotNull() & (prev != F.col(state))
                    & (F.coalesce(succ[prev], F.lit("")) != F.col(state)))
    return frame(bad, "invalid_transition", "", state, _entity(entity),
                  extra=[*[F.col(c) for c in entity], prev.alias("prev_type"), F.col(state)])


def prefix_violations(steps: DataFrame, templates: DataFrame, key: str, route: str, pos: str,
                      value: str) -> DataFrame:
    """Per key, positions where the step sequence leaves its route template.

    ``steps`` has one row per (key, pos) with the route chosen for the key;
    ``templates`` one row per (route, pos). A step is bad when the template has
    no such position (history longer than the route) or a different value.
    """
    t = templates.select(F.col(route).alias("_t_route"), F.col(pos).alias("_t_pos"), F.col(value).alias("_t_val"))
    j = steps.join(t, (F.col(route) == F.col("_t_route")) & (F.col(pos) == F.col("_t_pos")), "left")
    bad = j.where(F.col("_t_val").isNull() | (F.col("_t_val") != F.col(value)))
    return bad.groupBy(key).agg(F.min(pos).alias("first_bad_turn"), F.count(F.lit(1)).alias("n_bad"))


def disagreement(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that the two sides do not have equally often, labelled by the side lacking them.

    Counts are compared, so a key listed twice on one side and once on the
    other is found; nulls are keys like others.
    """
    both = a.select(*keys, F.lit(1).alias("_a"), F.lit(0).alias("_b")).union(
        b.select(*keys, F.lit(0).alias("_a"), F.lit(1).alias("_b")))
    return _sides(both.groupBy(*keys).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b")), keys)


def flag_disagreement(df: DataFrame, keys: Sequence[str], in_a, in_b) -> DataFrame:
    """``disagreement`` of the distinct keys of two filters on one table, in one pass."""
    return _sides(df.groupBy(*keys).agg(F.max(F.coalesce(in_a, F.lit(False)).cast("int")).alias("_a"),
                                        F.max(F.coalesce(in_b, F.lit(False)).cast("int")).alias("_b")), keys)


def _sides(counted: DataFrame, keys: Sequence[str]) -> DataFrame:
    return counted.where("_a <> _b").select(*keys, F.when(F.col("_a") < F.col("_b"), F.lit("missing_in_a"))
                                            .otherwise(F.lit("missing_in_b")).alias("side"))


def suite(*frames: DataFrame) -> DataFrame:
    """Union check frames on the common columns."""
    return reduce(DataFrame.unionByName, [f.select(*CHECK_COLUMNS) for f in frames])


def raise_on_violation(violations: DataFrame) -> None:
    """Fail fast: raise with the first violation if there is any."""
    first = violations.take(1)
    if first:
        raise ValueError(f"integrity check failed: {first[0].asDict()}")
