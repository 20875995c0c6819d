"""Spans of pattern matches in texts, with built-in functions only.

A span is a struct (kind, start, end, match): code points from the start of
the text, end exclusive. Spark returns matches without their places; the
places follow from the pieces between matches, so a text is cut at its
matches and the lengths of pieces and matches are summed up.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = "struct<kind:string,start:int,end:int,match:string>"
_CHUNK = 256
_BLOCK = 512


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def running(values: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    """``step`` accumulated over an array<int>, a value for each element; built in chunks, so long arrays stay cheap."""
    empty = F.array().cast("array<int>")

    def over(v: Column) -> Column:
        def inside(base: Column, c: Column) -> Column:
            return F.aggregate(F.slice(v, c * _CHUNK + 1, _CHUNK), F.struct(base.alias("t"), empty.alias("out")), lambda z, x: let(
                step(z["t"], x), lambda t: F.struct(t.alias("t"), F.concat(z["out"], F.array(t)).alias("out"))))

        chunks = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / _CHUNK).cast("int"))
        outer = F.aggregate(
            chunks, F.struct(start.alias("t"), F.array().cast("array<array<int>>").alias("out")),
            lambda acc, c: let(inside(acc["t"], c), lambda z: F.struct(
                z["t"].alias("t"), F.concat(acc["out"], F.array(z["out"])).alias("out"))))
        return F.when(F.size(v) > 0, F.flatten(outer["out"])).otherwise(empty)

    return let(values, over)


def prefix_sums(values: Column) -> Column:
    """Running totals of an array<int>."""
    return running(values, F.lit(0), lambda t, x: t + x)


def count_below(ascending: Column, bound: Column) -> Column:
    """How many elements of an ascending array are less than ``bound``, by binary search."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(30))])
    return F.aggregate(steps, F.lit(0), lambda n, step: F.when(
        (step <= F.size(ascending) - n) & (F.get(ascending, n + step - 1) < bound), n + step).otherwise(n))


def outside(spans: Column, others: Column) -> Column:
    """The ``spans`` that overlap none of ``others``: one sort and a binary search for each.

    Of the others that start before a span's end, the one that reaches farthest decides.
    """
    ordered = F.array_sort(F.transform(others, lambda o: F.struct(o["start"].alias("a"), o["end"].alias("b"))))
    parts = let(ordered, lambda o: F.struct(
        F.transform(o, lambda x: x["a"]).alias("a"), running(F.transform(o, lambda x: x["b"]), F.lit(0), F.greatest).alias("b")))
    return F.when(F.size(others) == 0, spans).otherwise(let(parts, lambda p: F.filter(spans, lambda s: F.coalesce(
        F.get(p["b"], count_below(p["a"], s["end"]) - 1) <= s["start"], F.lit(True)))))


def blocks(text: Column) -> Column:
    """The text as an array of pieces of _BLOCK code points (the last may be shorter), for ``piece``."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_BLOCK}}}"), F.lit(0))


def piece(cut: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` (exclusive) of a text cut by ``blocks``; costs the piece's length, not its place."""
    first = F.floor(start / _BLOCK).cast("int")
    count = F.floor((end - 1) / _BLOCK).cast("int") - first + 1
    inner = F.substring(F.concat_ws("", F.slice(cut, first + 1, count)), start - first * _BLOCK + 1, end - start)
    return F.when(end > start, inner).otherwise("")


def with_spans(df: DataFrame, column: str, text: str, kind: str, pattern: str,
               valid: Callable[[Column], Column] | None = None) -> DataFrame:
    """Add ``column``: the array of spans of ``pattern`` in ``text``, leftmost and not overlapping.

    Matches for which ``valid`` does not hold are dropped. Columns that start
    with ``_`` are used on the way. Texts without a match cost one search, others
    time in proportion to their length: the text is cut once, bound by ``let``,
    as an expression inside a lambda would be computed for each match.
    """
    has = F.col(text).rlike(pattern)
    df = df.withColumn("_hits", F.when(has, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))))
    hits = F.col("_hits")
    gaps = F.when(hits.isNotNull(), F.transform(F.split(text, pattern, -1), F.char_length))
    # each match starts after all pieces up to it and all matches before it
    steps = let(gaps, lambda g: F.transform(hits, lambda m, i: F.get(g, i) + F.when(i > 0, F.char_length(F.get(hits, i - 1))).otherwise(0)))
    spans = let(prefix_sums(steps), lambda starts: F.transform(hits, lambda m, i: F.struct(
        F.lit(kind).alias("kind"), F.get(starts, i).alias("start"),
        (F.get(starts, i) + F.char_length(m)).alias("end"), m.alias("match"))))
    if valid is not None:
        spans = F.filter(spans, lambda s: valid(s["match"]))
    spans = F.when(hits.isNotNull(), spans).otherwise(F.array().cast(f"array<{SPAN}>"))
    return df.withColumn(column, spans.cast(f"array<{SPAN}>")).drop("_hits")


def joined(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` of all spans by start, then kind in the order given, comma-joined."""

    def order(s: Column) -> Column:
        out = F.lit(len(kinds))
        for i, k in enumerate(kinds):
            out = F.when(s["kind"] == k, i).otherwise(out)
        return out

    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("a"), order(s).alias("b"), s["end"].alias("c"), s["kind"].alias("d"))))
    return F.concat_ws(",", F.transform(keyed, lambda s: F.concat_ws(
        ":", s["d"], s["a"].cast("string"), s["c"].cast("string"))))


def redacted(text: Column, spans: Column, mark: str) -> Column:
    """``text`` with the union of ``spans`` replaced by ``mark``."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("a"), s["end"].alias("b"))))
    known = let(ordered, lambda cuts: F.struct(
        cuts.alias("cuts"), running(F.transform(cuts, lambda s: s["b"]), F.lit(0), F.greatest).alias("upto"), blocks(text).alias("blocks")))

    def out(k: Column) -> Column:
        # what lies between the end of all cuts before and this cut, and the mark; a cut that overlaps an earlier one adds nothing
        at = lambda i: F.coalesce(F.get(k["upto"], i - 1), F.lit(0))
        kept = F.transform(k["cuts"], lambda s, i: F.when(s["a"] >= at(i), F.concat(piece(k["blocks"], at(i), s["a"]), F.lit(mark))).otherwise(""))
        return F.concat(F.concat_ws("", kept), piece(k["blocks"], at(F.size(k["cuts"])), F.char_length(text)))

    return let(known, out)
