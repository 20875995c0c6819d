"""Benchmark passages in training texts, by winnowed k-gram fingerprints.

Fingerprints are hashes of ``k`` consecutive words. Of each run of
``span - k + 1`` neighbouring fingerprints the least is kept, on both sides;
two texts that share ``span`` words keep the same fingerprint inside that
span, so the join of kept fingerprints misses no shared span. Each hit is
extended word by word over at most ``span - k`` words to either side; where
``span`` or more words agree, they are hit. An item with fewer words than
``span`` is one window of all its words; such windows are looked up by the
hash of as many words.

All work on documents is native: one pass makes fingerprints per row, a join
with the item fingerprints (broadcast only if small) finds the few rows that
match, and one small aggregation by row joins spans. Texts are not shuffled.

Defined cases: a null or empty text has no words and is clean. Items without
words match nothing. Equal items all count; an item id that is null hits
words but is not listed. Rows equal in id and text each get a row. Columns
other than those named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import WORD, broadcast_if_small, lower_ascii, settle

#: Words of a fingerprint.
K = 5


def words(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _grams(w: Column, k: int) -> Column:
    """Hashes of the k-grams of ``w``; none if it has fewer words."""
    return F.when(F.size(w) >= k, F.transform(
        F.sequence(F.lit(1), F.size(w) - (k - 1)), lambda i: F.xxhash64(F.lit(k), F.slice(w, i, k)))
    ).otherwise(F.array().cast("array<bigint>"))


def _winnowed(h: Column, width: int) -> Column:
    """Distinct least values of each run of ``width`` hashes (of all, if fewer)."""
    return F.array_distinct(F.when(F.size(h) >= width, F.transform(
        F.sequence(F.lit(1), F.size(h) - (width - 1)), lambda i: F.array_min(F.slice(h, i, width)))).otherwise(h))


def item_fingerprints(items: DataFrame, span: int) -> DataFrame:
    """(hash, k, item_id, body, at): kept fingerprints of items and their place (from 1) in the words ``body``."""
    w = items.select("item_id", words(F.col("text")).alias("body"))
    n = F.size("body")
    long = w.filter(n >= span).withColumn("h", _grams(F.col("body"), K))
    long = long.withColumn("kept", _winnowed(F.col("h"), span - K + 1))
    long = long.select("item_id", "body", F.posexplode("h").alias("p", "hash"), "kept").filter(
        F.array_contains("kept", F.col("hash"))).select("hash", F.lit(K).alias("k"), "item_id", "body", (F.col("p") + 1).alias("at"))
    short = w.filter((n > 0) & (n < span)).select(
        F.xxhash64(n, F.col("body")).alias("hash"), n.alias("k"), "item_id", "body", F.lit(1).alias("at"))
    return long.union(short)


def _agreeing(mine: Column, theirs: Column, a: Column, b: Column, step: int, most: Column) -> Column:
    """How many of at most ``most`` words agree, walking from places a and b in steps of 1 or -1."""
    def ahead(n: Column, i: Column) -> Column:
        x, y = F.get(mine, a - 1 + step * i), F.get(theirs, b - 1 + step * i)
        return F.when((n == i) & (x == y), n + 1).otherwise(n)

    return F.when(most > 0, F.aggregate(F.sequence(F.lit(0), F.greatest(most - 1, F.lit(0))), F.lit(0), ahead)).otherwise(0)


def matches(docs: DataFrame, items: DataFrame, span: int = 10) -> DataFrame:
    """One row per row of ``docs``: (doc_id, text_key, copies, n_words, n_hit, spans, items).

    ``spans`` are disjoint (start, end) word spans that are hit, from 0, end
    exclusive; ``items`` the sorted ids, as strings, of items with an occurring
    window. Rows equal in id and text are one row with their number in ``copies``.
    """
    prints = settle(item_fingerprints(items, span), "item-prints")
    sizes = sorted(r.k for r in prints.select("k").distinct().collect())  # at most ``span`` numbers
    base = docs.select("doc_id", F.md5("text").alias("text_key"), words(F.col("text")).alias("w"))
    base = base.withColumn("n_words", F.size("w"))
    kept = [F.array(F.lit(None).cast("bigint"))]  # one marker row per document
    for k in sizes:
        base = base.withColumn(f"h{k}", _grams(F.col("w"), k))
        kept.append(_winnowed(F.col(f"h{k}"), span - K + 1) if k == K else F.array_distinct(f"h{k}"))
    if K in sizes:  # a short item of K words is looked up by all K-grams
        kept[1 + sizes.index(K)] = F.array_distinct(f"h{K}") if prints.filter(
            (F.col("k") == K) & (F.size("body") < span)).limit(1).count() else kept[1 + sizes.index(K)]
    # explode_outer: for explode Spark derives a filter from the whole expression and evaluates it twice
    rows = base.withColumn("kept", F.concat(*kept)).select(
        "doc_id", "text_key", "n_words", "w", *(f"h{k}" for k in sizes), F.explode_outer("kept").alias("hash"))
    hit = rows.join(broadcast_if_small(prints), "hash", "left").filter("hash is null or k is not null")
    # every place of the fingerprint in the document, then as far as the words agree
    all_grams = F.lit(None).cast("array<bigint>")
    for k in sizes:
        all_grams = F.when(F.col("k") == k, F.col(f"h{k}")).otherwise(all_grams)
    hit = hit.withColumn("grams", all_grams)
    places = F.filter(F.transform("grams", lambda g, i: F.when(g == F.col("hash"), i + 1)), lambda i: i.isNotNull())
    hit = hit.withColumn("place", F.explode_outer(places))
    reach = F.least(F.size("body"), F.lit(span)) - F.col("k")
    same = F.slice("w", F.coalesce("place", F.lit(1)), F.coalesce("k", F.lit(1))) == F.slice(
        "body", F.coalesce("at", F.lit(1)), F.coalesce("k", F.lit(1)))
    hit = hit.withColumn("left", _agreeing(F.col("w"), F.col("body"), F.col("place") - 1, F.col("at") - 1, -1, F.least(
        reach, F.col("place") - 1, F.col("at") - 1)))
    hit = hit.withColumn("right", _agreeing(
        F.col("w"), F.col("body"), F.col("place") + F.col("k"), F.col("at") + F.col("k"), 1, F.least(
            reach, F.col("n_words") - F.col("place") - F.col("k") + 1, F.size("body") - F.col("at") - F.col("k") + 1)))
    good = (F.col("left") + F.col("k") + F.col("right") >= F.least(F.size("body"), F.lit(span))) & same
    start = F.col("place") - 1 - F.col("left")
    hit = hit.select(
        "doc_id", "text_key", "n_words", F.col("hash").isNull().cast("int").alias("marker"),
        F.when(good, F.struct(start.alias("start"), (F.col("place") - 1 + F.col("k") + F.col("right")).alias("end"))).alias("span"),
        F.when(good, F.col("item_id").cast("string")).alias("item")).filter("marker = 1 or span is not null")
    found = hit.groupBy("doc_id", "text_key", "n_words").agg(
        F.sum("marker").alias("copies"), F.collect_set("span").alias("found"), F.array_sort(F.collect_set("item")).alias("items"))
    empty = F.array().cast("array<struct<start:int,end:int>>")
    joined = F.aggregate(F.array_sort("found"), empty, lambda done, s: F.when(
        (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= s["start"]),
        F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
            F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"))))
    ).otherwise(F.concat(done, F.array(s))))
    return found.withColumn("spans", joined).select(
        "doc_id", "text_key", "copies", F.col("n_words").cast("long").alias("n_words"),
        F.aggregate("spans", F.lit(0).cast("long"), lambda t, s: t + s["end"] - s["start"]).alias("n_hit"), "spans", "items")


def clean_documents(docs: DataFrame, items: DataFrame, span: int = 10) -> DataFrame:
    """The rows of ``docs`` in which no item window occurs, with all their columns."""
    dirty = settle(matches(docs, items, span).filter("n_hit > 0").select(
        F.col("doc_id").alias("m_id"), F.col("text_key").alias("m_key")), "contaminated")
    rows = docs.select(F.struct("*").alias("row"), F.md5("text").alias("key")).join(
        broadcast_if_small(dirty), F.col("row.doc_id").eqNullSafe(F.col("m_id")) & (F.col("key") == F.col("m_key")), "left_anti")
    return rows.select("row.*")
