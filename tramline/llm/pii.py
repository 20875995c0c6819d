"""Personal data in texts: formats as seeds, and contexts learnt from them.

Seeds are the entities found by format (mail and IP addresses, card numbers by
Luhn's rule, phone numbers). Each mention of a seed, and of any other token
that looks like an identifier, has lexical patterns: the word, and the two
words, before it. Patterns and instances (the distinct strings) form a
bipartite graph. In each round a pattern's confidence is the mean score of its
instances, smoothed and given enough support, and an unseen instance's score is
the chance that one of its confident patterns is right (noisy or). Instances
with a high score are found identifiers and support further patterns, beside
the seeds, by their scores. When nothing is added any more, their mentions
after a confident pattern are added, as kind ``context``.

All work is native. Texts are scanned once; mentions without texts are
settled, and the rounds run over distinct (pattern, instance) edges with
partial aggregates on either side.

Defined cases: null and empty texts hold nothing. Rows equal in text have
equal results, each row its own; their mentions count once in the graph.
Without seeds no pattern is confident. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import broadcast_if_small, lower_ascii, settle
from tramline.llm.spans import SPAN, blocks, joined, let, outside, piece, with_spans

KINDS = ["email", "ip", "card", "phone", "context"]
# Possessive repeats and the look-behinds only spare vain attempts: a match
# can start where its run starts or where the match before it ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){11,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Other tokens that look like identifiers: up to four letters, then a digit and more.
IDENTIFIER = r"(?<![A-Za-z0-9@.+_-])[A-Za-z]{0,4}-?[0-9][A-Za-z0-9_/-]{4,}"
#: Seeds, or found instances by their scores, that a pattern needs, the smoothing of its mean, and the least confidence that counts.
LEAST_SEEDS, SMOOTHING, CONFIDENT = 5, 2.0, 0.5
#: Least score of a found instance.
FOUND = 0.6

_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def _ip(m: Column) -> Column:
    return m.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")


def _card(m: Column) -> Column:
    def luhn(d: Column) -> Column:
        n = F.char_length(d)

        def add(total: Column, i: Column) -> Column:
            v = F.substring(d, n - i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
            return total + F.when(v > 9, v - 9).otherwise(v)

        return F.when((n >= 12) & (n <= 19), F.aggregate(
            F.sequence(F.lit(0), F.least(n, F.lit(19)) - 1), F.lit(0), add) % 10 == 0).otherwise(False)

    return let(F.translate(m, " -", ""), luhn)


def _phone(m: Column) -> Column:
    return F.length(F.regexp_replace(m, "[^0-9]", "")).between(9, 15)


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, base, others): spans found by format and other identifiers; others carry ``before``."""
    df = docs.select("doc_id", F.md5("text").alias("text_key"), F.coalesce("text", F.lit("")).alias("_text"))
    df = with_spans(df, "_email", "_text", "email", EMAIL)
    df = with_spans(df, "_ip", "_text", "ip", IP, _ip)
    df = with_spans(df, "_card", "_text", "card", CARD, _card)
    df = with_spans(df, "_phone", "_text", "phone", PHONE, _phone)
    df = with_spans(df, "_other", "_text", "context", IDENTIFIER)
    df = df.withColumn("_base", F.concat("_email", "_ip", "_card", "_phone"))
    free = outside(F.col("_other"), F.col("_base"))

    def in_context(cut: Column) -> Column:
        def before(s: Column) -> Column:
            return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["match"].alias("match"),
                            piece(cut, F.greatest(s["start"] - 48, F.lit(0)), s["start"]).alias("before"))

        return F.struct(F.transform("_base", before).alias("base"), F.transform("_free", before).alias("others"))

    df = df.withColumn("_free", free)
    cut = F.when(F.size("_base") + F.size("_free") > 0, blocks(F.col("_text")))
    return df.select("doc_id", "text_key", let(cut, in_context).alias("s")).select("doc_id", "text_key", "s.base", "s.others")


def mentions(scanned: DataFrame) -> DataFrame:
    """(text_key, seed, start, end, instance, pattern): a row for each pattern of each mention, equal texts once."""
    each = scanned.filter(F.size("base") + F.size("others") > 0).groupBy("text_key").agg(
        F.first("base").alias("base"), F.first("others").alias("others"))
    rows = each.select("text_key", F.explode(F.concat("base", "others")).alias("s"))
    words = F.regexp_extract_all(lower_ascii(F.col("s.before")), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+|[:=#]"), F.lit(0))
    rows = rows.select("text_key", (F.col("s.kind") != "context").alias("seed"), "s.start", "s.end",
                       lower_ascii(F.col("s.match")).alias("instance"), words.alias("w"))
    last = F.element_at("w", -1)
    patterns = F.when(F.size("w") >= 2, F.array(last, F.concat_ws(" ", F.element_at("w", -2), last))).when(
        F.size("w") == 1, F.array(last)).otherwise(F.array().cast("array<string>"))
    return rows.select("text_key", "seed", "start", "end", "instance", F.explode(patterns).alias("pattern"))


def bootstrap(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Confident patterns (pattern, confidence) and found instances (instance, score) of the graph.

    A pattern's support is the sum of the scores of its seeds and its found
    instances. A confident pattern stays, with its greatest confidence, so scores
    only grow; the rounds end when no pattern and no found instance is added.
    """
    edges = settle(rows.groupBy("pattern", "instance").agg(F.max(F.col("seed").cast("int")).alias("seed")), "edges")
    scores = edges.groupBy("instance").agg(F.max("seed").cast("double").alias("score"), (F.max("seed") == 1).alias("known"))
    scores = settle(scores, "scores")
    confident, size = None, None
    while True:
        found = F.col("known") | (F.col("score") >= FOUND)
        new = edges.join(scores, "instance").groupBy("pattern").agg(
            F.sum("score").alias("weight"), F.count("*").alias("n"), F.sum(F.when(found, F.col("score")).otherwise(0.0)).alias("support"))
        new = new.withColumn("confidence", F.col("weight") / (F.col("n") + SMOOTHING)).filter(
            (F.col("support") >= LEAST_SEEDS - 1e-9) & (F.col("confidence") >= CONFIDENT)).select("pattern", "confidence")
        if confident is not None:
            new = new.union(confident).groupBy("pattern").agg(F.max("confidence").alias("confidence"))
        confident = settle(new, "patterns")
        reached = edges.filter("seed = 0").join(confident, "pattern").groupBy("instance").agg(
            (1 - F.exp(F.sum(F.log(1 - F.least("confidence", F.lit(0.999)))))).alias("reached"))
        scores = settle(scores.join(reached, "instance", "left").select(
            "instance", F.when(F.col("known"), 1.0).otherwise(F.coalesce("reached", F.lit(0.0))).alias("score"), "known"), "scores")
        reached = scores.filter(~F.col("known") & (F.col("score") >= FOUND)).select("instance", "score")
        before, size = size, (confident.count(), reached.count())
        if size == before:
            return confident, reached


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: (doc_id, text_key, base, added), arrays of spans with their matches."""
    scanned = settle(scan(docs), "pii-scan")
    rows = settle(mentions(scanned), "mentions")
    patterns, found = bootstrap(rows)
    added = rows.filter(~F.col("seed")).join(patterns, "pattern").join(found, "instance").groupBy("text_key").agg(
        F.collect_set(F.struct("start", "end", "instance")).alias("added"))
    added = broadcast_if_small(settle(added, "pii-added"))

    def plain(spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(
            s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["match"].alias("match"))).cast(f"array<{SPAN}>")

    new = F.transform("added", lambda s: F.struct(
        F.lit("context").alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["instance"].alias("match")))
    return scanned.join(added, "text_key", "left").select(
        "doc_id", "text_key", plain(F.col("base")).alias("base"),
        F.coalesce(new.cast(f"array<{SPAN}>"), F.array().cast(f"array<{SPAN}>")).alias("added"))


def span_list(spans: Column) -> Column:
    return joined(spans, KINDS)
