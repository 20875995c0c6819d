"""Secrets in texts: fixed formats, and a randomness test battery for the rest.

The base finds assignments, access keys and hex strings by pattern. The method
takes every other long run of key characters and infers its encoding, the
smallest alphabet that holds it. Three tests ask whether its symbols are drawn
at random from that alphabet: chi-squared uniformity (exact mean and variance
of the statistic), runs above and below the alphabet's middle, and lag-one
serial correlation; Fisher's rule joins their p-values. A token that the
battery does not reject is a candidate.

Candidates are then held against plain words: the letter frequencies of all
long plain words of the corpus give the chi-squared value that such text would
show at this length and alphabet, and so the chance that plain text looks as
uniform. The chance falls with length. Benjamini-Hochberg cuts off these
p-values in bands of length, on distinct tokens, from a histogram of at most a
few thousand cells, so a few false alarms in a hundred findings are expected
in each band, short or long.

Everything is native. Texts are scanned once and never shuffled for the scan;
the scan's result (ids, spans, tokens) is settled without texts.

Defined cases: null and empty texts have no spans. Rows equal in text have
equal results; each row keeps its own. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import broadcast_if_small, settle
from tramline.llm.spans import SPAN, joined, let, outside, redacted, with_spans

KINDS = ["assign", "access", "hex", "random"]


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
_HEAD = rf"({_NAMES})[\x22']?\x20*[:=]\x20*[\x22']?"
ASSIGN = rf"{_HEAD}([A-Za-z0-9+/_.=-]+)"
#: Formats of 18 and 16 characters or more; shorter runs cannot match, so the pattern says so.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
#: What the battery looks at, and what it leaves out: base matches are spans already.
TOKEN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
PLAIN = r"[A-Za-z]{10,}"
#: Encodings from small to large: name, symbols in order. Fixed values.
ALPHABETS = {
    "decimal": "0123456789",
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "alnum_lower": "abcdefghijklmnopqrstuvwxyz0123456789",
    "alnum_upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
    "alnum": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
    "any": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_",
}
#: Tokens that the battery rejects at this level are not random.
BATTERY_LEVEL = 0.01
#: Expected share of false findings in a band.
FALSE_SHARE = 0.01
#: Histogram cells for each tenfold p-value, and the last cell.
CELLS, LAST_CELL = 10, 400


def _upper_tail(z: Column) -> Column:
    """The chance that a standard normal value exceeds z (logistic form, error below 2e-4)."""
    z = F.least(F.greatest(z, F.lit(-30.0)), F.lit(30.0))
    return 1 / (1 + F.exp(1.5976 * z + 0.070565992 * z * z * z))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, base, tokens): spans of the fixed formats and of all long runs, per row."""
    df = docs.select("doc_id", F.md5("text").alias("text_key"), F.coalesce("text", F.lit("")).alias("_text"))
    df = with_spans(df, "_assign", "_text", "assign", ASSIGN, lambda m: F.char_length(F.regexp_extract(m, f"^{ASSIGN}", 2)) >= 12)
    df = with_spans(df, "_access", "_text", "access", ACCESS)
    df = with_spans(df, "_hex", "_text", "hex", HEX)
    df = with_spans(df, "_token", "_text", "random", TOKEN)
    base = F.concat("_assign", "_access", "_hex")
    df = df.withColumn("_base", base)
    free = outside(F.col("_token"), F.col("_base"))
    return df.select("doc_id", "text_key", F.col("_base").alias("base"), free.alias("tokens"))


def plain_letters(docs: DataFrame) -> dict[str, float]:
    """Frequencies of letters in the long plain words of all texts (52 counts come to the driver)."""
    letters = docs.select(F.explode_outer(F.regexp_extract_all("text", F.lit(PLAIN), F.lit(0))).alias("w"))
    rows = letters.select(F.explode_outer(F.split("w", "")).alias("c")).filter("c <> ''").groupBy("c").count().collect()
    total = sum(r["count"] for r in rows)
    return {r["c"]: r["count"] / total for r in rows}


def battery(tokens: DataFrame, plain: dict[str, float]) -> DataFrame:
    """(token, encoding, n, p_random, p_plain) of distinct ``tokens``: the battery and the plain-text chance.

    ``p_plain`` is 1 where plain words do not use the alphabet.
    """
    t = tokens.select("token").withColumn("body", F.regexp_replace("token", "=+$", "")).withColumn("n", F.char_length("body"))
    name, symbols = F.lit("any"), F.lit(ALPHABETS["any"])
    shift, spread, used = F.lit(0.0), F.lit(0.0), F.lit(False)
    for k, alphabet in reversed(ALPHABETS.items()):
        fits = F.length(F.translate("body", alphabet, "")) == 0
        share = [plain.get(c, 0.0) for c in alphabet]
        total = sum(share)
        q = [x / total for x in share] if total else []
        m = len(alphabet)
        q2, q3 = sum(x * x for x in q), sum(x ** 3 for x in q)
        name, symbols = F.when(fits, k).otherwise(name), F.when(fits, alphabet).otherwise(symbols)
        shift = F.when(fits, m * q2 - 1).otherwise(shift)
        spread = F.when(fits, 4.0 * m * m * max(0.0, q3 - q2 * q2)).otherwise(spread)
        used = F.when(fits, bool(q) and m * q2 > 1).otherwise(used)
    t = t.withColumn("encoding", name).withColumn("symbols", symbols)
    t = t.withColumn("shift", shift).withColumn("spread", spread).withColumn("used", used)
    t = t.withColumn("m", F.length("symbols").cast("double"))
    t = t.withColumn("code", F.transform(F.filter(F.split("body", ""), lambda c: c != ""),
                                         lambda c: F.call_function("locate", c, F.col("symbols")).cast("double") - 1))
    n = F.col("n").cast("double")
    zero = F.lit(0.0)
    squares = F.aggregate(F.array_distinct("code"), zero, lambda s, c: s + F.pow(F.size(F.filter("code", lambda x: x == c)), F.lit(2.0)))
    t = t.withColumn("chi", squares * F.col("m") / n - n)
    base_var = 2 * (F.col("m") - 1) * (n - 1) / n
    t = t.withColumn("z1", (F.col("chi") - (F.col("m") - 1)) / F.sqrt(base_var))
    high = F.aggregate("code", zero, lambda s, c: s + F.when(c * 2 >= F.col("m"), 1.0).otherwise(0.0))
    t = t.withColumn("high", high).withColumn("mean", F.aggregate("code", zero, lambda s, c: s + c) / n)
    turns = F.aggregate("code", F.struct(F.lit(-1).alias("side"), zero.alias("runs")), lambda z, c: let(
        F.when(c * 2 >= F.col("m"), 1).otherwise(0), lambda side: F.struct(
            side.alias("side"), (z["runs"] + F.when(side == z["side"], 0.0).otherwise(1.0)).alias("runs"))))
    serial = F.aggregate("code", F.struct(F.lit(None).cast("double").alias("last"), zero.alias("xy"), zero.alias("xx")), lambda z, c: F.struct(
        c.alias("last"), (z["xy"] + F.coalesce((z["last"] - F.col("mean")) * (c - F.col("mean")), zero)).alias("xy"),
        (z["xx"] + (c - F.col("mean")) * (c - F.col("mean"))).alias("xx")))
    t = t.withColumn("runs", turns["runs"]).withColumn("serial", serial)
    ab = 2 * F.col("high") * (n - F.col("high"))
    var = ab * (ab - n) / (n * n * (n - 1))
    t = t.withColumn("z2", F.when(var > 0, (F.col("runs") - ab / n - 1) / F.sqrt(F.when(var > 0, var))).otherwise(30.0))
    r = F.when(F.col("serial.xx") > 0, F.col("serial.xy") / F.when(F.col("serial.xx") > 0, F.col("serial.xx"))).otherwise(1.0)
    t = t.withColumn("z3", (r + 1 / n) * F.sqrt(n))
    x = F.lit(0.0)
    for z in ("z1", "z2", "z3"):
        x = x - 2 * F.log(F.greatest(2 * _upper_tail(F.abs(F.col(z))), F.lit(1e-30)))
    t = t.withColumn("fisher", x)
    p_random = F.exp(-F.col("fisher") / 2) * (1 + F.col("fisher") / 2 + F.pow("fisher", F.lit(2.0)) / 8)
    plain_z = (F.col("chi") - (F.col("m") - 1) - (n - 1) * F.col("shift")) / F.sqrt(base_var + n * F.col("spread"))
    return t.select("token", "encoding", "n", p_random.alias("p_random"),
                    F.when(F.col("used"), _upper_tail(-plain_z)).otherwise(1.0).alias("p_plain"))


def significant(tested: DataFrame) -> DataFrame:
    """The tokens that pass the battery and the false-discovery cut of their band of length."""
    cell = F.least(F.floor(-F.log10(F.greatest("p_plain", F.lit(1e-60))) * CELLS), F.lit(LAST_CELL)).cast("int")
    t = tested.withColumn("band", F.floor(F.log2(F.col("n") / 20) * 2).cast("int")).withColumn("cell", cell)
    cells = t.groupBy("band", "cell").agg(F.count("*").alias("c"))
    # tests with a p-value at most the cell's upper edge 10 ** (-cell / CELLS)
    up = cells.groupBy("band").agg(F.sum("c").alias("tests"), F.array_sort(F.collect_list(F.struct("cell", "c"))).alias("cells"))
    cut = up.select("band", "tests", "cells", F.explode("cells.cell").alias("cell")).withColumn(
        "found", F.aggregate(F.filter("cells", lambda x: x["cell"] >= F.col("cell")), F.lit(0).cast("long"), lambda s, x: s + x["c"]))
    cut = cut.filter(F.pow(F.lit(10.0), -F.col("cell") / CELLS) <= FALSE_SHARE * F.col("found") / F.col("tests"))
    cut = cut.groupBy("band").agg(F.min("cell").alias("least"))
    return t.join(cut, "band").filter((F.col("cell") >= F.col("least")) & (F.col("p_random") >= BATTERY_LEVEL)).select("token")


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: (doc_id, text_key, base, added), arrays of spans with their matches."""
    scanned = settle(scan(docs), "secret-scan")
    each = scanned.filter(F.size("tokens") > 0).groupBy("text_key").agg(F.first("tokens").alias("tokens"))
    each = each.select("text_key", F.explode("tokens").alias("span"))
    distinct = settle(each.select(F.col("span.match").alias("token")).distinct(), "tokens")
    flagged = significant(settle(battery(distinct, plain_letters(docs)), "battery"))
    added = each.join(flagged, F.col("span.match") == F.col("token")).groupBy("text_key").agg(
        F.collect_list("span").alias("added"))
    return scanned.join(broadcast_if_small(settle(added, "added")), "text_key", "left").select(
        "doc_id", "text_key", "base", F.coalesce("added", F.array().cast(f"array<{SPAN}>")).alias("added"))


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span, found by format or by the method, replaced by ``mark``.

    All rows stay, with the columns of ``docs``; n_chars, if there, is set to the new length where a text changed.
    """
    found = find_secrets(docs).filter(F.size("base") + F.size("added") > 0).groupBy("text_key").agg(
        F.first(F.concat("base", "added")).alias("spans"))
    found = broadcast_if_small(settle(found.select(F.col("text_key").alias("key"), "spans"), "secrets"))
    rows = docs.select(F.struct("*").alias("row")).join(found, F.md5("row.text") == F.col("key"), "left")
    rows = rows.withColumn("new", F.when(F.col("spans").isNotNull(), redacted(F.col("row.text"), F.col("spans"), mark)))
    out = []
    for f in docs.schema:
        c = F.col("row").getField(f.name)
        if f.name == "text":
            c = F.coalesce("new", c)
        elif f.name == "n_chars":
            c = F.when(F.col("new").isNotNull(), F.char_length("new")).otherwise(c)
        out.append(c.cast(f.dataType).alias(f.name))
    return rows.select(*out)


def span_list(spans: Column) -> Column:
    return joined(spans, KINDS)
