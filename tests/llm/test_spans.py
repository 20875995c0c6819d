"""Spans of long texts with many matches: places, overlaps and redaction against plain Python, in time linear in the text."""

import random
import re
import time

from pyspark.sql import functions as F

from tramline.llm import pii, secrets
from tramline.llm.spans import SPAN, blocks, count_below, outside, piece, redacted


def contacts(n, rng):
    return " ".join(f"user{i}@host{i % 97}.org id AB-{rng.randrange(10 ** 7)} \U0001F600" for i in range(n))


def test_many_matches_take_linear_time(spark):
    rng = random.Random(1)
    took = []
    for n in (2_000, 5_000, 40_000):  # the first warms up
        text = contacts(n, rng)
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        start = time.perf_counter()
        row = pii.scan(df).select(F.size("base").alias("n"), F.element_at("base", -1).alias("last"), F.size("others").alias("o"),
                                  F.element_at("others", -1).alias("other")).head()
        took.append(time.perf_counter() - start)
        assert row.n == n and row.o >= n * 9 // 10
        assert text[row.last.start:row.last.end] == row.last.match and text[row.other.start:row.other.end] == row.other.match
        assert row.other.before == text[max(0, row.other.start - 48):row.other.start]
    assert took[2] < 8 * max(took[1], 1.0) + 5
    text = " ".join(f"password={rng.randrange(10 ** 15)} x{rng.getrandbits(128):032x}" for _ in range(20_000))
    start = time.perf_counter()
    got = secrets.redact_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).head()
    assert got.text.count("[SECRET]") >= 39_000 and time.perf_counter() - start < 60


def test_overlaps_by_search(spark):
    rng = random.Random(2)

    def some(n, most, kind):
        at = [(rng.randrange(most), rng.randrange(1, 30)) for _ in range(n)]
        return [(kind, a, a + w, "m") for a, w in at]

    rows = [(i, some(rng.choice([0, 1, 40]), 400, "x"), some(rng.choice([0, 1, 25]), 400, "y")) for i in range(60)]
    df = spark.createDataFrame(rows, f"i int, s array<{SPAN}>, o array<{SPAN}>")
    got = {r.i: [tuple(x) for x in r.f] for r in df.select("i", outside(F.col("s"), F.col("o")).alias("f")).collect()}
    for i, spans, others in rows:
        assert got[i] == [x for x in spans if not any(o[1] < x[2] and x[1] < o[2] for o in others)]
    assert spark.range(1).select(count_below(F.array(*[F.lit(x) for x in (1, 3, 3, 9)]), F.lit(3))).head()[0] == 1


def test_pieces_and_redaction(spark):
    rng = random.Random(3)
    alphabet = "ab \n\r  é漢\U0001F600"
    rows = []
    for i in range(80):
        text = "".join(rng.choices(alphabet, k=rng.choice([0, 1, 511, 512, 513, 2_000])))
        spans = sorted({(a, min(len(text), a + rng.randrange(1, 700))) for a in (rng.randrange(len(text)) for _ in range(rng.randrange(6)))}) if text else []
        rows.append((i, text, [("k", a, b, "") for a, b in spans]))
    df = spark.createDataFrame(rows, f"i int, text string, s array<{SPAN}>")
    got = {r.i: r for r in df.select("i", redacted(F.col("text"), F.col("s"), "[X]").alias("r"), piece(
        blocks(F.col("text")), F.lit(500), F.least(F.lit(1_100), F.char_length("text"))).alias("p")).collect()}
    for i, text, spans in rows:
        out, at = "", 0
        for _, a, b, _ in sorted(spans):
            if a >= at:
                out += text[at:a] + "[X]"
            at = max(at, b)
        assert got[i].r == out + text[at:] and got[i].p == text[500:1_100]
    assert re.search("漢", rows[-1][1] + "漢")
