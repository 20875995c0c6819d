"""Repetition inside a text, by suffix arrays over its words.

The suffixes of a text's words are sorted by prefix doubling; neighbours in
that order give the longest common prefixes. Every interval of prefixes of L
or more words is a repeated substring; the largest prefix that starts at a
place covers all shorter repeats there, so the union of the spans
``[i, i + lcp)`` is the part of the text that occurs twice or more. The rule
limits the fraction covered by long repeats and the longest single repeat.

Texts are handled in slices of about half a megabyte of Arrow batches, rows of a slice in
one suffix array (ranks never tie across rows), so memory follows the slice or
the longest text, and no shuffle is needed.

Defined cases: a null or empty text has no words and fails (fewer than ten
words). Repeated rows each get their own result. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tramline.llm.common import with_python
from tramline.llm.words import (NON_SPACE, mix, per_row_sum, row_slices, run_hashes, runs,
                                text_buffer)


@dataclass(frozen=True)
class Rule:
    """Limits; the first two are the base, the others the verdict of the method."""

    min_words: int = 10
    window: int = 5
    max_window_pct: int = 20
    #: repeats of so many words or more may cover so much of the words
    long_words: int = 10
    max_long_pct: int = 20
    #: a repeat of so many words is too long whatever it covers
    longest_words: int = 100


_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_LEAD = (np.arange(256) & 0xC0) != 0x80
_NOT_NEWLINE = np.arange(256) != 10


def longest_prefixes(words: np.ndarray, row: np.ndarray, row_end: np.ndarray) -> np.ndarray:
    """For each word place, the longest prefix that another place of its row shares.

    ``words`` are word hashes, ``row`` the row of each, ``row_end`` the place
    after the row's last word. Place i's prefix is ``words[i:i + result[i]]``.
    """
    n = len(words)
    best = np.zeros(n, np.int64)
    if n == 0:
        return best
    with np.errstate(over="ignore"):
        own = mix(words + mix(row.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(own, kind="stable")
    fresh = np.concatenate([[True], own[order][1:] != own[order][:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    levels, step = [rank], 1
    tied = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
    first_tied = tied
    while len(tied):
        # refine the ties: order by (rank here, rank `step` words on)
        there = tied + step
        second = np.where(there < row_end[tied], rank[np.minimum(there, n - 1)] + 1, 0)
        key = rank[tied] * (n + 1) + second
        by = np.argsort(key, kind="stable")
        key, base = key[by], rank[tied][by]
        places = np.arange(len(by))
        base_at = places[np.concatenate([[True], base[1:] != base[:-1]])]
        base_at = base_at[np.cumsum(np.concatenate([[True], base[1:] != base[:-1]])) - 1]
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        new_at = places[fresh][np.cumsum(fresh) - 1]
        nxt = rank.copy()
        nxt[tied[by]] = base + new_at - base_at
        same = np.concatenate([~fresh[1:], [False]]) | ~fresh
        rank = nxt
        levels.append(rank)
        step *= 2
        tied = np.sort(tied[by][same])
    suffixes = first_tied[np.argsort(rank[first_tied], kind="stable")]
    a, b = suffixes[:-1], suffixes[1:]
    pair = levels[0][a] == levels[0][b]
    a, b = a[pair], b[pair]
    lcp = np.zeros(len(a), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        x, y = a + lcp, b + lcp
        ok = (x < row_end[a]) & (y < row_end[b])
        ok &= levels[level][np.minimum(x, n - 1)] == levels[level][np.minimum(y, n - 1)]
        lcp[ok] += 1 << level
    np.maximum.at(best, a, lcp)
    np.maximum.at(best, b, lcp)
    return best


def covered(prefix: np.ndarray, least: int) -> np.ndarray:
    """Flags of the words in the union of all repeats of ``least`` words or more."""
    edge = np.zeros(len(prefix) + 1, np.int64)
    at = np.flatnonzero(prefix >= least)
    np.add.at(edge, at, 1)
    np.subtract.at(edge, at + prefix[at], 1)
    return np.cumsum(edge[:-1]) > 0


def _spans(flags: np.ndarray, first: np.ndarray) -> list[list[dict]]:
    """Maximal runs of covered words of each row, as word spans from the row's start."""
    cut = np.zeros(len(flags) + 1, np.bool_)
    cut[first] = True
    inside = np.concatenate([flags, [False]])
    before = np.concatenate([[False], flags])
    start = np.flatnonzero(inside & (cut | ~before))
    end = np.flatnonzero(before & (cut | ~inside))
    of = np.searchsorted(first, start, side="right") - 1
    out: list[list[dict]] = [[] for _ in range(len(first) - 1)]
    for s, e, r in zip((start - first[of]).tolist(), (end - first[of]).tolist(), of.tolist(), strict=True):
        out[r].append({"start": s, "end": e})
    return out


def measure(text: pa.Array, rule: Rule) -> dict[str, np.ndarray | list]:
    """All figures of one slice of texts."""
    buf, off = text_buffer(text)
    w = runs(buf, off, NON_SPACE)
    row_end = np.repeat(w.first[1:], w.per_row)
    prefix = longest_prefixes(run_hashes(buf, w.start, w.end), w.row, row_end)
    n = len(off) - 1
    short = covered(prefix, rule.window)
    long = covered(prefix, rule.long_words)
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, w.row, prefix)
    lines = runs(buf, off, _NOT_NEWLINE)
    worded = np.searchsorted(w.start, lines.end) > np.searchsorted(w.start, lines.start)
    with np.errstate(over="ignore"):
        key = mix(run_hashes(buf, lines.start, lines.end) + mix(lines.row.astype(np.uint64) + np.uint64(1)))[worded]
    line_row = lines.row[worded]
    _, at = np.unique(key, return_index=True)
    out = {
        "n_words": w.per_row.astype(np.int64),
        "word_chars": per_row_sum((NON_SPACE & _LEAD)[buf], off),
        "n_symbols": per_row_sum(_SYMBOLS[buf], off),
        "n_dup_lines": np.bincount(line_row, minlength=n) - np.bincount(line_row[at], minlength=n),
        "n_repeat_words": per_row_sum(short, w.first),
        "n_long_repeat_words": per_row_sum(long, w.first),
        "longest_repeat": longest,
        "repeat_spans": _spans(long, w.first),
    }
    words = out["n_words"]
    out["base_failed"] = (words < rule.min_words) | (100 * out["n_repeat_words"] > rule.max_window_pct * words)
    out["kept"] = ~(out["base_failed"] | (100 * out["n_long_repeat_words"] > rule.max_long_pct * words)
                    | (longest >= rule.longest_words))
    return out


SCORES = ("doc_id {id}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "n_long_repeat_words long, longest_repeat long, base_failed boolean, kept boolean, "
          "repeat_spans array<struct<start:long,end:long>>")


def repetition_scores(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): its figures, repeated spans and verdict."""
    with_python(docs.sparkSession)
    schema = SCORES.format(id=docs.schema["doc_id"].dataType.simpleString())
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in row_slices(text_buffer(batch.column(1))[1]):
                part = batch.slice(i, j - i)
                got = measure(part.column(1), rule)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(got[c], pa.int64()) for c in (
                        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "n_long_repeat_words", "longest_repeat")),
                     pa.array(got["base_failed"]), pa.array(got["kept"]), pa.array(got["repeat_spans"], spans)],
                    names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                           "n_long_repeat_words", "longest_repeat", "base_failed", "kept", "repeat_spans"])

    return docs.select("doc_id", "text").mapInArrow(score, schema)


def drop_repetitive(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The rows of ``docs`` that the rule keeps, with all their columns."""
    with_python(docs.sparkSession)
    at = docs.columns.index("text")

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in row_slices(text_buffer(batch.column(at))[1]):
                part = batch.slice(i, j - i)
                yield part.filter(pa.array(measure(part.column(at), rule)["kept"]))

    return docs.mapInArrow(keep, docs.schema)
