"""Licences in texts, by a positional index of rare words.

Templates are short licence wordings with the phrases that must be there. A
first pass counts in how many documents each template word occurs. The index
holds, for each template, its words of highest inverse document frequency with
their positions. A second pass looks up every index word of a file; postings
that agree in relative position (the file's place less the template's) are one
alignment. Alignments with enough of the rare weight are scored over the whole
template and count if the score is high enough and all mandatory phrases occur
in the aligned stretch. Phrases of the base give labels of their own.

Both passes work on slices of Arrow batches; only the counts of the template
words (a few hundred numbers) are gathered.

Defined cases: null and empty texts have no words and no labels. Repeated rows
each get their own result. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import WORD, with_python
from tramline.llm.words import LOWER, WORD_BYTES, row_slices, run_hashes, runs, text_buffer

#: Phrases of the base and their labels. Fixed values.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Label, wording, phrases that must occur. Public licence notices.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files, to deal in the Software without restriction", ["permission is hereby granted", "free of charge"]),
    ("mit", "Released under the MIT License", ["under the mit license"]),
    ("apache", "Licensed under the Apache License, Version 2.0", ["apache license version 2 0"]),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation", ["gnu general public license"]),
    ("gpl", "This work is licensed under the GNU General Public License, version 3", ["gnu general public license"]),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
     "the following conditions are met", ["redistribution and use in source and binary forms"]),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted", ["with or without fee"]),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", ["mozilla public license"]),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", ["cc by nc 4 0"]),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
     ["creative commons attribution noncommercial"]),
    ("unlicense", "This is free and unencumbered software released into the public domain",
     ["free and unencumbered software"]),
]
#: Index words of a template, the share of their weight that must align, and the score that counts.
RARE, RARE_SHARE, LEAST_SCORE = 5, 0.35, 0.7
#: Words put in or left out that an alignment may pass over.
SLACK = 3


def _words(text: str) -> list[str]:
    return re.findall(WORD, "".join(c.lower() if c.isascii() else c for c in text))


def _hash(words: list[str]) -> np.ndarray:
    if not words:
        return np.zeros(0, np.uint64)
    raw = [w.encode() for w in words]
    end = np.cumsum([len(r) for r in raw])
    return run_hashes(np.frombuffer(b"".join(raw), np.uint8), end - [len(r) for r in raw], end)


VOCABULARY = sorted({w for _, text, _ in TEMPLATES for w in _words(text)})


@dataclass
class Template:
    label: str
    hashes: np.ndarray
    weights: np.ndarray
    rare_weight: float
    phrases: list[np.ndarray]


@dataclass
class Index:
    """Postings by word hash: template and place of each rare template word, sorted by hash."""

    templates: list[Template]
    hash: np.ndarray
    template: np.ndarray
    place: np.ndarray


def build_index(idf: dict[str, float]) -> Index:
    templates, postings = [], []
    for t, (label, text, phrases) in enumerate(TEMPLATES):
        words = _words(text)
        hashes = _hash(words)
        weights = np.array([idf[w] for w in words])
        rare = sorted(set(words), key=lambda w: (-idf[w], w))[:RARE]
        at = [i for i, w in enumerate(words) if w in rare]
        postings += [(hashes[i], t, i) for i in at]
        templates.append(Template(label, hashes, weights, float(weights[at].sum()), [_hash(p.split()) for p in phrases]))
    postings.sort()
    return Index(templates, np.array([p[0] for p in postings], np.uint64),
                 np.array([p[1] for p in postings], np.int64), np.array([p[2] for p in postings], np.int64))


def _phrase_at(hashes: np.ndarray, row: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Places where the phrase's words stand one after the other in one row."""
    n = len(hashes) - len(phrase) + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    ok = row[:n] == row[len(phrase) - 1:]
    for k, h in enumerate(phrase):
        ok &= hashes[k:k + n] == h
    return np.flatnonzero(ok)


def scan_texts(text: pa.Array, index: Index) -> dict[str, list]:
    buf, off = text_buffer(text)
    low = LOWER[buf]
    w = runs(low, off, WORD_BYTES)
    wh = run_hashes(low, w.start, w.end)
    n = len(off) - 1
    base_labels: list[set[str]] = [set() for _ in range(n)]
    labels: list[set[str]] = [set() for _ in range(n)]
    score = np.zeros(n)
    places = []
    for phrase, label in BASE.items():
        at = _phrase_at(wh, w.row, _hash(phrase.split()))
        places.append(at)
        for r in np.unique(w.row[at]).tolist():
            base_labels[r].add(label)
    at = np.concatenate(places)
    n_base = np.bincount(w.row[at], minlength=n)
    first = np.full(n, np.iinfo(np.int64).max)
    last = np.full(n, -1)
    np.minimum.at(first, w.row[at], at - w.first[w.row[at]])
    np.maximum.at(last, w.row[at], at - w.first[w.row[at]])
    # postings of every index word, by row, template and relative position
    lo, hi = np.searchsorted(index.hash, wh, "left"), np.searchsorted(index.hash, wh, "right")
    hit = np.flatnonzero(hi > lo)
    count = (hi - lo)[hit]
    posting = np.repeat(lo[hit] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    word = np.repeat(hit, count)
    t, p = index.template[posting], index.place[posting]
    key = np.stack([w.row[word], t, word - p], axis=1)
    kinds, group = np.unique(key, axis=0, return_inverse=True) if len(key) else (key, np.zeros(0, np.int64))
    weight = np.zeros(len(kinds))
    np.add.at(weight, group.reshape(-1), np.array([index.templates[a].weights[b] for a, b in zip(t.tolist(), p.tolist(), strict=True)]))
    for (r, ti, diagonal), rare in zip(kinds.tolist(), weight.tolist(), strict=True):
        template = index.templates[ti]
        if rare < RARE_SHARE * template.rare_weight:
            continue
        # template words that stand at their relative position, up to the slack
        size, lo_r, hi_r = len(template.hashes), int(w.first[r]), int(w.first[r + 1])
        at = diagonal + np.arange(size)[:, None] + np.arange(-SLACK, SLACK + 1)[None, :]
        near = np.where((at >= lo_r) & (at < hi_r), wh[np.clip(at, 0, len(wh) - 1)], np.uint64(0))
        same = ((near == template.hashes[:, None]) & (at >= lo_r) & (at < hi_r)).any(axis=1)
        got = float(template.weights[same].sum() / template.weights.sum())
        a, b = max(diagonal - SLACK, lo_r), min(diagonal + size + SLACK, hi_r)
        if got >= LEAST_SCORE and all(len(_phrase_at(wh[a:b], w.row[a:b], x)) for x in template.phrases):
            labels[r].add(template.label)
            score[r] = max(score[r], got)
    return {"n_words": w.per_row.tolist(), "n_base": n_base.tolist(),
            "first_word": [f if c else None for f, c in zip(first.tolist(), n_base.tolist(), strict=True)],
            "last_word": [x if c else None for x, c in zip(last.tolist(), n_base.tolist(), strict=True)],
            "base_labels": [",".join(sorted(x)) for x in base_labels],
            "labels": [",".join(sorted(x | y)) for x, y in zip(base_labels, labels, strict=True)], "score": score.tolist()}


def document_frequencies(docs: DataFrame) -> dict[str, float]:
    """The inverse document frequency of every template word over all rows of ``docs``."""
    with_python(docs.sparkSession)
    known = _hash(VOCABULARY)
    order = np.argsort(known)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(known) + 1, np.int64)
        for batch in batches:
            buf, off = text_buffer(batch.column(0))
            for i, j in row_slices(off):
                low = LOWER[buf[off[i]:off[j]]]
                w = runs(low, off[i:j + 1] - off[i], WORD_BYTES)
                wh = run_hashes(low, w.start, w.end)
                at = np.minimum(np.searchsorted(known[order], wh), len(known) - 1)
                hit = known[order][at] == wh
                pairs = np.unique(w.row[hit] * len(known) + order[at[hit]])
                total[:-1] += np.bincount(pairs % len(known), minlength=len(known))
            total[-1] += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["word", "n"])

    rows = docs.select("text").mapInArrow(work, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    n = {r.word: r.n for r in rows}
    all_rows = n.get(len(known), 0)
    return {w: math.log((all_rows + 1) / (n.get(k, 0) + 1)) + 1e-6 for k, w in enumerate(VOCABULARY)}


def find_licenses(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)."""
    with_python(docs.sparkSession)
    index = build_index(document_frequencies(docs))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in row_slices(text_buffer(batch.column(1))[1]):
                part = batch.slice(i, j - i)
                got = scan_texts(part.column(1), index)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(got[c], pa.int64()) for c in ("n_words", "n_base", "first_word", "last_word")),
                     pa.array(got["base_labels"], pa.string()), pa.array(got["labels"], pa.string()),
                     pa.array(got["score"], pa.float64())], names=["doc_id", *got])

    return docs.select("doc_id", "text").mapInArrow(
        work, f"doc_id {id_type}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
              "labels string, score double")
