"""Near-duplicate passages across texts, by compact windows.

A text is the sequence of its word n-gram hashes. Under a hash function, the
Cartesian tree over a text's hash values gives for each place the largest
window in which it has the least value; a window of ``span`` or more n-grams
stands for all its subsequences that hold that place: they share one min-hash.
These compact windows are exactly the runs of sliding windows with the same
minimum, so they come from a sliding minimum in a few numpy passes, about
2 / span of them for each n-gram.

Windows with the same function and min-hash form a list. In each list every
text is first joined to the least one, so a passage that a third of all texts
share costs rows, not pairs. A list is keyed by one n-gram only, so its least
text may hold that n-gram and nothing more: windows outside the passages found
so far, or in lists of several classes, then meet all others of their list,
block by block. The intervals of a pair of texts are
united over all functions; a pair that meets its least text under any is verified:
all equal n-grams of both intervals are aligned by diagonals, and every stretch of
``span`` n-grams that agrees in enough of them to make a Jaccard similarity of
``threshold`` belongs to a passage, in both texts.

Defined cases: words as in the n-gram join. A text with fewer words than a
passage has none. Equal texts are one node (named by a 64-bit hash) whose rows
share class, links and spans; a text of a passage's length that two or more
rows have is a passage as a whole, and removable in all of them but one.
Null and empty texts are classes of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramline.llm.common import WORD, broadcast_if_small, settle, with_python
from tramline.llm.components import components
from tramline.llm.words import (LOWER, WORD_BYTES, Runs, mix, ngram_hashes, row_slices, run_hashes,
                                runs, text_buffer, unmix)

#: Words of an n-gram, and of the shortest passage.
N, PASSAGE = 5, 50
#: Hash functions; a pair at similarity s is met with probability 1 - (1 - s) ** HASHES.
HASHES = 4
THRESHOLD = 0.8
#: Diagonals so near belong to one alignment (words put in or left out).
BAND = 8
#: Matches of two stretches that are held at once; beyond, they are cut into parts that overlap by 2 * PART places.
MATCHES, PART = 1 << 22, 512
#: Matches that pairs verified together have at most (or half as many more), places of bands that are thinned out in one pass,
#: and the number range of a pair's or band's own places.
TOGETHER, HELD, WIDE = 1 << 18, 1 << 18, 1 << 40
#: Places of bands that are so few that all go at once.
SOON = 1 << 14
#: Pairs of a list that are verified before what they add is looked at again, and powers of two of those of one window.
AHEAD, STEPS = 512, 5
#: Windows of lists in which a pair is verified for any n-gram outside known passages, and counts as a link.
LINKED = 512
#: Pairs so few that each is looked at alone.
FEW = 32
#: Places of pairs that are compared together, and the slots that say which n-grams a text of a pair may have.
PLACES, SLOTS = 1 << 18, 1 << 13
#: Windows of a list that are compared with each other in one task.
BLOCK = 2048
#: Windows of lists that are met in turn in one task (or those of one list's blocks).
TURN = 1 << 14
#: Pairs of windows whose places are compared at once, and texts (a multiple of 8) whose partners are given out at once.
ROWS, GIVEN = 1 << 11, 1 << 8
#: Links that are held as Python objects.
LINK_ROWS = 1 << 12
#: An n-gram that more than a part of 1 / DENSE of a list's windows have is counted by matrix products.
DENSE = 10
#: A word (``WORD``) in a text whose letters are in either case.
ANY_CASE = WORD.replace(r"\x60", r"\x40\x5B-\x60")
LINKS = "node long, other long, spans array<struct<start:int,end:int>>, other_spans array<struct<start:int,end:int>>"
PARTNERS = f"{LINKS}, partners array<long>"

#: Flags of the places of two texts, or none.
Free = tuple[np.ndarray, np.ndarray] | None

_SALT = np.random.default_rng(99).integers(0, 1 << 64, HASHES, dtype=np.uint64)


def _grams(buf: np.ndarray, off: np.ndarray) -> tuple[Runs, np.ndarray]:
    """Words and the n-gram hash at every word (meaningless at the last N - 1 words of a text)."""
    low = LOWER[buf]
    w = runs(low, off, WORD_BYTES)
    g = ngram_hashes(run_hashes(low, w.start, w.end), N)
    return w, np.concatenate([g, np.zeros(len(w.start) - len(g), np.uint64)])


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours (len - width + 1 values)."""
    step = 1
    while 2 * step <= width:
        v = np.minimum(v[:-step], v[step:])
        step *= 2
    rest = width - step
    return np.minimum(v[:len(v) - rest], v[rest:]) if rest else v


def compact_windows(w: Runs, grams: np.ndarray, span: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each function: min-hash, row, first and last n-gram (in the text) of every compact window."""
    last = len(grams) - span + 1
    if last <= 0:
        return
    inside = np.arange(last) + span + N - 2 < w.first[w.row[:last] + 1]
    at = w.first[w.row[:last]]
    for f in range(HASHES):
        v = sliding_min(mix(grams ^ _SALT[f]), span)
        fresh = np.ones(last, np.bool_)
        fresh[1:] = (v[1:] != v[:-1]) | (w.row[1:last] != w.row[:last - 1])
        head = np.flatnonzero(fresh & inside)
        # a run of equal minima ends before the next head, or at the last window of its text
        ends = np.append(np.flatnonzero(fresh)[1:], last)
        end = ends[np.searchsorted(ends, head, side="right")] - 1
        end = np.minimum(end, w.first[w.row[head] + 1] - span - N + 1)
        yield mix(v[head] + _SALT[f]), w.row[head], head - at[head], end - at[head] + span - 1


def windows(docs: DataFrame, passage: int) -> DataFrame:
    """(value, node, l, r): compact windows of all texts in n-gram places."""
    with_python(docs.sparkSession)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = text_buffer(batch.column(0))
            node = batch.column(1).to_numpy(zero_copy_only=False)
            for i, j in row_slices(off):
                w, g = _grams(buf[off[i]:off[j]], off[i:j + 1] - off[i])
                for value, row, l, r in compact_windows(w, g, passage - N + 1):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(value.view(np.int64)), pa.array(node[i + row]), pa.array(l, pa.int32()), pa.array(r, pa.int32())],
                        names=["value", "node", "l", "r"])

    return docs.select("text", F.xxhash64("text").alias("node")).filter("text is not null").mapInArrow(
        work, "value long, node long, l int, r int")


def contents(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """(node, lo, grams): the n-grams (32 bits each) of the stretch lo..hi of every needed text."""
    with_python(docs.sparkSession)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = text_buffer(batch.column(0))
            lo, hi = (batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3))
            for i, j in row_slices(off):
                w, g = _grams(buf[off[i]:off[j]], off[i:j + 1] - off[i])
                g = (g >> np.uint64(32)).astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(i, j - i), batch.column(2).slice(i, j - i),
                     pa.array([g[w.first[k] + lo[i + k]:w.first[k] + hi[i + k] + 1].tobytes() for k in range(j - i)], pa.binary())],
                    names=["node", "lo", "grams"])

    texts = docs.select("text", F.xxhash64("text").alias("node")).filter("text is not null")
    joined = texts.join(broadcast_if_small(needed), "node").select("text", "node", "lo", "hi")
    return joined.mapInArrow(work, "node long, lo int, grams binary").groupBy("node").agg(
        F.first("lo").alias("lo"), F.first("grams").alias("grams"))


def _distinct(v: np.ndarray) -> np.ndarray:
    """The values in order, each once."""
    v = np.sort(v)
    return v[np.append(True, v[1:] != v[:-1])] if len(v) else v


def _places_of(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Places of ``x`` whose value is in ``y``."""
    y = np.sort(y)
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return np.flatnonzero(y[at] == x) if len(y) else at[:0]


def _dense(places: np.ndarray, span: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Stretches (firsts, ends) of ``span`` places of which ``least`` or more are given, united; bounds are given places."""
    places = _distinct(places)
    if len(places) < least:
        return places[:0], places[:0]
    first, last = places[:len(places) - least + 1], places[least - 1:]
    ok = last - first < span
    first, end = first[ok], last[ok] + 1
    new = np.flatnonzero(first[1:] > end[:-1]) + 1
    return first[np.concatenate([[0], new])] if len(first) else first, end[np.append(new, len(end)) - 1] if len(end) else end


def _within(places: np.ndarray, stretches: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Whether each place lies in a stretch."""
    first, end = stretches
    if not len(first):
        return np.zeros(len(places), np.bool_)
    k = np.searchsorted(first, places, side="right") - 1
    return (k >= 0) & (places < end[k])


def _least(span: int, threshold: float) -> int:
    """Places of ``span`` that have to agree for a Jaccard similarity of ``threshold``."""
    return int(np.ceil(2 * threshold / (1 + threshold) * span - 1e-9))


def _matches(x: np.ndarray, y: np.ndarray, part: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All places (i, j) of equal n-grams, ordered by diagonal; texts of many repeats in overlapping parts."""
    parts = [(0, len(x), 0, len(y))]
    while parts:
        xa, xb, ya, yb = parts.pop()
        order = np.argsort(y[ya:yb], kind="stable")
        values = y[ya:yb][order]
        low = np.searchsorted(values, x[xa:xb], side="left")
        n = np.searchsorted(values, x[xa:xb], side="right") - low
        if n.sum() > MATCHES and max(xb - xa, yb - ya) > 4 * part:
            if xb - xa >= yb - ya:
                mid = (xa + xb) // 2
                parts += [(xa, mid + part, ya, yb), (mid - part, xb, ya, yb)]
            else:
                mid = (ya + yb) // 2
                parts += [(xa, xb, ya, mid + part), (xa, xb, mid - part, yb)]
            continue
        i = np.repeat(np.arange(xb - xa), n)
        j = order[np.arange(len(i)) + np.repeat(low - np.cumsum(n) + n, n)]
        i, j = i + xa, j + ya
        by = np.lexsort((i, i - j))
        yield i[by], j[by]


def _aligned(pair: np.ndarray, i: np.ndarray, j: np.ndarray, span: int, least: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(pair, x first, x end, y first, y end) of passages among equal places (i, j) of many pairs, ordered by pair and diagonal.

    The fullest of all bands that start within ``span`` diagonals goes first;
    the others that lie inside the passages found by then, on both sides, add
    nothing and are left out. Texts of many repeats have thousands of such bands.
    """
    key = pair * WIDE + (i - j)
    head = np.flatnonzero(np.diff(key, prepend=key[:1] - 1))
    end = np.searchsorted(key, key[head] + BAND, side="right")
    # a band that ends with the one before is a part of it
    whole = np.flatnonzero((end - head >= least) & (np.diff(end, prepend=0) > 0))
    if not len(whole):
        return
    start, size = head[whole], end[whole] - head[whole]
    last = np.append(head[1:], len(key)) - 1
    cut = np.ravel([whole, np.searchsorted(head, end[whole])], order="F")
    base = pair[start] * WIDE

    def least_and_most(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of every band's places; they rise along a diagonal."""
        return tuple(base + f.reduceat(np.append(v[at], v[at[-1:]]), cut)[::2] for f, at in ((np.minimum, head), (np.maximum, last)))

    sides = [least_and_most(v) for v in (i, j)]
    todo = np.arange(len(start))
    if size.sum() > SOON:
        group = key[start] // span
        by = np.lexsort((-size, group))
        first = np.sort(by[np.diff(group[by], prepend=group[by[:1]] - 1) != 0])
        got = list(_thinned(first, start, size, i, j, span, least))
        yield from ((int(pair[start[k]]), *m) for k, *m in got)
        todo = np.setdiff1d(todo, first)
        if got:
            of, *bounds = np.array(got, np.int64).T
            inside = np.ones(len(todo), np.bool_)
            for (low, high), a, b in zip(sides, bounds[::2], bounds[1::2], strict=True):
                inside &= _inside(low[todo], high[todo], base[of] + a, base[of] + b)
            todo = todo[~inside]
    yield from ((int(pair[start[k]]), *m) for k, *m in _thinned(todo, start, size, i, j, span, least))


def _inside(low: np.ndarray, high: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether all places low..high lie in one of the stretches (firsts, ends), united."""
    order = np.argsort(first, kind="stable")
    first, end = first[order], np.maximum.accumulate(end[order])
    new = np.append(True, first[1:] > end[:-1])
    first, end = first[new], end[np.append(new[1:], True)]
    k = np.searchsorted(first, low, side="right") - 1
    return (k >= 0) & (high < end[k])


def _thinned(bands: np.ndarray, start: np.ndarray, size: np.ndarray, i: np.ndarray, j: np.ndarray, span: int,
             least: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(band, x first, x end, y first, y end) of passages in the given bands of places.

    Every band gets number ranges of its own for its places, so all bands are
    thinned out together, in the same few array passes.
    """
    part = np.cumsum(size[bands]) // HELD
    for a, b in _stretches(part):
        n = size[bands[a:b]]
        band = np.repeat(np.arange(a, b), n)
        at = np.repeat(start[bands[a:b]] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        mine, theirs = band * WIDE + i[at], band * WIDE + j[at]
        done = []
        while len(mine):
            ok = _within(mine, _dense(mine, span, least)) & _within(theirs, _dense(theirs, span, least))
            # a band that keeps all its places is done
            thinner = np.zeros(b - a, np.bool_)
            thinner[mine[~ok] // WIDE - a] = True
            again = thinner[mine // WIDE - a]
            done.append((mine[~again], theirs[~again]))
            mine, theirs = mine[again & ok], theirs[again & ok]
        mine, theirs = (np.concatenate([d[side] for d in done]) for side in (0, 1))
        if not len(mine):
            continue
        first, last = _dense(mine, span, least)
        of = np.searchsorted(first, mine, side="right") - 1
        order = np.argsort(of, kind="stable")
        theirs, heads = theirs[order], np.searchsorted(of[order], np.arange(len(first)))
        band = first // WIDE
        yield from zip(bands[band].tolist(), *((v - band * WIDE).tolist() for v in (
            first, last, np.minimum.reduceat(theirs, heads), np.maximum.reduceat(theirs, heads) + 1)), strict=True)


def _stretches(v: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of the runs of equal values."""
    cut = [0, *(np.flatnonzero(v[1:] != v[:-1]) + 1).tolist(), len(v)]
    return ((a, b) for a, b in zip(cut[:-1], cut[1:], strict=True) if a < b)


def alike(x: np.ndarray, y: np.ndarray, span: int, threshold: float, free: Free = None) -> list[tuple[int, int, int, int]]:
    """Passages (x first, x end, y first, y end) in n-gram places that agree in enough n-grams.

    Every occurrence counts: places match along each diagonal and the ``BAND``
    ones after it, and a passage is dense in matches on either side. With
    ``free`` (flags of the places of either side) none are looked for where
    they would hold no flagged place.
    """
    least = _least(span, threshold)
    # no passage is denser than all places that the other side has anywhere
    dense = [_dense(_places_of(a, b), span, least) for a, b in ((x, y), (y, x))]
    if not all(len(first) for first, _ in dense):
        return []
    if free and not any(_within(np.flatnonzero(flags), d).any() for flags, d in zip(free, dense, strict=True)):
        return []
    return sorted({m[1:] for i, j in _matches(x, y, max(PART, span + BAND))
                   for m in _aligned(np.zeros(len(i), np.int64), i, j, span, least)})


def _fit(hits: list[np.ndarray], flagged: list[np.ndarray] | None, span: int, least: int, n: int) -> np.ndarray:
    """Which of n pairs have, on both sides, enough places that hit, and a flagged place among these on either."""
    fit, adds = np.ones(n, np.bool_), np.zeros(n, np.bool_)
    for side in (0, 1):
        dense = _dense(hits[side], span, least)
        has = np.zeros(n, np.bool_)
        has[dense[0] // WIDE] = True
        fit &= has
        if flagged:
            adds[flagged[side][_within(flagged[side], dense)] // WIDE] = True
    return fit & adds if flagged else fit


def alike_all(pairs: list[tuple[np.ndarray, np.ndarray]], span: int, threshold: float,
              free: list[Free] | None = None) -> list[list[tuple[int, int, int, int]]]:
    """``alike`` of many pairs, aligned together, so many that about ``TOGETHER`` places match; pairs of more matches alone.

    Most pairs share too few n-grams; slots of n-gram bits show that without sorting.
    """
    out: list[list[tuple[int, int, int, int]]] = [[] for _ in pairs]
    least = _least(span, threshold)
    size = np.array([(len(x) + len(y)) * (len(x) > 0 and len(y) > 0) for x, y in pairs], np.int64)
    filled = np.flatnonzero(size)
    for a, b in _stretches(np.cumsum(size[filled]) // PLACES):
        some = filled[a:b]
        sides = [[pairs[k][side] for k in some.tolist()] for side in (0, 1)]
        number, place = zip(*(_places(v) for v in sides), strict=True)
        value = [np.concatenate(v) for v in sides]
        at = [p * WIDE + i for p, i in zip(number, place, strict=True)]
        flagged = free and [at[side][np.concatenate([
            f[side] if (f := free[k]) else np.ones(len(pairs[k][side]), np.bool_) for k in some.tolist()])] for side in (0, 1)]
        slot = [p * SLOTS + (v & np.uint32(SLOTS - 1)) for p, v in zip(number, value, strict=True)]
        has = np.zeros((2, len(some) * SLOTS), np.bool_)
        for side in (0, 1):
            has[side][slot[side]] = True
        may = [has[1 - side][slot[side]] for side in (0, 1)]
        fit = _fit([p[m] for p, m in zip(at, may, strict=True)], flagged, span, least, len(some))
        if not fit.any():
            continue
        (px, ix, x), (py, jy, y) = ([v[m & fit[p]] for v in (p, i, g)] for p, i, g, m in zip(number, place, value, may, strict=True))
        x, y = (v.astype(np.int64) + p * (1 << 32) for v, p in ((x, px), (y, py)))
        order = np.argsort(y, kind="stable")
        y = y[order]
        low = np.searchsorted(y, x, side="left")
        n = np.searchsorted(y, x, side="right") - low
        met = np.zeros(len(y) + 1, np.int64)
        np.add.at(met, low[n > 0], 1)
        np.add.at(met, (low + n)[n > 0], -1)
        back = np.sort(order[np.cumsum(met)[:-1] > 0])
        fit = _fit([px[n > 0] * WIDE + ix[n > 0], py[back] * WIDE + jy[back]], flagged, span, least, len(some))
        n[~fit[px]] = 0
        total = np.bincount(px, weights=n, minlength=len(some)).astype(np.int64)
        for k in np.flatnonzero(total > TOGETHER // 2).tolist():
            out[some[k]] = alike(sides[0][k], sides[1][k], span, threshold)
        n[total[px] > TOGETHER // 2] = 0
        total[total > TOGETHER // 2] = 0
        for c, d in _stretches(np.cumsum(total) // TOGETHER):
            c, d = np.searchsorted(px, [c, d])
            m = n[c:d]
            i = c + np.repeat(np.arange(d - c), m)
            j = order[np.arange(len(i)) + np.repeat(low[c:d] - np.cumsum(m) + m, m)]
            pair, i, j = px[i], ix[i], jy[j]
            by = np.lexsort((i, pair * WIDE + (i - j)))
            found: dict[int, set] = {}
            for m in _aligned(pair[by], i[by], j[by], span, least):
                found.setdefault(m[0], set()).add(m[1:])
            for k, passages in found.items():
                out[some[k]] = sorted(passages)
    return out


def _places(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Number of the text, and place in it, of every n-gram of all texts."""
    n = np.array([len(t) for t in texts])
    return np.repeat(np.arange(len(texts)), n), np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)


def _united(spans):
    """Overlapping (start, end) spans of a sorted array joined."""
    empty = F.array().cast("array<struct<start:int,end:int>>")
    return F.aggregate(F.array_sort(spans), empty, lambda done, s: F.when(
        (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= s["start"]),
        F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
            F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"))))
    ).otherwise(F.concat(done, F.array(s))))


def _marked(links: DataFrame) -> DataFrame:
    """(node, spans, late): united passages of every linked text, and those that a text of smaller hash has."""
    sides = links.select("node", F.explode("spans").alias("span"), F.lit(True).alias("late"), "other").union(
        links.select("other", F.explode("other_spans"), F.lit(False), "node"))
    per_node = sides.groupBy("node").agg(
        F.collect_set("span").alias("all"), F.collect_set(F.when(F.col("late"), F.col("span"))).alias("late"))
    return per_node.select("node", _united(F.col("all")).alias("spans"), _united(F.col("late")).alias("late"))


def _uncovered(items: list[dict], grams: list[np.ndarray], column: str) -> list[np.ndarray]:
    """For each window the flags of its n-grams that lie in no known passage."""
    out = [np.ones(len(g), np.bool_) for g in grams]
    for t, free in zip(items, out, strict=True):
        for s in t[column] or ():
            free[max(0, s["start"] - t["l"]):max(0, s["end"] - N + 1 - t["l"])] = False
    return out


def _columns(grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The number of every place's n-gram, the windows that have each n-gram (ordered by it), and where those of each begin."""
    _, column = np.unique(np.concatenate(grams), return_inverse=True)
    each = _distinct(column * len(grams) + np.repeat(np.arange(len(grams)), [len(g) for g in grams]))
    return column, each % len(grams), np.searchsorted(each, np.arange(int(column.max()) + 2) * len(grams))


def _possible(grams: list[np.ndarray], columns: tuple[np.ndarray, np.ndarray, np.ndarray], span: int, least: int) -> list[np.ndarray]:
    """Flags of the windows' places that have, in ``span`` places, enough n-grams that more windows have; no passage holds others."""
    column, _, start = columns
    owner, place = _places(grams)
    place = place + owner * WIDE
    inside = _within(place, _dense(place[(np.diff(start) > 1)[column]], span, least))
    return np.split(inside, np.cumsum([len(g) for g in grams])[:-1])


def _adding(pairs: np.ndarray, columns: tuple[np.ndarray, np.ndarray, np.ndarray], late: list[np.ndarray], whole: list[np.ndarray],
            span: int, least: int) -> np.ndarray:
    """Which pairs (k, o) of windows can add a place: a flagged one of k or o, among ``span`` places that have enough of the other's n-grams.

    The partners of a window are looked at together, as rows of one table of its places.
    """
    column, owner, start = columns
    m, first = len(late), np.cumsum([0, *map(len, late)])
    out = np.zeros(len(pairs), np.bool_)
    for side, flags in ((0, late), (1, whole)):
        left = np.flatnonzero(~out)
        left = left[np.argsort(pairs[left, side], kind="stable")]
        for a, b in _stretches(pairs[left, side]):
            k = int(pairs[left[a], side])
            near = np.convolve(flags[k], np.ones(span, np.int64), "valid") > 0 if len(flags[k]) >= span else np.zeros(0, np.bool_)
            if not near.any():
                continue
            row = np.full(m, -1)
            partners = _distinct(pairs[left[a:b], 1 - side])
            row[partners] = np.arange(len(partners))
            # only places that a stretch with a flagged place reaches
            lo, hi = int(np.argmax(near)), len(near) - int(np.argmax(near[::-1])) + span - 1
            mine = column[first[k] + lo:first[k] + hi]
            n = start[mine + 1] - start[mine]
            who = row[owner[np.repeat(start[mine] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))]]
            hits = np.zeros((len(partners), hi - lo + 1), np.int32)
            hits[who[who >= 0], np.repeat(np.arange(1, hi - lo + 1), n)[who >= 0]] = 1
            hits = np.cumsum(hits, axis=1, dtype=np.int32)
            fit = ((hits[:, span:] - hits[:, :-span] >= least) & near[lo:hi - span + 1]).any(axis=1)
            out[left[a:b]] = fit[row[pairs[left[a:b], 1 - side]]]
    return out


def _incidence(at: tuple[np.ndarray, np.ndarray], flags: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """``matrix`` with ones at the flagged places and zeros elsewhere."""
    matrix[:] = 0
    matrix[at[0][flags], at[1][flags]] = 1
    return matrix


def _shared(grams: list[np.ndarray], *flags: list[np.ndarray]) -> list[np.ndarray]:
    """Each n-gram of each window once, of those that more windows have, ordered by n-gram.

    (n-gram's number, window, how often it is there, windows that have it, and for all ``flags`` whether a place of it has one.)
    """
    owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
    _, column = np.unique(np.concatenate(grams), return_inverse=True)
    order = np.argsort(column * len(grams) + owner, kind="stable")
    column, owner = column[order], owner[order]
    head = np.flatnonzero(np.append(True, (column[1:] != column[:-1]) | (owner[1:] != owner[:-1])))
    times = np.diff(np.append(head, len(owner)))
    flat = [np.logical_or.reduceat(np.concatenate(f)[order], head) for f in flags]
    column, owner = column[head], owner[head]
    size = np.bincount(column)[column]
    return [v[size > 1] for v in (column, owner, times, size, *flat)]


def _seen(m: int, shared: list[np.ndarray], adds: np.ndarray | None = None) -> np.ndarray:
    """For all pairs (k, o) of windows how many places of k have an n-gram of o; ``adds`` is set where one has a flag.

    ``shared`` has two flags with ``adds``: of the places of k, and of those of o.
    """
    column, owner, times, size, *flags = shared
    seen = np.zeros((m, m), np.float32)
    many = size * DENSE > m
    # n-grams that a good part of the windows have: products of incidence matrices, a few thousand at a time
    _, where = np.unique(column[many], return_inverse=True)
    who, often, flags_many = owner[many], times[many], [f[many] for f in flags]
    n_many = int(where[-1]) + 1 if len(where) else 0
    for lo in range(0, n_many, 4096):
        width = min(4096, n_many - lo)
        a, b = np.searchsorted(where, [lo, lo + width])
        at = (who[a:b], where[a:b] - lo)
        count, has = (np.zeros((m, width), np.float32) for _ in range(2))
        count[at], has[at] = often[a:b], 1
        seen += count @ has.T
        if adds is not None:
            late, whole = (f[a:b] for f in flags_many)
            if late.any():
                adds |= _incidence(at, late, count) @ has.T > 0
            if whole.any():
                adds |= has @ _incidence(at, whole, count).T > 0
    # n-grams of a few windows: their pairs one by one, so many at a time that memory stays bounded
    column, owner, times, size, *flags = (v[~many] for v in shared)
    first = np.searchsorted(column, column)
    for a, b in _stretches(np.cumsum(size) // HELD):
        n = size[a:b]
        mine = np.repeat(np.arange(a, b), n)
        theirs = np.repeat(first[a:b] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        cell = owner[mine] * m + owner[theirs]
        seen += np.bincount(cell, weights=times[mine], minlength=m * m).reshape(m, m)
        if adds is not None:
            adds.ravel()[cell[flags[0][mine] | flags[1][theirs]]] = True
    return seen


def _candidates(items: list[dict], grams: list[np.ndarray], late: list[np.ndarray], whole: list[np.ndarray],
                least: int, likest: bool = False) -> np.ndarray:
    """Pairs (k, o), o of smaller hash, that can be alike and can add an n-gram or join two classes.

    An n-gram that one window alone has adds nothing, so a list whose other
    n-grams are all covered, in one class, is done without looking at pairs.
    With ``likest`` each window's likest partners come first.
    """
    none = np.zeros((0, 2), np.int64)
    labels = np.array([t["label"] for t in items])
    mixed = bool((labels != labels[0]).any())
    if not mixed and not any(f.any() for f in (*late, *whole)):
        return none
    shared = _shared(grams, late, whole)
    if not mixed and not shared[4].any() and not shared[5].any():
        return none
    nodes, blocks = np.array([t["node"] for t in items]), np.array([t["block"] for t in items])
    adds = labels[:, None] != labels[None, :]
    seen = _seen(len(items), shared, adds)
    fit = adds & (seen >= least) & (seen.T >= least) & (nodes[None, :] < nodes[:, None])
    if (blocks != blocks[0]).any():
        fit &= blocks[None, :] != blocks[:, None]
    pairs = np.argwhere(fit)
    return pairs[np.lexsort((-seen[fit], pairs[:, 0]))] if likest else pairs


def _around(grams: list[np.ndarray], value: int, span: int) -> np.ndarray:
    """The windows' n-grams by their distance from that of the list, a row for each; a number of the window's own where there are none."""
    out = np.repeat(-1 - np.arange(len(grams))[:, None], 2 * span - 1, axis=1)
    owner, place = _places(grams)
    flat = np.concatenate(grams)
    least = unmix(np.array([value], np.int64).view(np.uint64)) - _SALT
    for own in (unmix(least) ^ _SALT) >> np.uint64(32):
        at = np.flatnonzero(flat == own)
        who, first = np.unique(owner[at], return_index=True)
        if len(who) == len(grams):
            to = place - place[at[first]][owner] + span - 1
            near = (to >= 0) & (to < 2 * span - 1)
            out[owner[near], to[near]] = flat[near]
            break
    return out


def _certain(around: np.ndarray, pairs: np.ndarray, span: int, least: int) -> np.ndarray:
    """Which pairs have enough equal n-grams in ``span`` places at equal distances from that of the list: they are alike.

    No word is put in or left out between such places, so they lie on one diagonal.
    """
    out = np.zeros(len(pairs), np.bool_)
    for a in range(0, len(pairs), ROWS):
        k, o = pairs[a:a + ROWS].T
        met = np.zeros((len(k), 2 * span), np.int16)
        np.cumsum(around[k] == around[o], axis=1, dtype=np.int16, out=met[:, 1:])
        out[a:a + ROWS] = (met[:, span:] - met[:, :-span] >= least).any(axis=1)
    return out


def _likely(around: np.ndarray, todo: np.ndarray, span: int, least: int) -> Iterator[np.ndarray]:
    """Pairs among ``todo`` that agree so often next to the list's n-gram as any that ``_certain`` finds."""
    side = span // 4
    middle = np.ascontiguousarray(around[:, span - 1 - side:span + side].T)
    step = max(1, PLACES // len(todo))
    for a in range(0, len(todo), step):
        rows = todo[a:a + step]
        if rows.any():
            same = np.zeros(rows.shape, np.int16)
            for v in middle:
                same += v[a:a + step, None] == v[None, :]
            # a stretch of span places has all of one side, and may differ in a few
            yield np.argwhere(rows & (same > side - (span - least))) + [a, 0]


def _stitched(windows: list[tuple[int, np.ndarray]], gap: int, fill: int) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of all windows (l, n-grams) of a text, and their places; between windows at most ``gap`` places of ``fill``."""
    grams, places, end = [], [], None
    for l, g in sorted(windows, key=lambda w: w[0]):
        if end is not None and l > end:
            n = min(gap, l - end)
            grams.append(np.full(n, fill, np.uint32))
            places.append(np.arange(end, end + n))
        new = g if end is None else g[max(0, end - l):]
        grams.append(new)
        places.append(np.arange(l + len(g) - len(new), l + len(g)))
        end = l + len(g) if end is None else max(end, l + len(g))
    return np.concatenate(grams), np.concatenate(places)


class _Turn:
    """Lists of much the same texts, met one after the other: what one finds is known to the next.

    A pair is verified if it can be alike (enough places of each window are in
    the other) and can add something: an n-gram outside the passages known so
    far, or a link between two classes. It is verified once, over all windows
    that its texts have in these lists. ``sparing`` asks for an n-gram with
    enough others around it, and lets the likest partners go first.
    The pairs that add nothing are links as well: ``partners`` settles them all.
    """

    def __init__(self, lists: list[list[dict]], span: int, threshold: float, sparing: bool = True):
        self.lists = sorted(lists, key=lambda items: (-len(items), items[0]["value"]))
        self.span, self.threshold, self.sparing = span, threshold, sparing
        self.windows: dict[int, list[dict]] = {}
        self.quiet: dict[int, list[dict]] = {}
        for items in self.lists:
            windows = self.quiet if items[0].get("quiet") else self.windows
            for t in items:
                windows.setdefault(t["node"], []).append(t)
        self.nodes = np.array(sorted({*self.windows, *self.quiet}), np.int64)
        self.number = {node: k for k, node in enumerate(self.nodes.tolist())}
        # a bit for each pair of texts (the greater number's row) that is known to be linked
        self.linked = np.zeros((len(self.nodes), -(-len(self.nodes) // 8)), np.uint8)
        self.up: dict[int, int] = {}
        self.label = {t["node"]: t["label"] for items in lists for t in items}
        self.done: set[tuple[int, int]] = set()
        self.texts: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        self.grams: dict[int, np.ndarray] = {}

    def root(self, label: int) -> int:
        while label in self.up:
            label = self.up[label]
        return label

    def text(self, node: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """N-grams, their places, and whether each lies in no known passage that a smaller text has, and in none at all."""
        if node not in self.texts:
            windows = self.windows[node]
            each = [np.frombuffer(t["grams"], np.uint32) for t in windows]
            grams, places = _stitched([(t["l"], g) for t, g in zip(windows, each, strict=True)], self.span, self.number[node])
            free = [np.ones(len(places), np.bool_) for _ in range(2)]
            first = np.searchsorted(places, [t["l"] for t in windows]).tolist()
            for t, a in zip(windows, first, strict=True):
                t["at"] = a
            for flags, column in zip(free, ("late", "spans"), strict=True):
                for a, f in zip(first, _uncovered(windows, each, column), strict=True):
                    flags[a:a + len(f)] &= f
            self.texts[node] = (grams, places, *free)
        return self.texts[node]

    def links(self) -> Iterator[tuple[int, int, list, list]]:
        """Links (node, other, spans, other spans) that the stars have left out."""
        for items in self.lists:
            if not items[0].get("quiet"):
                yield from self.met(sorted(items, key=lambda t: (t["node"], t["l"])))

    def link(self, k: np.ndarray, o: np.ndarray) -> None:
        """Notes that the texts of number k and o (k > o) are linked."""
        np.bitwise_or.at(self.linked, (k, o >> 3), (1 << (o & 7)).astype(np.uint8))

    def partners(self) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
        """Nodes, and for each of them all that it is linked with in these lists, but for those that the stars have verified."""
        left = [self.settled(sorted(items, key=lambda t: (t["node"], t["l"]))) for items in self.lists]
        left = _distinct(np.concatenate(left)) if left else np.zeros(0, np.int64)
        k, o = left // len(self.nodes), left % len(self.nodes)
        left = left[self.linked[k, o >> 3] >> (o & 7) & 1 == 0].tolist()
        for some in batched(left, AHEAD):
            pairs = [divmod(p, len(self.nodes)) for p in some]
            found = alike_all([(self.whole(k), self.whole(o)) for k, o in pairs], self.span, self.threshold)
            met = np.array([p for p, f in zip(pairs, found, strict=True) if f], np.int64).reshape(-1, 2)
            self.link(met[:, 0], met[:, 1])
        for a in range(0, len(self.nodes), GIVEN):
            smaller = np.unpackbits(self.linked[a:a + GIVEN], axis=1, bitorder="little")
            greater = np.unpackbits(self.linked[:, a // 8:(a + GIVEN) // 8], axis=1, bitorder="little").T
            each = [self.nodes[np.concatenate([np.flatnonzero(x), np.flatnonzero(y)])] for x, y in zip(smaller, greater)]
            has = [k for k, v in enumerate(each) if len(v)]
            yield self.nodes[a:a + GIVEN][has], [each[k] for k in has]

    def whole(self, k: int) -> np.ndarray:
        """The n-grams of all windows of the text of number ``k``."""
        if k not in self.grams:
            node = int(self.nodes[k])
            windows = [*self.windows.get(node, ()), *self.quiet.get(node, ())]
            self.grams[k] = _stitched([(t["l"], np.frombuffer(t["grams"], np.uint32)) for t in windows], self.span, k)[0]
        return self.grams[k]

    def settled(self, items: list[dict]) -> np.ndarray:
        """Notes the pairs of a list that are linked for certain; gives the others that can be alike, as numbers."""
        number = np.array([self.number[t["node"]] for t in items])
        blocks = np.array([t["block"] for t in items])
        todo = number[:, None] > number[None, :]
        todo[:, self.nodes[number] == items[0]["least"]] = False
        if (blocks != blocks[0]).any():
            todo &= blocks[:, None] != blocks[None, :]
        todo &= np.unpackbits(self.linked[number], axis=1, bitorder="little")[:, number] == 0
        if not todo.any():
            return number[:0]
        grams = [np.frombuffer(t["grams"], np.uint32) for t in items]
        least = _least(self.span, self.threshold)
        around = _around(grams, items[0]["value"], self.span)
        for pairs in _likely(around, todo, self.span, least):
            k, o = pairs[_certain(around, pairs, self.span, least)].T
            self.link(number[k], number[o])
        todo &= np.unpackbits(self.linked[number], axis=1, bitorder="little")[:, number] == 0
        if not todo.any():
            return number[:0]
        seen = _seen(len(items), _shared(grams))
        k, o = np.nonzero(todo & (seen >= least) & (seen.T >= least))
        return number[k] * len(self.nodes) + number[o]

    def met(self, items: list[dict]) -> Iterator[tuple[int, int, list, list]]:
        for t in items:
            t["label"] = self.root(t["label"])
        nodes = [t["node"] for t in items]
        texts = [self.text(t["node"]) for t in items]
        grams = [np.frombuffer(t["grams"], np.uint32) for t in items]
        first = [t["at"] for t in items]
        least = _least(self.span, self.threshold)
        free = [[x[side][a:a + len(g)] for x, a, g in zip(texts, first, grams, strict=True)] for side in (2, 3)]
        if not self.sparing:
            pairs = _candidates(items, grams, *free, least)
            # the stars have verified the pairs of a list's least text
            pairs = [(k, o) for k, o in pairs.tolist() if nodes[o] != items[o]["least"]]
            yield from self.verified([(nodes[k], nodes[o]) for k, o in pairs], self.adding(pairs, nodes, grams, free))
            return
        columns = _columns(grams)
        possible = _possible(grams, columns, self.span, least)

        def flags() -> list[list[np.ndarray]]:
            return [[f & p for f, p in zip(side, possible, strict=True)] for side in free]

        pairs = _candidates(items, grams, *flags(), least, likest=True)
        # one partner of every window goes first, then two, then four: what they find spares later ones
        step = np.log2(1 + np.arange(len(pairs)) - np.searchsorted(pairs[:, 0], pairs[:, 0])).astype(np.int64)
        step = np.minimum(step, STEPS)
        for k in range(STEPS + 1):
            mine = np.flatnonzero(step == k)
            if len(mine) > FEW:
                root = np.array([self.root(t["label"]) for t in items])
                same = root[pairs[mine, 0]] == root[pairs[mine, 1]]
                same[same] = ~_adding(pairs[mine[same]], columns, *flags(), self.span, least)
                mine = mine[~same]
            yield from self.verified([(nodes[a], nodes[b]) for a, b in pairs[mine].tolist()])

    def adding(self, pairs: list[tuple[int, int]], nodes: list[int], grams: list[np.ndarray], free: list[list[np.ndarray]]) -> Callable[[int], bool]:
        """Whether by now one of the pairs (k, o) of windows has an n-gram of a flagged place in common, or joins two classes."""
        sets: dict[int, set[int]] = {}
        left: dict[tuple[int, int], tuple[int, set[int]]] = {}

        def grams_of(k: int) -> set[int]:
            if k not in sets:
                sets[k] = set(grams[k].tolist())
            return sets[k]

        def flagged(side: int, k: int) -> set[int]:
            # flags only go, so their number tells whether they are as before
            n = int(np.count_nonzero(free[side][k]))
            if left.get((side, k), (-1,))[0] != n:
                left[side, k] = n, set(grams[k][free[side][k]].tolist())
            return left[side, k][1]

        def adds(at: int) -> bool:
            k, o = pairs[at]
            return not (flagged(0, k).isdisjoint(grams_of(o)) and flagged(1, o).isdisjoint(grams_of(k))
                        and self.root(self.label[nodes[k]]) == self.root(self.label[nodes[o]]))

        return adds

    def verified(self, pairs: list[tuple[int, int]], adds: Callable[[int], bool] | None = None) -> Iterator[tuple[int, int, list, list]]:
        """Links of the pairs (node, other) that add something: those that ``adds`` says of their number, or as flags of places tell."""
        for at in range(0, len(pairs), AHEAD):
            ready = list(dict.fromkeys(p for k, p in enumerate(pairs[at:at + AHEAD], at) if p not in self.done and (adds is None or adds(k))))
            self.done.update(ready)
            some, texts, free = [], [], []
            for node, other in ready:
                x, y = self.text(node), self.text(other)
                joins = self.root(self.label[node]) != self.root(self.label[other])
                # a pair that adds nothing now may be left out: known passages and classes only grow
                if adds or joins or x[2].any() or y[3].any():
                    some.append((node, other, x, y))
                    texts.append((x[0], y[0]))
                    free.append(None if adds or joins else (x[2], y[3]))
            for (node, other, x, y), found in zip(some, alike_all(texts, self.span, self.threshold, free), strict=True):
                if not found:
                    continue
                for a, b, c, d in found:
                    x[2][a:b] = x[3][a:b] = y[3][c:d] = False
                a, b = self.root(self.label[node]), self.root(self.label[other])
                if a != b:
                    self.up[a] = b
                self.link(np.array([self.number[node]]), np.array([self.number[other]]))
                yield (node, other, [{"start": int(x[1][a]), "end": int(x[1][b - 1]) + N} for a, b, _, _ in found],
                       [{"start": int(y[1][c]), "end": int(y[1][d - 1]) + N} for _, _, c, d in found])


def _partnered(rows: DataFrame, span: int, threshold: float) -> DataFrame:
    """The windows of ``rows`` (value, node, l, grams, ...) of which enough places have an n-gram of another window of their list.

    The others are in no pair that can be alike.
    """
    with_python(rows.sparkSession)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = [np.unique(np.frombuffer(g.as_py(), np.int32), return_counts=True) for g in batch.column(3)]
            at = pa.array(np.repeat(np.arange(len(grams)), [len(g) for g, _ in grams]))
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).take(at) for k in range(3)), *(pa.array(np.concatenate(v), pa.int32()) for v in zip(*grams, strict=True))],
                    names=["value", "node", "l", "gram", "times"])

    places = rows.select("value", "node", "l", "grams").mapInArrow(work, "value long, node long, l int, gram int, times int")
    shared = settle(places.groupBy("value", "gram").agg(F.count("*").alias("n")).filter("n > 1").select("value", "gram"), "shared")
    enough = places.join(broadcast_if_small(shared), ["value", "gram"]).groupBy("value", "node", "l").agg(
        F.sum("times").alias("times")).filter(F.col("times") >= _least(span, threshold)).select("value", "node", "l")
    return rows.join(settle(enough, "partnered"), ["value", "node", "l"], "left_semi")


def _rest(members: DataFrame, text: DataFrame, stars: DataFrame, span: int, threshold: float) -> DataFrame:
    """Links inside lists that do not go over the list's least text, and (node, partners): all texts that a text is linked with there.

    Lists whose windows lie in known passages of one class (quiet ones) add no
    place or class, only partners. Lists of one class have much the same texts and are met in turn in one
    task, so a pair is verified in one list and not in each that it is in.
    In those of over ``LINKED`` windows, whose pairs would grow with the square
    of a group, only pairs that can add a place are verified.
    Lists of over ``BLOCK`` windows are met in blocks, every block with every
    other, as work of many tasks and not as rows; windows of many classes
    that share little more than the list's n-gram are left out before.
    """
    known = members.filter("n > 2").join(_marked(stars), "node", "left").join(
        components(stars.select(F.col("node").alias("a"), F.col("other").alias("b"))), "node", "left")
    part = lambda name: F.filter(name, lambda s: (s["end"] - N >= F.col("l")) & (s["start"] <= F.col("r")))
    known = known.select("value", "node", "l", "r", "n", "least", F.coalesce("label", "node").alias("label"),
                         part("spans").alias("spans"), part("late").alias("late"))
    inside = F.exists(F.when(F.col("node") == F.col("least"), F.col("spans")).otherwise(F.col("late")),
                      lambda s: (s["start"] <= F.col("l")) & (s["end"] >= F.col("r") + N))
    known = settle(known.withColumn("bare", ~F.coalesce(inside, F.lit(False))), "known")
    other = F.when(F.col("node") != F.col("least"), F.col("node"))
    classes = known.groupBy("value", "label").agg(F.max("bare").alias("bare"), F.count("*").alias("n"), F.first("least").alias("least"),
                                                  (F.min(other) < F.max(other)).alias("texts"))
    todo = settle(classes.groupBy("value").agg(
        F.max("bare").alias("bare"), F.min("label").alias("a"), F.max("label").alias("b"), F.sum("n").alias("size"),
        F.count("*").alias("classes"), F.first("least").alias("near"), F.max("texts").alias("texts")).filter("bare or a < b or texts").select(
            "value", "size", "a", "near", (~F.col("bare") & (F.col("a") == F.col("b"))).alias("quiet"),
            ((F.col("size") > BLOCK) & (F.col("classes") * 2 > F.col("size"))).alias("loose")), "todo")
    # lists are met in turn by class, or in parts by their least text where a class has too many windows
    of = [todo.groupBy(k).agg(F.sum("size").alias(f"{k}_size")) for k in ("a", "near")]
    turn = F.when(F.col("a_size") <= TURN, F.xxhash64("a")).otherwise(
        F.xxhash64("a", "near", F.pmod(F.xxhash64("value"), F.ceil(F.col("near_size") / TURN))))
    turns = settle(todo.join(of[0], "a").join(of[1], "near").select("value", "quiet", "loose", turn.alias("turn")), "turns")
    spans, late = (F.when(~F.col("quiet"), F.col(c)).alias(c) for c in ("spans", "late"))
    listed = known.join(turns, "value").select("value", "node", "l", "r", "least", "label", spans, late, "turn", "quiet", "loose")

    def with_grams(rows: DataFrame) -> DataFrame:
        grams = F.substring("grams", (F.col("l") - F.col("lo")) * 4 + 1, (F.col("r") - F.col("l") + 1) * 4).alias("grams")
        return rows.join(text, "node").select(*rows.columns, grams)

    # n-grams go with their windows only once these are dealt to cells
    listed = listed.filter("not loose").union(
        _partnered(with_grams(listed.filter("loose")).select("value", "node", "l", "grams", *listed.columns[3:]), span, threshold).select(listed.columns))
    rows = settle(listed.drop("loose"), "windows")
    size = rows.groupBy("value", "turn").agg(F.count("*").alias("size")).filter("size > 1")
    long = size.filter(F.col("size") > BLOCK).groupBy("turn").agg(F.ceil(F.max("size") / BLOCK).alias("blocks"))
    size = settle(size.join(long, "turn", "left").select(
        "value", F.when(F.col("size") > BLOCK, F.col("blocks")).otherwise(1).alias("blocks"), (F.col("size") > LINKED).alias("sparing")), "sizes")
    rows = with_grams(rows.join(size, "value")).withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
    rows = rows.withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cell = F.when(F.col("blocks") == 1, F.col("turn")).otherwise(
        F.xxhash64("turn", F.least("block", "c"), F.greatest("block", "c")))
    rows = rows.select(cell.alias("cell"), "sparing", "value", "node", "l", "least", "label", "spans", "late", "grams", "block", "quiet")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists: dict[int, list[dict]] = {}
        for batch in batches:
            for t in batch.to_pylist():
                lists.setdefault(t["value"], []).append(t)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        schema = pa.schema([("node", pa.int64()), ("other", pa.int64()), ("spans", kind), ("other_spans", kind),
                            ("partners", pa.list_(pa.int64()))])
        turn = _Turn(list(lists.values()), span, threshold, t["sparing"])
        # links of a large class are many; as Python objects only a part of them is held
        for part in batched(turn.links(), LINK_ROWS):
            yield pa.record_batch([*(pa.array(v, f.type) for v, f in zip(zip(*part, strict=True), schema)),
                                   pa.nulls(len(part), schema[4].type)], schema=schema)
        for nodes, partners in turn.partners():
            none = [pa.nulls(len(nodes), f.type) for f in list(schema)[1:4]]
            ends = np.cumsum([0, *map(len, partners)]).astype(np.int32)
            yield pa.record_batch([pa.array(nodes), *none, pa.ListArray.from_arrays(
                ends, np.concatenate(partners) if partners else np.zeros(0, np.int64))], schema=schema)

    return rows.groupBy("sparing", "cell").applyInArrow(work, PARTNERS)


def _verified(pairs: DataFrame, text: DataFrame, span: int, threshold: float) -> DataFrame:
    """(node, other, spans, other_spans): the pairs (node, other, xl, xr, yl, yr) that have passages in common."""
    other = text.select(F.col("node").alias("other"), F.col("lo").alias("olo"), F.col("grams").alias("ograms"))

    def cut(grams: str, lo: str, a: str, b: str):
        return F.substring(F.col(grams), (F.col(a) - F.col(lo)) * 4 + 1, (F.col(b) - F.col(a) + 1) * 4)

    rows = pairs.join(text, "node").select("node", "other", "xl", cut("grams", "lo", "xl", "xr").alias("x"), "yl", "yr").join(
        other, "other").select("node", "other", "xl", "x", "yl", cut("ograms", "olo", "yl", "yr").alias("y"))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            keep, mine, theirs = [], [], []
            rows = batch.to_pylist()
            pairs = [(np.frombuffer(r["x"], np.uint32), np.frombuffer(r["y"], np.uint32)) for r in rows]
            for k, (r, found) in enumerate(zip(rows, alike_all(pairs, span, threshold), strict=True)):
                if found:
                    keep.append(k)
                    mine.append([{"start": r["xl"] + a, "end": r["xl"] + b + N - 1} for a, b, _, _ in found])
                    theirs.append([{"start": r["yl"] + a, "end": r["yl"] + b + N - 1} for _, _, a, b in found])
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(mine, spans), pa.array(theirs, spans)],
                names=["node", "other", "spans", "other_spans"])

    return rows.mapInArrow(work, LINKS)


def passage_links(docs: DataFrame, passage: int = PASSAGE, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Links (node, other, spans, other_spans) that make all passages and classes, as word spans, other < node; and (node, n_links).

    First every list is a star around its least text; then the windows of a
    list that the star leaves unmarked, or in other classes, meet each other.
    ``n_links`` counts all alike texts that a text meets in any list, also over
    links that would add no passage; their pairs are never rows.
    """
    span = passage - N + 1
    in_list = Window.partitionBy("value")
    members = settle(windows(docs, passage).select(
        "*", F.min("node").over(in_list).alias("least"), F.max("node").over(in_list).alias("most"),
        F.count("*").over(in_list).alias("n")).filter("least < most").select("value", "node", "l", "r", "least", "n"), "members")
    own = members.filter("node = least").groupBy("value").agg(F.min("l").alias("yl"), F.max("r").alias("yr"))
    pairs = settle(members.filter("node <> least").join(own, "value").groupBy("node", F.col("least").alias("other")).agg(
        F.min("l").alias("xl"), F.max("r").alias("xr"), F.min("yl").alias("yl"), F.max("yr").alias("yr")), "pairs")
    needed = settle(members.groupBy("node").agg(F.min("l").alias("lo"), F.max("r").alias("hi")), "needed")
    text = settle(contents(docs, needed), "contents")
    stars = settle(_verified(pairs, text, span, threshold), "stars")
    rest = settle(_rest(members, text, stars, span, threshold), "rest")
    links = stars.union(rest.filter("other is not null").select(stars.columns)).groupBy("node", "other").agg(
        F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("other_spans")).alias("other_spans"))
    partners = rest.filter("other is null").select("node", "partners").union(
        stars.select("node", F.array("other"))).union(stars.select("other", F.array("node")))
    return links, partners.groupBy("node").agg(F.size(F.array_distinct(F.flatten(F.collect_list("partners")))).alias("n_links"))


def copies(docs: DataFrame, passage: int = PASSAGE) -> DataFrame:
    """(node, n_words) of every text of ``passage`` words or more that two or more rows have."""
    each = docs.filter("text is not null").select(F.xxhash64("text").alias("node"), "text")
    twice = settle(each.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1").select("node"), "copies")
    words = F.regexp_count(F.first("text"), F.lit(ANY_CASE))
    return each.join(broadcast_if_small(twice), "node").groupBy("node").agg(words.alias("n_words")).filter(F.col("n_words") >= passage)


def duplicate_passages(docs: DataFrame, passage: int = PASSAGE, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: (doc_id, class_id, n_links, n_dup_words, spans, removable).

    ``spans`` are word spans that another text has (nearly) as well, or all
    words of a text that another row has too; ``removable`` those that a text
    of smaller hash has, and all words of every copy but one (of least
    doc_id), which may go without loss; ``n_links`` counts the other texts
    that the text is linked with; texts linked over passages, and copies, share
    ``class_id``, their least doc_id.
    """
    links, degree = passage_links(docs, passage, threshold)
    links = settle(links, "passages")
    per_node = _marked(links).withColumnRenamed("late", "removable").join(degree, "node")
    label = components(links.select(F.col("node").alias("a"), F.col("other").alias("b")))
    nodes = settle(docs.select("doc_id", F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("node")).withColumn(
        "at", F.monotonically_increasing_id()), "passage-rows")
    named = nodes.groupBy("node").agg(F.min("doc_id").alias("least"), F.min(F.struct(
        F.col("doc_id").isNull(), "doc_id", "at")).getField("at").alias("kept")).join(label, "node", "left").withColumn(
            "label", F.coalesce("label", "node"))
    class_of = named.groupBy("label").agg(F.min("least").alias("class_id"))
    result = settle(named.filter("node is not null").join(class_of, "label").join(
        per_node.select("node", "n_links", "spans", "removable"), "node", "left").join(copies(docs, passage), "node", "left").select(
            "node", "class_id", "n_links", "spans", "removable", "n_words", "kept"), "passage-nodes")
    none = F.array().cast("array<struct<start:int,end:int>>")
    wordless = F.col("node").isNull()
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").alias("end")))
    spans = F.when(F.col("n_words").isNotNull(), whole).otherwise(F.coalesce("spans", none))
    removable = F.when(F.col("n_words").isNotNull() & (F.col("at") != F.col("kept")), whole).otherwise(F.coalesce("removable", none))
    return nodes.join(result, "node", "left").select(
        "doc_id", F.when(wordless, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), spans.alias("spans"), removable.alias("removable")).select(
            "doc_id", "class_id", "n_links",
            F.aggregate("spans", F.lit(0).cast("long"), lambda t, s: t + s["end"] - s["start"]).alias("n_dup_words"), "spans", "removable")
