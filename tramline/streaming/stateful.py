"""Stateful streaming operators.

``transition_waits`` holds a key's rows back until they are older than the
newest row by the tolerance, then walks them in order: a row that ends a wait
emits ``end - start``. Rows may arrive in any order within the tolerance and
across any number of micro-batches; the waits equal the batch answer. A row
that comes when a later one of its key has been walked is emitted with
``kind = 'late'`` instead, if it is not older than the horizon, beyond which
Spark itself drops rows. The state of a key is its last row and the rows
held back; a key without rows for the retention is forgotten. Keys share
states and calls of Pandas in a fixed number of groups.

``latest_per_key`` is the streaming form of latest-state: a grouped ``max``
over a struct, valid in update/complete mode (``row_number`` is not allowed
on streams).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

# the last row of every key of the group, and the rows held back
STATE_SCHEMA = ("key array<long>, last_t array<long>, last_tb array<long>, last_start array<boolean>, walked array<boolean>, "
                "seen_ms array<long>, held_key array<long>, t array<long>, tb array<long>, start array<boolean>, "
                "end array<boolean>, ms array<long>")
OUT_SCHEMA = "key long, t long, tb long, wait long, kind string"
_KEYS = [np.int64, np.int64, np.int64, np.bool_, np.bool_, np.int64]
_HELD = ["_k", "_t", "_tb", "_start", "_end", "_ms"]
_TYPES = [np.int64, np.int64, np.int64, np.bool_, np.bool_, np.int64]
#: Groups of keys that share a state row and a call of Pandas; a call costs milliseconds, its rows little.
GROUPS = 4096
_NULL_GROUP = -1
_LEAST = -(1 << 63)


def _walk(rows: list[np.ndarray], keys: np.ndarray, last: list[np.ndarray]) -> pd.DataFrame | None:
    """Waits and late rows of ``rows`` (by key, in order) after their keys' last rows, which are moved on."""
    last_t, last_tb, last_start, walked = last
    at = np.searchsorted(keys, rows[0])
    _, t, tb, start, end, _ = rows
    frames = []
    late = walked[at] & ((t < last_t[at]) | ((t == last_t[at]) & (tb < last_tb[at])))
    if late.any():
        frames.append(pd.DataFrame({"key": keys[at[late]], "t": t[late], "tb": tb[late],
                                    "wait": pd.array([pd.NA] * int(late.sum()), dtype="Int64"), "kind": "late"}))
    # the last row itself, delivered again, says nothing new
    good = ~late & ~(walked[at] & (t == last_t[at]) & (tb == last_tb[at]))
    at, t, tb, start, end = at[good], t[good], tb[good], start[good], end[good]
    if len(t):
        first = np.append(True, at[1:] != at[:-1])
        before_t = np.where(first, last_t[at], np.append(0, t[:-1]))
        ended = end & np.where(first, walked[at] & last_start[at], np.append(False, start[:-1]))
        if ended.any():
            frames.append(pd.DataFrame({"key": keys[at[ended]], "t": t[ended], "tb": tb[ended],
                                        "wait": pd.array((t - before_t)[ended], dtype="Int64"), "kind": "wait"}))
        end_of_key = np.append(first[1:], True)
        to = at[end_of_key]
        last_t[to], last_tb[to], last_start[to], walked[to] = t[end_of_key], tb[end_of_key], start[end_of_key], True
    return pd.concat(frames) if len(frames) > 1 else frames[0] if frames else None


def _waits_fn(ahead_ms: int, retention_ms: int | None, group: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    # Spark's watermark trails by the horizon; rows are final where it trails by the tolerance
    mark = state.getCurrentWatermarkMs()
    final = mark + ahead_ms if mark > 0 else 0
    known = [np.zeros(0, k) for k in _KEYS]
    parts: list[list[np.ndarray]] = []
    if state.exists:
        values = state.get
        known = [np.array(c, k) for c, k in zip(values[:6], _KEYS, strict=True)]
        parts.append([np.array(c, k) for c, k in zip(values[6:], _TYPES, strict=True)])
    if not state.hasTimedOut:
        parts += [[b[c].to_numpy(k) for c, k in zip(_HELD, _TYPES, strict=True)] for b in batches]
    held = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, k) for k in _TYPES]
    # every key of the group, with its last row if it was there before
    keys = np.unique(np.concatenate([known[0], held[0]]))
    old = np.searchsorted(keys, known[0])
    last = [np.zeros(len(keys), k) for k in _KEYS[1:]]
    for c, v in zip(last, known[1:], strict=True):
        c[old] = v
    *last, seen = last
    order = np.lexsort((held[2], held[1], held[0]))
    held = [c[order] for c in held]
    np.maximum.at(seen, np.searchsorted(keys, held[0]), held[5])
    # a message delivered twice is one row
    new = np.append(np.ones(min(1, len(order)), np.bool_), np.any([c[1:] != c[:-1] for c in held[:3]], axis=0))
    due = held[5] <= final
    out = _walk([c[new & due] for c in held], keys, last)
    held = [c[new & ~due] for c in held]
    waiting = np.isin(keys, held[0])
    stay = np.ones(len(keys), np.bool_) if retention_ms is None else waiting | (seen + retention_ms > final)
    if not stay.any():
        state.remove()
    else:
        state.update(tuple(c.tolist() for c in (keys[stay], *(c[stay] for c in last), seen[stay], *held)))
        due_at = held[5].tolist()
        if retention_ms is not None:
            due_at += (seen[stay & ~waiting] + retention_ms).tolist()
        if due_at:
            state.setTimeoutTimestamp(max(min(due_at) - ahead_ms, mark) + 1)
    if out is not None:
        if group[0] == _NULL_GROUP:
            out["key"] = pd.array([pd.NA] * len(out), dtype="Int64")
        yield out


def transition_waits(stream: DataFrame, key: str, t: Column | str, tiebreak: str, is_start, is_end,
                     event_time: str, tolerance_ms: int, horizon_ms: int, retention_ms: int | None = None,
                     once: bool = False) -> DataFrame:
    """Per key, in (t, tiebreak) order: a row with ``is_end`` right after a row
    with ``is_start`` emits ``t - t_start``.

    Output: ``key, t, tb, wait, kind`` where kind is ``wait`` or ``late``. A
    row is final once the newest ``event_time`` of the stream is
    ``tolerance_ms`` later, so a stream's last rows come out when later rows
    follow. Rows up to ``horizon_ms`` (the tolerance or more) behind are
    reported as late.
    Keys are dealt into ``GROUPS`` groups, and Pandas runs once per group and
    micro-batch, on whole columns of all its keys; bound the micro-batch size
    (``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``) so one group's rows of
    a batch stay small. With ``retention_ms``, a key with no
    rows for so much event time is forgotten, so the state store holds active
    keys only.
    """
    from functools import partial

    from tramline.session import ship_package
    if horizon_ms < tolerance_ms:
        raise ValueError("the horizon must not be shorter than the tolerance")
    ship_package(stream.sparkSession)
    tcol = F.col(t) if isinstance(t, str) else t
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    ms = F.timestamp_diff("MILLISECOND", epoch, F.col(event_time).cast("timestamp_ntz"))
    prepared = stream.select(
        F.col(key).cast("long").alias(key), tcol.cast("long").alias("_t"), F.col(tiebreak).cast("long").alias("_tb"),
        F.coalesce(is_start.cast("boolean"), F.lit(False)).alias("_start"),
        F.coalesce(is_end.cast("boolean"), F.lit(False)).alias("_end"),
        ms.alias("_ms"), F.timestamp_millis(ms).alias("_event_ts"))
    marked = prepared.withWatermark("_event_ts", f"{horizon_ms} milliseconds")
    if once:
        marked = marked.dropDuplicatesWithinWatermark([key, "_t", "_tb"])
    number = lambda c: F.coalesce(F.col(c), F.lit(_LEAST)).alias(c)
    group = F.when(F.col(key).isNull(), _NULL_GROUP).otherwise(F.pmod(F.xxhash64(key), F.lit(GROUPS)).cast("int"))
    dealt = marked.select(group.alias("_group"), F.coalesce(F.col(key), F.lit(0)).alias("_k"), number("_t"), number("_tb"),
                          "_start", "_end", number("_ms"), "_event_ts")
    return dealt.groupBy("_group").applyInPandasWithState(
        partial(_waits_fn, horizon_ms - tolerance_ms, retention_ms), OUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout)


RECENT_STATE = "t long, tb long, ms long, payload string"


def _recent_fn(lookback_ms: int, key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    mark = state.getCurrentWatermarkMs()
    if state.hasTimedOut:
        t, tb, ms, _ = state.get
        state.remove()
        yield pd.DataFrame({"key": [key[0]], "t": [t], "tb": [tb], "ms": [ms], "payload": [None], "gone": [True]})
        return
    best = tuple(state.get) if state.exists else None
    for b in batches:
        at = np.lexsort((b["_tb"].to_numpy(), b["_t"].to_numpy()))[-1]
        row = (int(b["_t"].iloc[at]), int(b["_tb"].iloc[at]), int(b["_ms"].iloc[at]), b["_payload"].iloc[at])
        if best is None or row[:2] > best[:2]:
            best = row
    state.update(best)
    state.setTimeoutTimestamp(max(best[2] + lookback_ms, mark) + 1)
    yield pd.DataFrame({"key": [key[0]], "t": [best[0]], "tb": [best[1]], "ms": [best[2]], "payload": [best[3]], "gone": [False]})


def recent_per_key(stream: DataFrame, key: str, t: Column, tiebreak: str, payload: Column, event_time: str,
                   lookback_ms: int, delay_ms: int) -> DataFrame:
    """O-T3 with look-back: the latest row of every key that has one within the look-back, in update mode.

    Output: ``key, t, tb, ms, payload, gone``; a key comes out when it has new
    rows, and once more with ``gone`` when its latest row is older than
    ``lookback_ms`` behind the stream's newest event time less ``delay_ms``: then
    its state is removed, so the state store holds keys of the look-back only.
    ``payload`` is a string column (``to_json`` of what is served).
    """
    from functools import partial

    from tramline.session import ship_package
    ship_package(stream.sparkSession)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    ms = F.timestamp_diff("MILLISECOND", epoch, F.col(event_time).cast("timestamp_ntz"))
    prepared = stream.select(F.col(key).cast("long").alias(key), t.cast("long").alias("_t"), F.col(tiebreak).cast("long").alias("_tb"),
                             ms.alias("_ms"), payload.alias("_payload"), F.timestamp_millis(ms).alias("_event_ts"))
    return prepared.withWatermark("_event_ts", f"{delay_ms} milliseconds").groupBy(key).applyInPandasWithState(
        partial(_recent_fn, lookback_ms), "key long, t long, tb long, ms long, payload string, gone boolean", RECENT_STATE,
        "update", GroupStateTimeout.EventTimeTimeout)


def latest_per_key(stream: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    fields = list(order) + [c for c in columns if c not in order]
    agg = stream.groupBy(*keys).agg(F.max(F.struct(*fields)).alias("_m"))
    return agg.select(*keys, *[F.col(f"_m.{c}").alias(c) for c in columns])

