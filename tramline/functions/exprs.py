"""Scalar expressions used by the data products.

Every helper builds a Catalyst expression, so it stays inside whole-stage
codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tramline.schemas import WEEKDAY_CODES


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bands(value: Column | str, limits: Sequence[tuple[float, str]], default: str) -> Column:
    """Label of the first ``(limit, label)`` with ``value < limit``, else ``default``.

    The comparison is on the value as given (callers pass the unrounded one).
    A null value falls through to ``default``, like a SQL searched CASE.
    """
    v = _c(value)
    expr = None
    for limit, label in limits:
        expr = F.when(v < F.lit(limit), F.lit(label)) if expr is None else expr.when(v < F.lit(limit), F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def safe_pct(num: Column | str, den: Column | str, digits: int = 1) -> Column:
    """``round(num / nullif(den, 0) * 100, digits)`` as an exact decimal.

    Null when the denominator is 0 or null (ANSI division by zero would fail).
    """
    n = _c(num).cast("decimal(20,0)")
    d = F.nullif(_c(den), F.lit(0)).cast("decimal(20,0)")
    return F.round(n * F.lit(100) / d, digits).cast(f"decimal(18,{digits})")


def entity_status(segment_id: Column | str, station_id: Column | str) -> Column:
    """MOVING on a segment only, IN_STATION at a station only, else UNKNOWN."""
    seg, st = _c(segment_id), _c(station_id)
    return (F.when(seg.isNotNull() & st.isNull(), F.lit("MOVING"))
            .when(seg.isNull() & st.isNotNull(), F.lit("IN_STATION"))
            .otherwise(F.lit("UNKNOWN")))


def stop_index(history: Column | str) -> Column:
    """Index of the most recent stop: ``max(len(history) - 1, 0)``; 0 for null or empty."""
    return F.greatest(F.coalesce(F.size(_c(history)), F.lit(0)) - F.lit(1), F.lit(0))


def calendar_parts(year: Column | str, day_of_year: Column | str) -> dict[str, Column]:
    """Calendar date of (year, day-of-year) and its day name, month name and day."""
    date = F.date_add(F.make_date(_c(year), F.lit(1), F.lit(1)), _c(day_of_year) - F.lit(1))
    return {
        "actual_date": date,
        "day_name": F.date_format(date, "EEEE"),
        "month_name": F.date_format(date, "MMMM"),
        "day_of_month": F.dayofmonth(date),
    }


def tick_calendar(ticks_since_start: Column | str, start_year: int, start_day_of_year: int,
                  start_weekday: str, start_hour: int, start_minute: int) -> dict[str, Column]:
    """Clock fields after ``n`` one-minute ticks from a start row.

    Minutes carry into hours, hours into days; a day advances the weekday code
    and the day of year; day 366 becomes day 1 of the next year (365-day years).
    Closed form, so a tick range is a ``spark.range`` projection, not a loop.
    """
    n = _c(ticks_since_start).cast("long")
    total = F.lit(start_hour * 60 + start_minute) + n
    days = F.floor(total / F.lit(1440))
    doy_offset = F.lit(start_day_of_year - 1) + days
    codes = F.array(*[F.lit(c) for c in WEEKDAY_CODES])
    weekday_idx = F.pmod(F.lit(WEEKDAY_CODES.index(start_weekday)) + days, F.lit(7))
    return {
        "minute": F.pmod(total, F.lit(60)).cast("int"),
        "hour_of_day": F.pmod(F.floor(total / F.lit(60)), F.lit(24)).cast("int"),
        "day_of_week": F.element_at(codes, (weekday_idx + F.lit(1)).cast("int")),
        "day_of_year": (F.pmod(doy_offset, F.lit(365)) + F.lit(1)).cast("int"),
        "year": (F.lit(start_year) + F.floor(doy_offset / F.lit(365))).cast("int"),
    }


def clip_upper(value: Column | str, bound: Column | str | float) -> Column:
    """``least(value, bound)`` that keeps a null value null (``least`` skips nulls)."""
    v = _c(value)
    b = bound if isinstance(bound, Column) else (F.col(bound) if isinstance(bound, str) else F.lit(bound))
    return F.when(v.isNull(), F.lit(None)).otherwise(F.least(v, b))


def clock_text(hour: Column | str, minute: Column | str) -> Column:
    """Zero-padded ``HH:MM``."""
    return F.format_string("%02d:%02d", _c(hour), _c(minute))


def truncate_to(value: Column | str, digits: int) -> Column:
    """Truncate toward zero to ``digits`` decimals (not rounding)."""
    scale = 10 ** digits
    return (_c(value) * F.lit(scale)).cast("long") / F.lit(float(scale))


def pair_key(a: Column | str, b: Column | str) -> Column:
    """Order-free key of an unordered pair."""
    return F.array_sort(F.array(_c(a), _c(b)))


def lookup(value: Column | str, mapping: dict, error_on_missing: bool = False, what: str = "value") -> Column:
    """Literal map lookup; optionally raise for an unknown key."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    v = _c(value)
    got = m[v]
    if not error_on_missing:
        return got
    return F.when(got.isNull() & v.isNotNull(),
                  F.raise_error(F.concat(F.lit(f"unknown {what}: "), v.cast("string")))).otherwise(got)


def next_in_cycle(value: Column | str, cycle: Sequence[str]) -> Column:
    """Successor of ``value`` in a cyclic sequence (last wraps to first); null if unknown."""
    return lookup(value, {cycle[i]: cycle[(i + 1) % len(cycle)] for i in range(len(cycle))})
