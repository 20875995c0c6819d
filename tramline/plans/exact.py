"""Exact rounding that gives the same answer in Spark and in SQL engines.

Averages are computed as integer half-away-from-zero division of the sum by
the count, so neither a floating-point mean nor an intermediate decimal
rounding can flip the last digit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _idiv(a: Column, b: Column) -> Column:
    """Floor division of a non-negative by a positive integer, exactly."""
    return ((a - F.pmod(a, b)).cast("decimal(38,0)") / b.cast("decimal(38,0)")).cast("long")


def avg_half_up(units: Column, digits: int, units_scale: int = 0, default=None) -> Column:
    """Aggregate: mean of an integer column ``units`` (value * 10^units_scale),
    rounded half away from zero to ``digits`` decimals, as ``decimal(18,digits)``."""
    s = F.sum(units.cast("long"))
    n = F.count(units)
    num = F.abs(s) * F.lit(2 * 10 ** digits) + n * F.lit(10 ** units_scale)
    den = n * F.lit(2 * 10 ** units_scale)
    q = F.signum(s).cast("long") * _idiv(num.cast("long"), den.cast("long"))
    out = (q.cast("decimal(18,0)") / F.lit(10 ** digits)).cast(f"decimal(18,{digits})")
    if default is not None:
        out = F.coalesce(out, F.lit(default).cast(f"decimal(18,{digits})"))
    return out


def sql_avg_half_up(units: str, digits: int, units_scale: int = 0, default=None) -> str:
    """SQL text of ``avg_half_up`` (DuckDB dialect)."""
    s = f"sum(cast({units} as bigint))"
    n = f"count({units})"
    num = f"(abs({s}) * {2 * 10 ** digits} + {n} * {10 ** units_scale})"
    den = f"({n} * {2 * 10 ** units_scale})"
    q = f"(sign({s}) * ({num} // {den}))"
    step = "1" if digits == 0 else "0." + "0" * (digits - 1) + "1"
    out = f"cast(cast({q} as decimal(18,0)) * {step} as decimal(18,{digits}))"
    if default is not None:
        out = f"coalesce({out}, cast({default} as decimal(18,{digits})))"
    return out


def pct_half_up(num: Column, den: Column, digits: int = 1) -> Column:
    """Row-wise ``num * 100 / den`` for integers, half away from zero; null when den is 0."""
    d = F.nullif(den.cast("long"), F.lit(0))
    n = num.cast("long")
    scaled = F.abs(n) * F.lit(200 * 10 ** digits) + F.abs(d)
    q = F.signum(n).cast("long") * F.signum(d).cast("long") * _idiv(scaled, F.abs(d) * F.lit(2))
    return (q.cast("decimal(18,0)") / F.lit(10 ** digits)).cast(f"decimal(18,{digits})")


def sql_pct_half_up(num: str, den: str, digits: int = 1) -> str:
    d = f"nullif(cast({den} as bigint), 0)"
    n = f"cast({num} as bigint)"
    q = f"(sign({n}) * sign({d}) * ((abs({n}) * {200 * 10 ** digits} + abs({d})) // (abs({d}) * 2)))"
    step = "0." + "0" * (digits - 1) + "1"
    return f"cast(cast({q} as decimal(18,0)) * {step} as decimal(18,{digits}))"
