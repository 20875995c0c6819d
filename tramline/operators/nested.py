"""Semi-structured columns: JSON arrays and PostgreSQL array literals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_json(col: Column | str, ddl: str, strict: bool = True) -> Column:
    """``from_json`` with a declared schema; ``strict`` fails the job on bad JSON."""
    c = F.col(col) if isinstance(col, str) else col
    return F.from_json(c, ddl, {"mode": "FAILFAST"} if strict else {})


def pg_int_array(col: Column | str) -> Column:
    """Parse ``{1,2,3}`` / ``{}`` array text into ``array<int>``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.from_json(F.translate(c, "{}", "[]"), "array<int>", {"mode": "FAILFAST"})


def explode_array(df: DataFrame, array_col: str, alias: str = "elem", outer: bool = True) -> DataFrame:
    """One row per element; with ``outer`` a null or empty array keeps its row with a null element."""
    gen = F.explode_outer if outer else F.explode
    return df.select(*[c for c in df.columns if c != array_col], gen(array_col).alias(alias))


def explode_json(df: DataFrame, json_col: str, ddl: str, alias: str = "elem", outer: bool = True,
                 strict: bool = True) -> DataFrame:
    """Parse a JSON array column and unnest it (a lateral left join when ``outer``)."""
    parsed = df.withColumn(json_col, parse_json(json_col, ddl, strict))
    return explode_array(parsed, json_col, alias, outer)
