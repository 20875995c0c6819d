"""CSV seed scans with declared schemas.

Array cells use the PostgreSQL literal form ``{1,2,3}``; JSON cells are
quoted text. Both are read as strings and parsed with native expressions;
bad JSON fails the read (``FAILFAST``), as a jsonb cast would.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.operators.nested import parse_json, pg_int_array


def read_seed(spark: SparkSession, path: str, schema: T.StructType,
              array_cols: Sequence[str] = (), json_cols: dict[str, str] | None = None) -> DataFrame:
    """Read a headered CSV into ``schema``.

    ``array_cols`` hold ``{..}`` integer-array literals; ``json_cols`` maps a
    column to the DDL of its JSON value. Columns of ``schema`` absent from
    the file (e.g. ``created_at``) come back null.
    """
    json_cols = json_cols or {}
    raw = (spark.read.option("header", True).option("escape", '"').option("mode", "FAILFAST")
           .csv(path))
    cols = []
    for f in schema.fields:
        if f.name not in raw.columns:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif f.name in array_cols:
            cols.append(pg_int_array(f.name).cast(f.dataType).alias(f.name))
        elif f.name in json_cols:
            cols.append(parse_json(f.name, json_cols[f.name]).cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, T.IntegerType):
            # integer seeds may be written as 7 or 7.0
            cols.append(F.col(f.name).cast("double").cast("int").alias(f.name))
        else:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
    return raw.select(*cols)
