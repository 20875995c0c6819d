"""The queries of this subpackage over the given tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tramline.llm.queries import alignment as q12
from tramline.llm.queries import decontaminate as q3
from tramline.llm.queries import licenses as q5
from tramline.llm.queries import near_vectors as q13
from tramline.llm.queries import ngram_join as q1
from tramline.llm.queries import packing as q9
from tramline.llm.queries import pii as q6
from tramline.llm.queries import repetition as q8
from tramline.llm.queries import secrets as q7
from tramline.llm.queries import sharding as q2
from tramline.llm.queries import substrings as q4
from tramline.llm.queries import token_files as q10
from tramline.llm.queries import whitening as q11

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

for _module in (q1, q2, q3, q4, q5, q6, q7, q8, q9, q10, q11, q12, q13):
    QUERIES[_module.NAME] = _module.query
    if _module.SQL:
        ORACLE_SQL[_module.NAME] = _module.SQL
