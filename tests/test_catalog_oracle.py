"""Every registered query against its DuckDB oracle (the correctness gate, locally)."""

import pytest

from tests.conftest import SF_ORACLE
from tests.oracle import compare, duck
from tramline.plans.catalog import CATALOG

WITH_SQL = [n for n, e in CATALOG.items() if e.sql]


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_matches_oracle(spark, con, name):
    e = CATALOG[name]
    r = compare(spark, e.fn, e.sql, SF_ORACLE, con)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["hash_match"], r
    assert not r["type_mismatch"], r


def test_entry_contract(spark):
    import __spark_entry__ as se
    df = se.entry(spark)
    assert df.count() >= 0
    q, sql = se.queries(), se.oracle_sql()
    assert set(sql) <= set(q)
    assert len(q) >= 40
