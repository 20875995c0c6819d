"""Compare every registered query with its DuckDB oracle at one scale factor.

Usage: python tools/oracle_check.py [sf_dir] [query ...]
Prints one line per query: OK/BAD, Spark rows, oracle rows, seconds.
"""

from __future__ import annotations

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    from tests.oracle import compare, duck
    from tramline.plans.catalog import CATALOG
    from tramline.session import get_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or [n for n, e in CATALOG.items() if e.sql]
    spark = get_spark("local[8]", 8, app="tramline-oracle")
    con = duck(sf)
    bad = 0
    for name in names:
        e = CATALOG[name]
        t0 = time.time()
        try:
            r = compare(spark, e.fn, e.sql, sf, con)
            ok = r["ok"] and not r.get("type_mismatch")
            bad += not ok
            print(f"{name:24s} {'OK ' if ok else 'BAD'} {r['spark_rows']:>8} {r['oracle_rows']:>8} "
                  f"{time.time() - t0:6.1f}s", flush=True)
        except Exception as ex:  # report and continue
            bad += 1
            print(f"{name:24s} ERR {type(ex).__name__}: {str(ex)[:200]}", flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    spark.stop()


if __name__ == "__main__":
    main()
