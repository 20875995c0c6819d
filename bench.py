"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (nothing is collected
to the driver), once to warm up and then $BENCH_RUNS times; the per-query
figure is the median. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)


#: A query whose warm-up takes longer is measured once.
LONG_SECONDS = 15.0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from tramline.session import get_spark
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=cpus, app="tramline-bench",
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    from tramline.plans.catalog import CATALOG

    names = only or list(CATALOG)
    per_query: dict[str, float] = {}
    spread: dict[str, list[float]] = {}
    errors: dict[str, str] = {}
    for name in names:
        fn = CATALOG[name].fn
        try:
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
            long = time.perf_counter() - t0 > LONG_SECONDS
            times = []
            for _ in range(1 if long else runs):
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                times.append(time.perf_counter() - t0)
        except Exception as ex:  # keep measuring the others; report the failure
            errors[name] = f"{type(ex).__name__}: {str(ex)[:300]}"
            continue
        per_query[name] = round(statistics.median(times), 4)
        spread[name] = [round(min(times), 4), round(max(times), 4)]

    sf = os.path.basename(sf_dir).replace("sf", "")
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(per_query.values()), 4),
        "unit": "sec",
        "queries": per_query,
        "spread_min_max": spread,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "runs": runs,
        "cpus": cpus,
        "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
        "spark_version": spark.version,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
