"""Write PLANS.md: a one-line physical-plan summary per registered query.

For each query (built over $PLANS_SF_DIR, default sf0.1) it counts shuffle
exchanges, join strategies, aggregate and window operators, and lists every
Parquet scan with its read columns and pushed filters, from
``explain("formatted")`` of the planned query (not executed).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SKIP_EXECUTING = {"stream_upsert", "stream_latest", "stream_waits", "stream_late", "stream_windows", "purge_replay",
                  "seed_scan"}


def summarize(text: str) -> dict:
    ops = re.findall(r"^\(\d+\) ([A-Za-z]+)", text, re.M)
    count = lambda name: sum(1 for o in ops if o == name)
    scans = []
    for block in (b.strip() for b in re.split(r"\n\n", text)):
        if block.startswith("(") and "Scan parquet" in block.splitlines()[0]:
            loc = re.search(r"Location: \w+ \[(.*?)\]", block)
            rs = re.search(r"ReadSchema: struct<(.*)>", block)
            pf = re.search(r"PushedFilters: \[(.*)\]", block)
            table = os.path.basename(loc.group(1).split(",")[0]).replace(".parquet", "") if loc else "?"
            cols = [c.split(":")[0] for c in re.split(r",(?![^<]*>)", rs.group(1))] if rs else []
            scans.append(f"{table}({len(cols)} cols{'; ' + pf.group(1) if pf and pf.group(1) else ''})")
    return {
        "exchanges": count("Exchange"), "broadcasts": count("BroadcastExchange"),
        "bhj": count("BroadcastHashJoin"), "smj": count("SortMergeJoin"), "shj": count("ShuffledHashJoin"),
        "bnlj": count("BroadcastNestedLoopJoin"), "hash_agg": count("HashAggregate"),
        "sort_agg": count("SortAggregate"), "window": count("Window"), "scans": scans,
    }


def main() -> None:
    from tramline.session import get_spark
    from tramline.plans.catalog import CATALOG
    sf = os.environ.get("PLANS_SF_DIR", "/root/testdata/sf0.1")
    spark = get_spark("local[8]", 8, app="tramline-plans")
    rows = ["# PLANS", "",
            f"Physical plans of the registered queries over `{sf}` as planned by Catalyst with AQE on",
            "(before runtime re-planning). `Exch` counts shuffle exchanges (hash, range, single), `Bcast`",
            "broadcast exchanges; joins are BHJ / SMJ / BNLJ; scans list the table, the number of",
            "columns read and the filters pushed into the Parquet reader. Generated by `tools/plans.py`.",
            "Streaming queries are omitted (their plans are micro-batch plans).", "",
            "| query | Exch | Bcast | BHJ | SMJ | BNLJ | HashAgg | SortAgg | Window | scans |",
            "| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |"]
    for name, e in CATALOG.items():
        if name in SKIP_EXECUTING:
            continue
        df = e.fn(spark, sf)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue()
        main_plan = text.split("===== Subqueries =====")[0]
        s = summarize(text)
        m = summarize(main_plan)
        rows.append(f"| {name} | {m['exchanges']} | {m['broadcasts']} | {m['bhj']} | {m['smj']} | {m['bnlj']} | "
                    f"{m['hash_agg']} | {m['sort_agg']} | {m['window']} | {'; '.join(s['scans'])} |")
    with open(os.path.join(ROOT, "PLANS.md"), "w", encoding="utf-8") as fh:
        fh.write("\n".join(rows) + "\n")
    print("\n".join(rows))


if __name__ == "__main__":
    main()
