"""Physical-plan properties that the scale design relies on."""

import contextlib
import io
import re

import pytest

from tests.conftest import SF_SMALL
from tramline.plans.catalog import CATALOG

STREAMING = {"stream_upsert", "stream_latest", "stream_waits", "stream_late", "stream_windows", "purge_replay",
             "seed_scan", "stream_recent", "topic_ticks", "live_marts"}


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", [n for n in CATALOG if n not in STREAMING])
def test_no_unexpected_nested_loop_join(spark, name):
    text = plan(CATALOG[name].fn(spark, SF_SMALL))
    assert "BroadcastNestedLoopJoin" not in text
    assert "CartesianProduct" not in text


def test_lookback_bound_reaches_the_scan(spark):
    text = plan(CATALOG["current_clock"].fn(spark, SF_SMALL))
    assert re.search(r"PushedFilters: \[.*EqualTo\(ts,ScalarSubquery", text)


def test_latest_state_aggregates_before_shuffle(spark):
    text = plan(CATALOG["distinct_on_latest"].fn(spark, SF_SMALL)).split("===== Subqueries")[0]
    assert "Window" not in text
    assert re.search(r"partial_max\(struct", text)


def test_scans_read_only_used_columns(spark):
    text = plan(CATALOG["utilization"].fn(spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<(.*)>", text)
    lineitem = [s for s in schemas if "l_orderkey" in s][0]
    assert "l_shipdate" not in lineitem and "l_returnflag" not in lineitem


def test_chunk_edge_join_keeps_window_partitioning(spark):
    """Without broadcasts, the large side of the edge-fix join is the window
    output itself: only one hash exchange on (_chunk, key) feeds the window,
    and the join adds none on that side."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(CATALOG["wait_times"].fn(spark, SF_SMALL)).split("===== Subqueries")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    tree = text.split("\n\n")[0]
    smj = [line for line in tree.splitlines() if "SortMergeJoin" in line]
    assert smj, tree
    # the left child chain of the join reaches the Window without an Exchange in between
    lines = tree.splitlines()
    start = lines.index(smj[0])
    left = []
    for line in lines[start + 1:]:
        if "Window" in line:
            left.append(line)
            break
        left.append(line)
    assert any("Window" in x for x in left) and not any("Exchange" in x for x in left), "\n".join(left)
