"""Physical-plan guards for every registered query: no cartesian / nested-loop joins, no
Python evaluation in the plan, filters and column pruning reaching the Parquet scan."""
import contextlib
import io

import pytest

import __spark_entry__ as E
from sensorwerk.plans.queries import QUERIES
from tests.conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "CollectLimit",
             "collect_list", "collect_set")   # no group is gathered into one row or task


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_forbidden_operators(spark, name):
    text = plan_text(E.queries()[name](spark, SF_SMALL))
    for op in FORBIDDEN:
        assert op not in text, f"{name} plans {op}"


def test_time_range_reaches_scan(spark):
    text = plan_text(E.queries()["weekly_report_after"](spark, SF_SMALL))
    scans = [b for b in text.split("\n\n") if "Scan parquet" in b and "events.parquet" in b]
    assert scans, text
    assert any("PushedFilters" in b and "GreaterThanOrEqual(ts" in b and "LessThan(ts" in b for b in scans), scans


def test_projection_pruned_at_scan(spark):
    text = plan_text(E.queries()["events_by_plant"](spark, SF_SMALL))
    scans = [b for b in text.split("\n\n") if "Scan parquet" in b and "events.parquet" in b]
    assert scans
    for b in scans:
        read = [ln for ln in b.splitlines() if "ReadSchema" in ln][0]
        assert "props" not in read and "value" not in read, read


def test_dedup_is_partial_aggregate(spark):
    """Keep-latest reduces each key before the shuffle (skew-safe), no full-row window."""
    text = plan_text(E.queries()["log_dedup_latest"](spark, SF_SMALL))
    assert text.count("SortAggregate") + text.count("HashAggregate") + text.count("ObjectHashAggregate") >= 2
    assert "partial_max_by" in text


def test_weekly_report_sketch_mode_scans_fact_once(spark):
    """Device counts from the roll-up's sketches: the week's events are read once."""
    df = E.queries()["weekly_report_after_sketch"](spark, SF_SMALL)
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    final = buf.getvalue().split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
    assert final.count("events.parquet") == 1, final


def test_bounded_broadcast_checks_size(spark):
    from sensorwerk.config import bounded_broadcast, plan_bytes
    small, big = spark.range(10), spark.range(1000)
    assert plan_bytes(small) == 80 and plan_bytes(big) == 8000
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    hinted = bounded_broadcast(small, 100)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == jobs        # nothing ran to decide
    assert "broadcast" in plan_text(big.join(hinted, "id")).lower()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_text(small.join(bounded_broadcast(big, 7999), "id"))
        assert "BroadcastHashJoin" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
