"""Every registered query against its DuckDB oracle on the smallest driver tables."""
import pytest

import __spark_entry__ as E
from sensorwerk.plans.queries import QUERIES
from tests.conftest import SF_SMALL
from tools.oracle_check import compare, duck

NAMES = sorted(QUERIES)          # the library's own; tests/llm has the optional ones


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, E.queries()[name], E.oracle_sql().get(name), SF_SMALL, con)
    assert r["status"] in ("OK", "rows-only"), r


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "sla_status" in df.columns


def test_every_query_has_oracle_or_is_declared_rows_only():
    rows_only = {"approx_distinct_weekly", "weekly_report_after_hll", "weekly_report_after_sketch",
                 "dataset_size_report"}
    missing = set(QUERIES) - set(E.oracle_sql())
    assert missing == rows_only


TIME_SENSITIVE = ["weekly_plant_mart", "hourly_plant_kpis", "log_enriched", "iot_partition_cols", "calendar_dim",
                  "threshold_alerts", "minute_window_agg", "wow_alarms", "sk_lookup"]


@pytest.mark.parametrize("name", TIME_SENSITIVE)
def test_query_independent_of_session_time_zone(spark, con, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        r = compare(spark, name, E.queries()[name], E.oracle_sql().get(name), SF_SMALL, con)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert r["status"] == "OK", r
