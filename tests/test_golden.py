"""Golden values hand-computed from the five seed events and the seed calendar rows."""
from pyspark.sql import functions as F

from sensorwerk.operators import aggregates as A
from sensorwerk.operators import dims
from sensorwerk.plans import reports
from tests import seeds


def test_hourly_kpis_from_seed(spark):
    h = A.hourly_plant_kpis(seeds.seed_events(spark), seeds.seed_plants(spark))
    got = {(r.event_hour.hour, r.plant_id): (r.total_events, r.alarm_count, round(r.alarm_rate_pct, 2))
           for r in h.collect()}
    assert got == {(8, "LYON-01"): (3, 1, 33.33), (9, "LYON-01"): (1, 1, 100.0), (9, "PARIS-01"): (1, 0, 0.0)}


def test_weekly_mart_from_seed(spark):
    m = reports.weekly_plant_mart(seeds.seed_events(spark), seeds.seed_plants(spark), since="2024-01-01")
    got = {r.plant_id: r for r in m.collect()}
    lyon, paris = got["LYON-01"], got["PARIS-01"]
    assert str(lyon.week_start) == "2024-05-13"
    assert (lyon.total_events, lyon.total_alarms, lyon.alarm_rate_pct, lyon.sla_status) == (4, 2, 50.0, "NON-COMPLIANT")
    assert lyon.high_anomalies == 1  # 0.8 is not > 0.8
    assert (paris.total_events, paris.total_alarms, paris.alarm_rate_pct, paris.sla_status) == (1, 0, 0.0, "COMPLIANT")
    assert lyon.alarm_wow_delta_pct is None


def test_calendar_matches_seed_rows(spark):
    expected = {r.date_sk: r for r in seeds.seed_dates(spark).collect()}
    bounds = spark.sql("select date'2024-01-01' as lo, date'2024-12-31' as hi")
    cal = dims.calendar_between(bounds).filter(F.col("date_sk").isin(list(expected)))
    got = {r.date_sk: r for r in cal.collect()}
    assert set(got) == set(expected)
    for k, exp in expected.items():
        assert got[k].asDict() == exp.asDict(), (got[k], exp)
