"""Periodic alerts against a brute-force evaluation on the small tables, and the HyperLogLog
error bound."""
from collections import defaultdict
from datetime import timedelta

from pyspark.sql import functions as F

from sensorwerk.functions.columns import week_start
from sensorwerk.operators.alerts import period_alerts
from sensorwerk.sources import standins as T
from tests.conftest import SF_MID, SF_SMALL


def _brute(rows, threshold, periods, stat):
    step = timedelta(minutes=5)
    buckets = defaultdict(list)
    for plant, ts, v in rows:
        start = ts.replace(second=0, microsecond=0, minute=ts.minute - ts.minute % 5)
        buckets[(plant, start)].append(v)
    per_plant = defaultdict(dict)
    for (plant, start), vs in buckets.items():
        vals = [x for x in vs if x is not None]
        per_plant[plant][start] = (sum(vals) if stat == "sum" else max(vals)) if vals else None
    out = set()
    for plant, series in per_plant.items():
        t, hi = min(series), max(series)
        streak = []
        while t <= hi:
            v = series.get(t)
            streak.append(v is not None and v > threshold)
            if len(streak) >= periods and all(streak[-periods:]):
                out.add((plant, t))
            t += step
    return out


def test_period_alerts_brute_force(spark):
    fact = T.fact_iot_events(spark, SF_SMALL)
    rows = [(r.plant_sk, r.event_ts, r.value_numeric) for r in fact.select("plant_sk", "event_ts", "value_numeric").collect()]
    for stat, thr, n in (("max", 90.0, 1), ("max", 50.0, 2), ("sum", 100.0, 1)):
        got = period_alerts(fact, "event_ts", "plant_sk", "value_numeric", stat, thr, ">", n)
        got = {(r.plant_sk, r.period_start) for r in got.collect()}
        assert got == _brute(rows, thr, n, stat), (stat, thr, n)


def test_hll_error_bound(spark):
    fact = T.fact_iot_events(spark, SF_MID)
    w = fact.groupBy(week_start("event_ts").alias("wk")).agg(
        F.approx_count_distinct("event_id", 0.02).alias("approx"), F.count_distinct("event_id").alias("exact"))
    for r in w.collect():
        assert abs(r.approx - r.exact) <= 0.06 * r.exact, r   # 3 sigma at rsd 0.02


def test_alerts_do_not_depend_on_session_time_zone(spark):
    fact = T.fact_iot_events(spark, SF_SMALL)
    def run():
        return sorted((r.plant_sk, r.period_start, r.consecutive_periods) for r in
                      period_alerts(fact, "event_ts", "plant_sk", "value_numeric", "max", 50.0, ">", 2).collect())
    base = run()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert run() == base
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_weekly_devices_from_hourly_sketches(spark):
    """Sketch union over hours vs exact distinct devices per plant-week (2 % bound)."""
    from sensorwerk.operators import aggregates as A
    fact = T.fact_iot_events(spark, SF_MID)
    hourly = A.hourly_plant_kpis(fact, T.dim_plant(spark, SF_MID), device_sketch=True)
    est = A.weekly_devices_from_sketches(hourly)
    exact = A.weekly_devices(fact, exact=True).withColumnRenamed("active_devices", "exact")
    rows = est.join(exact, ["week_start", "plant_sk"]).collect()
    assert len(rows) == exact.count()
    for r in rows:
        assert abs(r.active_devices - r.exact) <= max(1, 0.02 * r.exact), r
