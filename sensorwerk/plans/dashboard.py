"""Dashboard queries (Q-1 .. Q-7, O-3, O-4, W-3). All read the fact with bare-column time
filters and aggregate before joining the (small) plant / device attributes."""
from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorwerk.functions.columns import bucket_start, ratio_pct, round_numeric, sla_status, week_start, wow_delta_pct
from sensorwerk.operators.aggregates import weekly_plant_events, with_running_sum
from sensorwerk.plans.reports import DEFAULT_AS_OF, in_range


def _slice(fact: DataFrame, lo: str | None, hi: str | None, plant_sks=None) -> DataFrame:
    out = fact.filter(in_range("event_ts", lo, hi))
    if plant_sks:
        out = out.filter(F.col("plant_sk").isin(list(plant_sks)))
    return out


def kpi_cards(fact: DataFrame, lo: str | None = None, hi: str | None = None, plant_sks=None) -> DataFrame:
    """Total events, alarms, alarm rate %, average quality for a date range / plant slicer."""
    f = _slice(fact, lo, hi, plant_sks)
    alarms = F.count_if(F.col("threshold_breach"))
    return f.agg(
        F.count(F.lit(1)).alias("total_events"),
        alarms.alias("total_alarms"),
        ratio_pct(alarms, F.count(F.lit(1)), 2).alias("alarm_rate_pct"),
        round_numeric(F.avg("quality"), 2).alias("avg_quality"),
    )


def events_by_plant(fact: DataFrame, plants: DataFrame) -> DataFrame:
    counts = fact.groupBy("plant_sk").agg(F.count(F.lit(1)).alias("total_events"))
    return counts.join(plants.select("plant_sk", "plant_id", "plant_name"), "plant_sk").select(
        "plant_id", "plant_name", "total_events")


def temperature_trend(fact: DataFrame, grain: str = "HOUR", by_device: bool = True,
                      event_name: str = "TEMPERATURE") -> DataFrame:
    keys = [bucket_start("event_ts", grain).alias("period_start")]
    if by_device:
        keys.append(F.col("device_sk"))
    return (fact.filter(F.col("event_name") == event_name).groupBy(*keys)
            .agg(round_numeric(F.avg("value_numeric"), 4).alias("avg_value"),
                 F.count(F.lit(1)).alias("readings")))


def breach_points(fact: DataFrame, event_name: str | None = "TEMPERATURE") -> DataFrame:
    """Scatter points: value vs threshold with the breach flag, for one event type."""
    f = fact if event_name is None else fact.filter(F.col("event_name") == event_name)
    return f.select("event_id", "event_ts", "device_sk", "event_name", "value_numeric",
                    "alert_threshold", "threshold_breach")


def top_hottest(fact: DataFrame, devices: DataFrame, n: int = 5, event_name: str = "TEMPERATURE") -> DataFrame:
    """Top-n devices by maximum reading (ties broken by device id): partial aggregate, then a
    per-task top-n merged on the driver side of TakeOrderedAndProject (n rows per task)."""
    peak = (fact.filter(F.col("event_name") == event_name).groupBy("device_sk")
            .agg(F.max("value_numeric").alias("max_value")))
    d = devices.select("device_sk", "device_id")
    return (peak.join(d, "device_sk", "left")
            .orderBy(F.desc_nulls_last("max_value"), "device_id")
            .limit(n).select("device_id", "max_value"))


def top_breaches(fact: DataFrame, n: int = 10) -> DataFrame:
    """Top-n breaching readings by value (O-3)."""
    return (fact.filter(F.col("threshold_breach"))
            .orderBy(F.desc("value_numeric"), "event_id").limit(n)
            .select("event_id", "device_sk", "event_name", "value_numeric", "alert_threshold"))


def top_alarm_hours(hourly: DataFrame, n: int = 20, min_events: int = 5) -> DataFrame:
    """Top-n plant-hours by alarm rate among hours with at least ``min_events`` events (O-3)."""
    return (hourly.filter(F.col("total_events") >= min_events)
            .select("event_hour", "plant_id", "total_events", "alarm_count",
                    F.round("alarm_rate_pct", 2).alias("alarm_rate_pct"))
            .orderBy(F.desc("alarm_rate_pct"), F.desc("total_events"), "event_hour", "plant_id").limit(n))


def plant_performance(fact: DataFrame, plants: DataFrame, lo: str | None = None,
                      hi: str | None = None) -> DataFrame:
    """Plant table: events, alarms, rate %, SLA status and its colour (red at >= 1 %)."""
    f = _slice(fact, lo, hi)
    per = f.groupBy("plant_sk").agg(F.count(F.lit(1)).alias("total_events"),
                                    F.count_if(F.col("threshold_breach")).alias("total_alarms"))
    rate = ratio_pct("total_alarms", "total_events", 2)
    status = sla_status(rate)
    return per.join(plants.select("plant_sk", "plant_id", "plant_name"), "plant_sk").select(
        "plant_id", "plant_name", "total_events", "total_alarms", rate.alias("alarm_rate_pct"),
        status.alias("sla_status"),
        F.when(status == "COMPLIANT", "green").otherwise("red").alias("status_colour"))


def _weekly_alarms(fact: DataFrame, lo: str | None, hi: str | None) -> DataFrame:
    f = _slice(fact, lo, hi)
    return weekly_plant_events(f).select("week_start", "plant_sk", "total_events", "total_alarms")


def wow_alarms(fact: DataFrame, plants: DataFrame, as_of: str = DEFAULT_AS_OF) -> DataFrame:
    """This week vs last week alarms per plant; 'this week' holds the day before ``as_of``."""
    last_day = date.fromisoformat(as_of) - timedelta(days=1)
    this_week = last_day - timedelta(days=last_day.weekday())
    prev_week = this_week - timedelta(days=7)
    weekly = _weekly_alarms(fact, prev_week.isoformat(), as_of)
    cur = F.coalesce(F.sum(F.when(F.col("week_start") == F.lit(this_week), F.col("total_alarms"))), F.lit(0))
    prev = F.coalesce(F.sum(F.when(F.col("week_start") == F.lit(prev_week), F.col("total_alarms"))), F.lit(0))
    per = weekly.groupBy("plant_sk").agg(cur.alias("this_week_alarms"), prev.alias("last_week_alarms"))
    return per.join(plants.select("plant_sk", "plant_id"), "plant_sk").select(
        "plant_id", F.lit(this_week).alias("week_start"), "this_week_alarms", "last_week_alarms",
        wow_delta_pct("this_week_alarms", "last_week_alarms").alias("alarm_wow_delta_pct"))


def alarm_trend(fact: DataFrame, plants: DataFrame, as_of: str = DEFAULT_AS_OF, weeks: int = 8) -> DataFrame:
    """Weekly alarms of the last ``weeks`` weeks (the current, partial week included)."""
    last_day = date.fromisoformat(as_of) - timedelta(days=1)
    first_week = last_day - timedelta(days=last_day.weekday()) - timedelta(weeks=weeks - 1)
    weekly = _weekly_alarms(fact, first_week.isoformat(), as_of)
    return weekly.join(plants.select("plant_sk", "plant_id"), "plant_sk").select(
        "week_start", "plant_id", "total_alarms", "total_events")


def cumulative_alarms(fact: DataFrame, plants: DataFrame) -> DataFrame:
    """Weekly alarms per plant with their running total (W-3)."""
    weekly = _weekly_alarms(fact, None, None)
    run = with_running_sum(weekly, "plant_sk", "week_start", "total_alarms", "cumulative_alarms")
    return run.join(plants.select("plant_sk", "plant_id"), "plant_sk").select(
        "week_start", "plant_id", "total_alarms", "cumulative_alarms")
