"""Periodic threshold alerts (Q-8): statistic per period, threshold, N consecutive
breaching periods; a period with no data counts as not breaching."""
from __future__ import annotations

from dataclasses import dataclass
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from sensorwerk.functions.columns import epoch_ntz

_UNIT_US = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000}


def period_micros(period: str) -> int:
    """'5 minutes' -> 300000000."""
    n, unit = period.split()
    return int(n) * _UNIT_US[unit.lower().rstrip("s")]


_STATS = {"sum": F.sum, "max": F.max, "min": F.min, "avg": F.avg, "count": F.count}
_CMP = {">": lambda c, t: c > t, ">=": lambda c, t: c >= t, "<": lambda c, t: c < t, "<=": lambda c, t: c <= t}


@dataclass(frozen=True)
class AlertRule:
    name: str
    metric: str          # column aggregated per period
    stat: str            # sum | max | min | avg | count
    threshold: float
    comparison: str      # > | >= | < | <=
    periods: int         # consecutive breaching periods that raise the alarm


def evaluate_alerts(df: DataFrame, ts: str, group: str, rules: list[AlertRule],
                    period: str = "5 minutes") -> DataFrame:
    """Periods in ALARM per group, for several rules over one pass of ``df``.

    1. one partial aggregate per (group, period) computing every rule's statistic;
    2. per rule, over the periods that have data, ordered in time: the period is in ALARM
       when it and the ``periods - 1`` before it all breach *and* the first of them lies
       exactly ``periods - 1`` periods earlier. Strictly increasing periods spanning exactly
       that distance leave no gap, so this equals evaluating a dense grid in which missing
       periods do not breach — without materialising the grid, whose size would follow the
       time span (one stray epoch-0 timestamp would stretch it over decades).
    """
    stats = [_STATS[r.stat](r.metric).cast("double").alias(f"_v{i}") for i, r in enumerate(rules)]
    buckets = df.groupBy(group, F.window(ts, period).start.alias("period_start")).agg(*stats)
    # period position in microseconds, without a time-zone conversion (DST-safe)
    ntz = isinstance(buckets.schema["period_start"].dataType, TimestampNTZType)
    pos = (F.timestamp_diff("MICROSECOND", epoch_ntz(), F.col("period_start")) if ntz
           else F.unix_micros(F.col("period_start")))
    buckets = buckets.withColumn("_p", pos)
    step_us = F.lit(period_micros(period))
    order = Window.partitionBy(group).orderBy("period_start")
    cols = {}
    for i, r in enumerate(rules):
        frame = order.rowsBetween(-(r.periods - 1), 0)
        breaching = F.coalesce(_CMP[r.comparison](F.col(f"_v{i}"), F.lit(r.threshold)), F.lit(False)).cast("int")
        cols[f"_n{i}"] = F.sum(breaching).over(frame)
        cols[f"_span{i}"] = F.col("_p") - F.min("_p").over(frame)
    run = buckets.withColumns(cols)
    # one row per (period, rule) from the same plan branch (no union of copies)
    per_rule = F.array(*[F.struct(
        F.lit(r.name).alias("alert_name"), F.col(f"_v{i}").alias("value"),
        F.col(f"_n{i}").cast("bigint").alias("consecutive_periods"),
        ((F.col(f"_n{i}") == r.periods) & (F.col(f"_span{i}") == step_us * (r.periods - 1))).alias("alarm"))
        for i, r in enumerate(rules)])
    return (run.select(group, "period_start", F.explode(per_rule).alias("_r"))
            .filter(F.col("_r.alarm"))
            .select("_r.alert_name", group, "period_start", "_r.value", "_r.consecutive_periods"))


def period_alerts(df: DataFrame, ts: str, group: str, metric: str, stat: str, threshold: float,
                  comparison: str, periods: int, period: str = "5 minutes", name: str = "alert") -> DataFrame:
    """One rule (see :func:`evaluate_alerts`)."""
    return evaluate_alerts(df, ts, group, [AlertRule(name, metric, stat, threshold, comparison, periods)], period)
