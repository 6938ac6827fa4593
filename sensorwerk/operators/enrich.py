"""Derived columns and lookups of the log and IoT stages (PRJ-4..7, PRJ-14, J-1)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorwerk import schemas as S
from sensorwerk.config import BROADCAST_MAX_BYTES, bounded_broadcast
from sensorwerk.functions.columns import (
    anomaly_score, epoch_ms_to_ts, partition_strings, quality_bad, threshold_breach,
)


def _run_ts(run_ts: str | None):
    return F.lit(run_ts).cast("timestamp_ntz") if run_ts else F.localtimestamp()


def enrich_logs(df: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Event time from epoch ms, Hive partition strings, alarm / critical flags, run time,
    Fahrenheit temperature (PRJ-4). One projection, no shuffle."""
    ts = epoch_ms_to_ts("event_timestamp")
    cols = {"event_ts": ts}
    cols.update(partition_strings(ts))
    cols.update({
        "is_alarm": F.col("event_type") == F.lit("ALARM"),
        "is_critical": F.col("severity") == F.lit("CRITICAL"),
        "processed_at": _run_ts(run_ts),
        "temp_fahrenheit": F.when(F.col("temperature_c").isNotNull(),
                                  F.round(F.col("temperature_c") * 9 / 5 + 32, 2)),
    })
    return df.withColumns(cols)


def add_partition_cols(df: DataFrame, ts: str = "event_ts", run_ts: str | None = None) -> DataFrame:
    """IoT Hive partition columns + ``processed_at`` (PRJ-5). Replaces inferred ``year`` /
    ``month`` columns a partitioned file source may already carry."""
    cols = partition_strings(F.col(ts))
    cols["processed_at"] = _run_ts(run_ts)
    return df.withColumns(cols)


def detect_anomalies(df: DataFrame) -> DataFrame:
    """Threshold breach, bad quality and the precedence score 1.0 / 0.5 / 0.0 (PRJ-6)."""
    return (df.withColumn("threshold_breach", threshold_breach())
            .withColumn("quality_bad", quality_bad())
            .withColumn("anomaly_score", anomaly_score()))


def sigma_anomalies(df: DataFrame, keys=("device_id", "event_name"), value: str = "value_numeric",
                    sigma: float = S.SIGMA_LIMIT, stats: DataFrame | None = None) -> DataFrame:
    """Readings more than ``sigma`` sample standard deviations from their key's mean (PRJ-7).

    Batch: the baseline is aggregated from ``df`` itself (partial aggregation, no window
    over a hot device). Stream: pass ``stats``, a baseline table with the same key columns
    and ``mean_value`` / ``stddev_value``; it is joined as a stream-static join.
    """
    if stats is None:
        stats = df.groupBy(*keys).agg(F.avg(value).alias("mean_value"),
                                      F.stddev(value).alias("stddev_value"),
                                      F.count(value).alias("baseline_readings"))
    flag = F.coalesce(F.abs(F.col(value) - F.col("mean_value")) > F.lit(sigma) * F.col("stddev_value"),
                      F.lit(False))
    return df.join(stats, list(keys), "left").withColumn("sigma_anomaly", flag)


def unique_registry(registry: DataFrame, key: str = "device_id") -> DataFrame:
    """One row per device: duplicates would fan events out in the join (D24). The kept row
    is the greatest by the remaining columns, so the choice is deterministic."""
    others = [c for c in registry.columns if c != key]
    return (registry.filter(F.col(key).isNotNull()).groupBy(key)
            .agg(F.max(F.struct(*others)).alias("_r")).select(key, "_r.*"))


def enrich_with_registry(df: DataFrame, registry: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES,
                         dedupe: bool = True) -> DataFrame:
    """Left join of events to device metadata (J-1); broadcast only below a proven bound."""
    reg = unique_registry(registry) if dedupe else registry
    return df.join(bounded_broadcast(reg, max_bytes), "device_id", "left")


def sla_ack_breach(logs: DataFrame, devices: DataFrame, default_minutes: int = S.SLA_ACK_MINUTES) -> DataFrame:
    """Alarms not acknowledged within the device SLA (PRJ-14): unresolved, or resolved
    later than ``sla_minutes`` (default 5 when the device has none)."""
    sla = devices.select(F.col("device_id").alias("machine_id"), "sla_minutes")
    limit = F.coalesce(F.col("sla_minutes"), F.lit(default_minutes))
    breach = F.col("is_alarm") & (F.col("resolution_minutes").isNull() | (F.col("resolution_minutes") > limit))
    return logs.join(sla, "machine_id", "left").withColumn("sla_breach", breach)
