"""Jobs: the batch log job and the warehouse load + roll-up refresh.

The log job scans its input once: the parsed rows are persisted (recomputed from the source
if an executor is lost) and every count comes from an ``Observation`` attached to a write,
so the three writes are the only actions.
"""
from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sensorwerk import schemas as S
from sensorwerk.functions.columns import day_start
from sensorwerk.operators import aggregates as A
from sensorwerk.operators import dedup, enrich, quality, warehouse
from sensorwerk.sinks import lake
from sensorwerk.sources.raw import read_raw_logs


@dataclass
class LogJobResult:
    run_id: str
    metrics: dict = field(default_factory=dict)


def run_log_job(spark: SparkSession, raw_path: str, processed_path: str, quarantine_path: str,
                dq_path: str, metrics_path: str | None = None, run_id: str | None = None,
                run_ts: str | None = None, strict: bool = True, prefer_valid: bool = False,
                partition_cols=lake.LOG_PARTITIONS, persist_input: bool = True) -> LogJobResult:
    """Batch log job: parse -> quarantine -> rules -> keep-latest -> enrich -> clean / failed.

    ``partition_cols`` defaults to the hourly x plant layout of an hourly run; a backfill of
    weeks in one run should pass ``lake.BACKFILL_PARTITIONS`` (hour x plant would write a
    file per hour and plant).

    ``persist_input`` keeps the parsed input (memory, spilling to local disk) so the JSON is
    parsed once for the quarantine and the clean paths; lost blocks are recomputed from the
    source. At very large inputs with little local disk, ``False`` parses the JSON twice
    instead."""
    run_id = run_id or str(uuid.uuid4())
    raw = read_raw_logs(spark, raw_path)
    if persist_input:
        raw = raw.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        obs_raw = Observation(f"raw-{run_id}")
        observed = raw.observe(obs_raw, F.count(F.lit(1)).alias("total_raw"),
                               F.count_if(F.col(S.CORRUPT_COL).isNotNull()).alias("corrupt_records"))
        good, bad = quality.split_corrupt(observed)
        lake.write_quarantine(bad, quarantine_path, run_id)

        flagged = quality.with_dq_flags(good)
        # a record without an id cannot be de-duplicated or upserted: it fails the checks
        # (reason "event_id") instead of collapsing with every other id-less record
        no_id = quality.fail_missing_key(flagged.filter(F.col("event_id").isNull()), "event_id")
        others = sorted(c for c in good.columns if c not in ("event_id", "event_timestamp"))
        order = (["dq_pass_strict"] if prefer_valid else []) + ["event_timestamp"] + others
        latest = dedup.keep_latest(flagged.filter(F.col("event_id").isNotNull()), "event_id", order,
                                   copies_col="copies").unionByName(no_id.withColumn("copies", F.lit(1).cast("long")))
        enriched = enrich.enrich_logs(latest, run_ts).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            clean, failed = quality.route(enriched, strict=strict)
            obs_clean = Observation(f"clean-{run_id}")
            lake.write_processed(
                clean.observe(obs_clean, F.count(F.lit(1)).alias("written"),
                              F.coalesce(F.sum("copies"), F.lit(0)).alias("clean_raw")).drop("copies"),
                processed_path, partition_cols)
            obs_failed = Observation(f"failed-{run_id}")
            lake.write_dq_failures(
                failed.observe(obs_failed, F.count(F.lit(1)).alias("dq_failed"),
                               F.count_if(F.col("dq_pass").isNull()).alias("dq_unknown"),
                               F.coalesce(F.sum("copies"), F.lit(0)).alias("failed_raw")).drop("copies"),
                dq_path)
        finally:
            enriched.unpersist()
    finally:
        raw.unpersist()

    m = {**obs_raw.get, **obs_clean.get, **obs_failed.get}
    parsed = m["total_raw"] - m["corrupt_records"]
    metrics = {
        "job_run_id": run_id,
        "total_raw": m["total_raw"],
        "corrupt_records": m["corrupt_records"],
        "after_dedup": m["written"] + m["dq_failed"] if strict else None,
        "duplicates_removed": (parsed - m["written"] - m["dq_failed"]) if strict else None,
        "written": m["written"],
        "dq_failed": m["dq_failed"],
        "dq_unknown": m["dq_unknown"],
        "dq_fail_rate": round(1 - m["written"] / max(m["total_raw"], 1), 4),
    }
    if metrics_path:
        spark.createDataFrame([metrics]).write.mode("append").json(metrics_path)
    return LogJobResult(run_id, metrics)


def load_fact_batch(spark: SparkSession, fact_path: str, staging: DataFrame, key: str = "event_id",
                    dedup_staging: bool = False) -> list:
    """Upsert a staging batch into the fact table partitioned by ``event_date``; returns the days
    it changed (those that staged keys left included)."""
    staged = staging.withColumn("event_date", day_start("event_ts"))
    return warehouse.write_upsert(spark, fact_path, staged, key, "event_date", dedup_staging)


def refresh_hourly(spark: SparkSession, fact_path: str, plants: DataFrame, hourly_path: str,
                   touched: list | None = None) -> None:
    """Recompute the hourly roll-up for the days that a load touched (SNK-10).

    ``touched``: the days returned by :func:`load_fact_batch`; a day without events any more loses its
    rows. When None the whole table is rebuilt. Day boundaries are hour boundaries, so a day's
    hours depend on that day's events only. Events without a time are in no hour.
    """
    fact = spark.read.parquet(fact_path).filter(F.col("event_date").isNotNull())
    days = None if touched is None else [d for d in touched if d is not None]
    if days is not None:
        fact = fact.filter(F.col("event_date").isin(days))
    hourly = A.hourly_plant_kpis(fact, plants, device_sketch=True).withColumn("event_date", F.to_date("event_hour"))
    warehouse.refresh_through_scratch(spark, hourly_path, hourly, "event_date", days)


def run_iot_job(spark: SparkSession, raw_path: str, registry_path: str, output_path: str, checkpoint: str,
                dead_letter_path: str | None = None, trigger: dict | None = None,
                minutes: float | None = None):
    """Streaming IoT job (entry point B): registry (empty if absent) -> file stream ->
    watermark / de-dup / anomalies / registry / partition columns -> idempotent sink,
    malformed lines to a dead-letter sink; runs ``minutes`` then stops (or until the
    ``availableNow`` trigger has drained the input)."""
    from sensorwerk.sources.raw import load_registry
    from sensorwerk.streaming import iot

    registry = load_registry(spark, registry_path)
    stream = iot.read_iot_stream(spark, raw_path)
    metrics = iot.BatchMetrics()
    queries = [iot.start_iot_sink(iot.iot_pipeline(stream, registry), output_path, f"{checkpoint}/events",
                                  trigger=trigger, metrics=metrics)]
    if dead_letter_path:
        queries.append(iot.start_dead_letter_sink(stream, dead_letter_path, f"{checkpoint}/dead_letters", trigger))
    iot.run_all(spark, queries, minutes)
    return metrics


def run_warehouse_cycle(spark: SparkSession, staging_path: str, fact_path: str, hourly_path: str,
                        plants: DataFrame, report_table_path: str, as_of: str, days: int = 7,
                        devices: DataFrame | None = None, catalog_table: str | None = None) -> DataFrame:
    """Load + report cycle (entry point C): staging Parquet -> partition-scoped upsert of the
    fact -> hourly roll-up refreshed for the touched days -> weekly report computed from the
    roll-up alone (device counts from its sketches) and written as a table.

    ``catalog_table``: after the load the catalog learns the fact's new partitions and columns (SRC-7), and
    its row count and column statistics are measured for the planner (SNK-13)."""
    from sensorwerk.plans.reports import weekly_report_after
    from sensorwerk.sources.raw import load_staging, sync_lake_table

    if devices is not None:          # the streaming job's own output: natural ids become keys on the way
        wanted = ["event_id", "device_id", "plant_id", "timestamp_ms", "event_name", "value_numeric", "value_string", "unit",
                  "quality", "alert_threshold", "threshold_breach", "anomaly_score", "processed_at"]
        staging = warehouse.fact_events(load_staging(spark, staging_path, wanted), devices, plants)
    else:
        fact_cols = [c for c in spark.read.parquet(fact_path).columns if c != "event_date"]
        staging = load_staging(spark, staging_path, fact_cols)
    touched = load_fact_batch(spark, fact_path, staging)
    if catalog_table:
        sync_lake_table(spark, catalog_table, fact_path, ["event_date"], {"event_date": "date"})
        lake.analyze_table(spark, catalog_table, ["event_id", "event_ts", "device_sk", "plant_sk", "event_name"])
    refresh_hourly(spark, fact_path, plants, hourly_path, touched)
    report = weekly_report_after(None, plants, as_of, days, hourly=spark.read.parquet(hourly_path), devices="sketch")
    report.write.mode("overwrite").parquet(report_table_path)
    return spark.read.parquet(report_table_path)
