"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each one reads the driver tables through the stand-in builders and runs the library
operators over the whole tables. Column names match the oracle SQL in
:mod:`sensorwerk.plans.oracle`. Float aggregates are rounded to 4 places where engines may
differ in the last bits of a sum.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorwerk.functions.columns import date_sk, epoch_ms_to_ts, ntz, round_numeric, ts_to_epoch_ms
from sensorwerk.operators import aggregates as A
from sensorwerk.operators import dims, enrich, quality, warehouse
from sensorwerk.operators.alerts import AlertRule, evaluate_alerts
from sensorwerk.operators.dedup import keep_latest
from sensorwerk.plans import dashboard as D
from sensorwerk.plans import load_queries, reports
from sensorwerk.plans.diagnostics import dataset_size_report
from sensorwerk.sources import standins as T
from sensorwerk.sources.tables import TABLES, table_path

AS_OF = reports.DEFAULT_AS_OF
RUN_TS = "2024-02-01 00:00:00"          # fixed run time so outputs are reproducible
LOAD_CUTOFF = "2024-01-20 00:00:00"     # target holds events before this instant
RESEND_FROM = "2024-01-15 00:00:00"     # staging re-sends events from this instant on


def _fact(spark, sf, plant=True):
    return T.fact_iot_events(spark, sf, plant)


def _plants(spark, sf):
    return T.dim_plant(spark, sf)


def _logs_flagged(spark, sf):
    return quality.with_dq_flags(T.log_raw(spark, sf))


def _dedup(flagged, copies: str | None = None, columns=None):
    return keep_latest(flagged, "event_id", ["event_timestamp", "resend"], copies_col=copies, columns=columns)


def _logs_deduped(spark, sf, copies: str | None = None, columns=None):
    return _dedup(_logs_flagged(spark, sf), copies, columns)


def _fact_machine_logs(spark, sf):
    clean, _ = quality.route(_logs_deduped(spark, sf))
    return enrich.enrich_logs(clean, RUN_TS)


def _r4(c):
    return round_numeric(c, 4).alias(c)


# ---- reports ---------------------------------------------------------------------------------
def q_weekly_plant_mart(spark, sf):
    return reports.weekly_plant_mart(_fact(spark, sf), _plants(spark, sf))


def q_weekly_report_after(spark, sf):
    # exact device counts: an approximate column cannot be value-checked (see the _hll twin)
    return reports.weekly_report_after(_fact(spark, sf), _plants(spark, sf), AS_OF, devices="fact_exact")


def q_weekly_report_after_hll(spark, sf):
    return reports.weekly_report_after(_fact(spark, sf), _plants(spark, sf), AS_OF, devices="fact_hll")


def q_weekly_report_after_sketch(spark, sf):
    return reports.weekly_report_after(_fact(spark, sf), _plants(spark, sf), AS_OF, devices="sketch")


def q_weekly_report_before(spark, sf):
    return reports.weekly_report_before(_fact(spark, sf), _plants(spark, sf), AS_OF)


def q_hourly_plant_kpis(spark, sf):
    h = A.hourly_plant_kpis(_fact(spark, sf), _plants(spark, sf))
    return h.select("event_hour", "plant_id", "plant_name", "country_code", "region", "total_events",
                    "alarm_count", "high_anomaly_count", _r4("avg_sensor_value"), _r4("avg_quality"),
                    "low_quality_events", F.round("alarm_rate_pct", 2).alias("alarm_rate_pct"))


def q_stg_iot_events(spark, sf):
    return A.stg_iot_events(_fact(spark, sf).withColumn("processed_at", ntz(RUN_TS)))


# ---- IoT stages ------------------------------------------------------------------------------
def q_anomaly_flags(spark, sf):
    return enrich.detect_anomalies(T.iot_raw(spark, sf, plant=False)).select(
        "event_id", "device_id", "value_numeric", "alert_threshold", "quality",
        "threshold_breach", "quality_bad", "anomaly_score")


def q_sigma_anomalies(spark, sf):
    out = enrich.sigma_anomalies(T.iot_raw(spark, sf, plant=False))
    return out.select("event_id", "device_id", "event_name", "value_numeric", "baseline_readings",
                      "sigma_anomaly")


def _window_q(spark, sf, window, keys):
    w = A.window_aggregate(T.iot_raw(spark, sf), window, keys=keys)
    return w.select("window_start", "window_end", *keys, _r4("avg_value"), "min_value", "max_value",
                    _r4("stddev_value"), "event_count", _r4("avg_quality"), "low_quality_count")


def q_minute_window_agg(spark, sf):
    return _window_q(spark, sf, "1 minute", ["device_id", "plant_id", "line_id", "event_name", "unit"])


def q_hour_window_agg(spark, sf):
    return _window_q(spark, sf, "1 hour", ["plant_id", "event_name", "unit"])


def q_iot_partition_cols(spark, sf):
    return enrich.add_partition_cols(T.iot_raw(spark, sf), run_ts=RUN_TS).select(
        "event_id", "plant_id", "year", "month", "day", "hour", "processed_at")


def q_registry_left_join(spark, sf):
    out = enrich.enrich_with_registry(T.iot_raw(spark, sf, plant=False), T.device_registry(spark, sf))
    return out.select("event_id", "device_id", "asset_name", "location", "criticality", "maintenance_window")


# ---- log pipeline ----------------------------------------------------------------------------
def q_log_dq_flags(spark, sf):
    return _logs_flagged(spark, sf).select(
        "event_id", "resend", "severity_valid", "event_type_valid", "temp_valid", "ts_valid",
        "dq_pass", "dq_pass_strict", "dq_reason")


def q_log_dq_split_counts(spark, sf):
    return _logs_deduped(spark, sf).groupBy("dq_pass").agg(F.count(F.lit(1)).alias("rows"))


def q_log_dedup_latest(spark, sf):
    return _logs_deduped(spark, sf, copies="copies", columns=[
        "event_id", "event_timestamp", "resend", "event_type", "severity", "dq_pass"])


def q_log_enriched(spark, sf):
    out = enrich.enrich_logs(_logs_deduped(spark, sf), RUN_TS)
    return out.select("event_id", "event_ts", "year", "month", "day", "hour", "is_alarm", "is_critical",
                      "processed_at", "temp_fahrenheit")


def q_run_metrics(spark, sf):
    raw = T.log_raw(spark, sf)
    return quality.run_metrics(raw, _dedup(quality.with_dq_flags(raw), copies="copies", columns=["dq_pass"]))


def q_dq_fail_rate(spark, sf):
    return quality.dq_fail_rate_by(_logs_deduped(spark, sf), "plant_code")


def q_sla_ack_breach(spark, sf):
    logs = _fact_machine_logs(spark, sf).filter(F.col("is_alarm"))
    out = enrich.sla_ack_breach(logs, T.dim_device(spark, sf))
    return out.select("event_id", "machine_id", "resolution_minutes", "sla_minutes", "sla_breach")


# ---- dimensions and joins --------------------------------------------------------------------
def q_calendar_dim(spark, sf):
    return dims.calendar_for(_fact(spark, sf, plant=False))


def q_sk_lookup(spark, sf):
    logs = enrich.enrich_logs(T.log_raw(spark, sf), RUN_TS)
    out = dims.lookup_keys(logs, T.dim_device(spark, sf), _plants(spark, sf),
                           device_col="machine_id", plant_col="plant_code")
    return out.select("event_id", "resend", "machine_id", "plant_code", "device_sk", "plant_sk", "date_sk")


def q_scd2_asof_join(spark, sf):
    out = dims.asof_join(T.iot_raw(spark, sf, plant=False), T.dim_device_scd2(spark, sf))
    return out.select("event_id", "device_id", "event_ts", "criticality", "valid_from", "is_active")


def q_fk_orphans(spark, sf):
    fact, devices = _fact(spark, sf), T.dim_device(spark, sf)
    logs = T.log_raw(spark, sf).select("machine_id", date_sk(epoch_ms_to_ts("event_timestamp")).alias("date_sk"))
    cal = dims.calendar_for(_fact(spark, sf, plant=False))
    return dims.orphan_report([
        ("fact_iot_events.device_sk", fact, "device_sk", devices, "device_sk"),
        ("fact_iot_events.plant_sk", fact, "plant_sk", _plants(spark, sf), "plant_sk"),
        ("fact_iot_events.date_sk", fact, "date_sk", cal, "date_sk"),
        ("fact_machine_logs.date_sk", logs, "date_sk", cal, "date_sk"),
        ("fact_machine_logs.machine_id", logs, "machine_id", devices, "device_id")])


def q_conditional_counts(spark, sf):
    return A.conditional_counts(_fact(spark, sf))


def q_exact_distinct_weekly(spark, sf):
    from sensorwerk.functions.columns import week_start
    return (_fact(spark, sf).groupBy(week_start("event_ts").alias("week_start"), "plant_sk")
            .agg(F.count_distinct("event_id").alias("unique_events"),
                 F.count_distinct("device_sk").alias("active_devices")))


def q_approx_distinct_weekly(spark, sf):
    return A.weekly_devices(_fact(spark, sf), exact=False)


def q_table_row_counts(spark, sf):
    fact = _fact(spark, sf, plant=False)
    logs = _logs_deduped(spark, sf, columns=["event_id", "dq_pass"])
    return A.row_counts({
        "dim_plant": _plants(spark, sf),
        "dim_device": T.dim_device(spark, sf),
        "dim_date": dims.calendar_for(fact),
        "fact_iot_events": fact,
        "fact_machine_logs": quality.route_clean(logs),
    })


# ---- warehouse loads -------------------------------------------------------------------------
def _target_and_resend(spark, sf):
    fact = _fact(spark, sf, plant=False).select("event_id", "event_ts", "device_sk", "value_numeric")
    target = fact.filter(F.col("event_ts") < ntz(LOAD_CUTOFF))
    resend = fact.withColumn("value_numeric", F.col("value_numeric") + 1)
    return target, resend


def q_upsert_events(spark, sf):
    target, resend = _target_and_resend(spark, sf)
    staging = resend.filter(F.col("event_ts") >= ntz(RESEND_FROM))
    return warehouse.upsert(target, staging, "event_id")


def q_upsert_table(spark, sf):
    """The on-disk upsert over a table partitioned by day, read back. Staged rows carry a new value and,
    every third, a day later (the old copy lies in another partition); every seventh target row has
    no day (it lies in the NULL partition) and some of those are staged again, undated."""
    import uuid

    from sensorwerk.config import checkpoint_dir
    from sensorwerk.sinks import lake

    base = f"{checkpoint_dir(spark).rstrip('/')}/upsert-query-{uuid.uuid4().hex}"
    rows = _fact(spark, sf, plant=False).selectExpr("event_sk", "event_id", "device_sk", "value_numeric", "event_ts")
    day = "CASE WHEN event_sk % 7 = 0 THEN CAST(NULL AS date) ELSE cast(event_ts AS date) END"
    target = rows.filter(F.col("event_ts") < ntz(LOAD_CUTOFF)).withColumn("event_date", F.expr(day))
    staging = rows.filter(F.col("event_ts") >= ntz(RESEND_FROM)).selectExpr(
        "event_sk", "event_id", "device_sk", "value_numeric + 1 AS value_numeric", "event_ts",
        f"CASE WHEN event_sk % 3 = 0 THEN date_add(cast(event_ts AS date), 1) ELSE {day} END AS event_date")
    lake.write_partitioned(target, f"{base}/fact", ["event_date"])
    warehouse.write_upsert(spark, f"{base}/fact", staging)
    return spark.read.schema(target.schema).parquet(f"{base}/fact").select("event_id", "device_sk", "value_numeric", "event_date")


def q_lake_to_fact(spark, sf):
    """Lake rows as the streaming job writes them, loaded as fact rows."""
    lake_rows = enrich.detect_anomalies(T.iot_raw(spark, sf)).withColumns({
        "timestamp_ms": ts_to_epoch_ms("event_ts"), "value_string": F.lit(None).cast("string"),
        "processed_at": F.lit(RUN_TS).cast("timestamp_ntz")}).drop("event_ts")
    fact = warehouse.fact_events(lake_rows, T.dim_device(spark, sf), _plants(spark, sf))
    return fact.select("event_id", "device_sk", "plant_sk", "date_sk", "event_ts", "event_name", "value_numeric", "unit",
                       "quality", "threshold_breach", "anomaly_score", _r4("avg_value_1min"), _r4("stddev_value_1min"),
                       "year", "month")


def q_incremental_load(spark, sf):
    target, resend = _target_and_resend(spark, sf)
    return warehouse.incremental_load(target, resend, "event_id", "event_ts")


# ---- dashboard -------------------------------------------------------------------------------
def q_kpi_cards(spark, sf):
    return D.kpi_cards(_fact(spark, sf, plant=False), "2024-01-08", "2024-01-22")


def q_events_by_plant(spark, sf):
    return D.events_by_plant(_fact(spark, sf), _plants(spark, sf))


def q_temperature_trend(spark, sf):
    return D.temperature_trend(_fact(spark, sf, plant=False), "HOUR", by_device=True)


def q_breach_points(spark, sf):
    return D.breach_points(_fact(spark, sf, plant=False), "TEMPERATURE")


def q_top5_hottest(spark, sf):
    return D.top_hottest(_fact(spark, sf, plant=False), T.dim_device(spark, sf), 5)


def q_top10_values(spark, sf):
    return D.top_breaches(_fact(spark, sf, plant=False), 10)


def q_top20_alarm_hours(spark, sf):
    return D.top_alarm_hours(A.hourly_plant_kpis(_fact(spark, sf), _plants(spark, sf)), 20, 3)


def q_plant_performance(spark, sf):
    return D.plant_performance(_fact(spark, sf), _plants(spark, sf))


def q_wow_alarms(spark, sf):
    return D.wow_alarms(_fact(spark, sf), _plants(spark, sf), AS_OF)


def q_alarm_trend_8w(spark, sf):
    return D.alarm_trend(_fact(spark, sf), _plants(spark, sf), AS_OF, 8)


def q_cumulative_alarms(spark, sf):
    return D.cumulative_alarms(_fact(spark, sf), _plants(spark, sf))


def q_threshold_alerts(spark, sf):
    fact = _fact(spark, sf).withColumn("breach_int", F.col("threshold_breach").cast("int"))
    return evaluate_alerts(fact, "event_ts", "plant_sk", [
        AlertRule("breach_count", "breach_int", "sum", 1, ">=", 1),
        AlertRule("max_value", "value_numeric", "max", 90.0, ">", 2),
    ], "5 minutes")


# ---- diagnostics (rows-only) ------------------------------------------------------------------
def q_dataset_size_report(spark, sf):
    return dataset_size_report(spark, {n: table_path(sf, n) for n in TABLES})


QUERIES = {
    "weekly_plant_mart": q_weekly_plant_mart,
    "weekly_report_after": q_weekly_report_after,
    "weekly_report_after_hll": q_weekly_report_after_hll,
    "weekly_report_after_sketch": q_weekly_report_after_sketch,
    "weekly_report_before": q_weekly_report_before,
    "hourly_plant_kpis": q_hourly_plant_kpis,
    "stg_iot_events": q_stg_iot_events,
    "anomaly_flags": q_anomaly_flags,
    "sigma_anomalies": q_sigma_anomalies,
    "minute_window_agg": q_minute_window_agg,
    "hour_window_agg": q_hour_window_agg,
    "iot_partition_cols": q_iot_partition_cols,
    "registry_left_join": q_registry_left_join,
    "log_dq_flags": q_log_dq_flags,
    "log_dq_split_counts": q_log_dq_split_counts,
    "log_dedup_latest": q_log_dedup_latest,
    "log_enriched": q_log_enriched,
    "run_metrics": q_run_metrics,
    "dq_fail_rate": q_dq_fail_rate,
    "sla_ack_breach": q_sla_ack_breach,
    "calendar_dim": q_calendar_dim,
    "sk_lookup": q_sk_lookup,
    "scd2_asof_join": q_scd2_asof_join,
    "fk_orphans": q_fk_orphans,
    "conditional_counts": q_conditional_counts,
    "exact_distinct_weekly": q_exact_distinct_weekly,
    "approx_distinct_weekly": q_approx_distinct_weekly,
    "table_row_counts": q_table_row_counts,
    "upsert_events": q_upsert_events,
    "upsert_table": q_upsert_table,
    "lake_to_fact": q_lake_to_fact,
    "incremental_load": q_incremental_load,
    "kpi_cards": q_kpi_cards,
    "events_by_plant": q_events_by_plant,
    "temperature_trend": q_temperature_trend,
    "breach_points": q_breach_points,
    "top5_hottest": q_top5_hottest,
    "top10_values": q_top10_values,
    "top20_alarm_hours": q_top20_alarm_hours,
    "plant_performance": q_plant_performance,
    "wow_alarms": q_wow_alarms,
    "alarm_trend_8w": q_alarm_trend_8w,
    "cumulative_alarms": q_cumulative_alarms,
    "threshold_alerts": q_threshold_alerts,
    "dataset_size_report": q_dataset_size_report,
}


# ---- streaming and alert queries added after the first registry -------------------------------
def q_stream_enriched_events(spark, sf):
    """The streaming IoT job run to completion over the whole ``iot_raw`` table: records are
    landed as JSON in the shared checkpoint folder (every 20th twice) in six files or more, dealt by a
    hash so that each spans the whole time, and streamed in six micro-batches through anomaly flags /
    registry join / partition columns into the idempotent sink; the sink's table is returned.
    No row is lost for being late, and no copy stays, whichever batch brings it."""
    import uuid

    from sensorwerk.config import checkpoint_dir
    from sensorwerk.functions.columns import ts_to_epoch_ms
    from sensorwerk.streaming import iot

    base = f"{checkpoint_dir(spark).rstrip('/')}/stream-query-{uuid.uuid4().hex}"
    src = T.iot_raw(spark, sf).withColumn("timestamp_ms", ts_to_epoch_ms("event_ts")).drop("event_ts")
    # every 20th event is delivered twice (at-least-once transport); the job must drop the copy
    again = F.substring("event_id", 5, 20).cast("long") % 20 == 0
    copies = F.explode(F.when(again, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    n = load_queries.land(src.withColumn("_copy", copies), f"{base}/landing", "event_id", "_copy")
    stream = iot.read_iot_stream(spark, f"{base}/landing", max_files=max(1, n // 6))
    out = iot.run_to_completion(spark, iot.iot_pipeline(stream, T.device_registry(spark, sf)),
                                f"{base}/processed", f"{base}/checkpoint")
    return out.select("event_id", "device_id", "plant_id", "timestamp_ms", "threshold_breach", "quality_bad",
                      "anomaly_score", "asset_name", "criticality", "year", "month", "day", "hour")


def q_dq_failure_alerts(spark, sf):
    """Failure alarm re-aimed at data quality: per plant, any failing log record in a
    5-minute period raises it (Sum >= 1 over 1 period)."""
    logs = enrich.enrich_logs(_logs_deduped(spark, sf), RUN_TS)
    failed = logs.withColumn("failed", (~F.col("dq_pass_strict")).cast("int"))
    return evaluate_alerts(failed, "event_ts", "plant_code", [AlertRule("dq_failures", "failed", "sum", 1, ">=", 1)])


def q_log_job_output(spark, sf):
    """The batch log job run over the whole log table landed as JSON lines: its processed
    (clean) output is read back with the written schema."""
    import uuid

    from sensorwerk.config import checkpoint_dir
    from sensorwerk.plans.jobs import run_log_job
    from sensorwerk.sinks import lake

    base = f"{checkpoint_dir(spark).rstrip('/')}/log-job-query-{uuid.uuid4().hex}"
    T.log_raw(spark, sf).drop("resolution_minutes").write.json(f"{base}/raw")
    run_log_job(spark, f"{base}/raw", f"{base}/processed", f"{base}/quarantine", f"{base}/dq",
                run_id="query", run_ts=RUN_TS, partition_cols=lake.BACKFILL_PARTITIONS)
    out = spark.read.option("basePath", f"{base}/processed").schema(
        "event_id string, event_timestamp long, event_type string, severity string, temperature_c double, "
        "event_ts timestamp_ntz, hour string, is_alarm boolean, is_critical boolean, processed_at timestamp_ntz, "
        "temp_fahrenheit double, plant_code string, year string, month string, day string").parquet(f"{base}/processed")
    return out.select("event_id", "event_timestamp", "event_type", "severity", "event_ts", "year", "month", "day",
                      "hour", "plant_code", "is_alarm", "is_critical", "temp_fahrenheit")


QUERIES["stream_enriched_events"] = q_stream_enriched_events
QUERIES["log_job_output"] = q_log_job_output
QUERIES["dq_failure_alerts"] = q_dq_failure_alerts
QUERIES.update(load_queries.QUERIES)
