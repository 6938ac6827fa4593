"""Registered queries of the loads, streams and sinks: each runs a job over data derived from the whole
tables and reads back what it wrote. Their SQL twins are in :mod:`sensorwerk.plans.load_oracle`."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorwerk import schemas as S
from sensorwerk.config import checkpoint_dir
from sensorwerk.functions.columns import epoch_ms_to_ts, ntz, round_numeric, ts_to_epoch_ms
from sensorwerk.plans import loads
from sensorwerk.sinks import lake
from sensorwerk.sinks.snapshot import Snapshots, replace_rows
from sensorwerk.sources import standins as T
from sensorwerk.streaming import iot, windows

RUN_TS = "2024-02-01 00:00:00"
CUTOFF, RESEND_FROM = "2024-01-20 00:00:00", "2024-01-15 00:00:00"
LANDING_BYTES = 64 << 20          # of a landed file, about


def fresh(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-query-{uuid.uuid4().hex}"


def land(rows: DataFrame, path: str, *by: str, least: int = 6) -> int:
    """JSON files of about equal size, ``least`` at the fewest; a row goes by a hash, so a device with many
    rows is spread and every file spans the whole time. Returns the number of files asked for, which follows
    the bytes of the rows themselves: the planner's estimate of joined rows is the product of both sides."""
    n = max(least, lake.rows_bytes(rows) // LANDING_BYTES)
    rows.repartition(n, *by).write.json(path)
    return n


def _landed_events(spark, sf, path: str) -> int:
    src = T.iot_raw(spark, sf).withColumn("timestamp_ms", ts_to_epoch_ms("event_ts")).drop("event_ts")
    return land(src, path, "event_id")


WINDOW_KEYS = ("plant_id", "event_name", "unit")


def _windows(spark, sf) -> str:
    """Hourly windows of the stream over at least six micro-batches, each of which spans the whole time, so
    that most rows of all but the first come behind the watermark."""
    base = fresh(spark, "stream-window")
    n = _landed_events(spark, sf, f"{base}/landing")
    stream = iot.read_iot_stream(spark, f"{base}/landing", max_files=max(1, n // 6), corrupt_col=None)
    windows.start_windows(stream, f"{base}/windows", f"{base}/checkpoint", "1 hour", WINDOW_KEYS,
                          trigger={"availableNow": True}).awaitTermination()
    return f"{base}/windows"


def _hours(rows: DataFrame) -> DataFrame:
    rounded = [round_numeric(c, 4).alias(c) for c in ("avg_value", "stddev_value", "avg_quality")]
    return rows.select(epoch_ms_to_ts(F.unix_millis("window_start")).alias("window_start"), *WINDOW_KEYS, rounded[0], "min_value",
                       "max_value", rounded[1], "event_count", rounded[2], "low_quality_count")


def stream_window_stats(spark, sf):
    """The windows that ended five minutes before the latest event, late rows included."""
    return _hours(windows.read_windows(spark, _windows(spark, sf), WINDOW_KEYS, closed_after=S.WATERMARK_MINUTES))


def stream_window_open(spark, sf):
    """All windows, those still open too."""
    return _hours(windows.read_windows(spark, _windows(spark, sf), WINDOW_KEYS))


def stream_window_arrivals(spark, sf):
    """On-time and late rows of the windowed stream add up to the input, and all are in windows."""
    seen = windows.arrivals(spark, _windows(spark, sf))
    return seen.select("rows_in", "in_windows", (F.col("on_time") + F.col("late") + F.col("untimed") == F.col("rows_in")).alias("accounted"),
                       (F.col("batches") >= 6).alias("several_batches"), (F.col("late") > 0).alias("late_rows_came"))


def upsert_snapshot(spark, sf):
    """The upsert of ``upsert_table`` as one commit of a snapshot table."""
    rows = T.fact_iot_events(spark, sf, plant=False).selectExpr("event_sk", "event_id", "device_sk", "value_numeric", "event_ts")
    day = "CASE WHEN event_sk % 7 = 0 THEN CAST(NULL AS date) ELSE cast(event_ts AS date) END"
    target = rows.filter(F.col("event_ts") < ntz(CUTOFF)).withColumn("event_date", F.expr(day))
    staging = rows.filter(F.col("event_ts") >= ntz(RESEND_FROM)).selectExpr(
        "event_sk", "event_id", "device_sk", "value_numeric + 1 AS value_numeric", "event_ts",
        f"CASE WHEN event_sk % 3 = 0 THEN date_add(cast(event_ts AS date), 1) ELSE {day} END AS event_date")
    snap = Snapshots(spark, f"{fresh(spark, 'snapshot')}/warehouse")
    state = snap.commit(snap.state(), {"fact": replace_rows(snap, snap.state(), "fact", target, ["event_date"])})
    snap.commit(state, {"fact": replace_rows(snap, state, "fact", staging, ["event_date"])})
    return snap.table("fact").select("event_id", "device_sk", "value_numeric", "event_date")


def minute_stats_loads(spark, sf):
    """Three loads that share their minutes: events of even and of odd number, then every ninth event again
    with another value. Times are folded to five minutes a day, so that a device-minute has many rows."""
    rows = T.fact_iot_events(spark, sf, plant=False).where("event_sk IS NOT NULL").selectExpr(
        "event_sk", "event_id", "device_sk % 5 AS device_sk", "event_name", "value_numeric",
        "timestampadd(MINUTE, cast(event_sk % 5 AS int), date_trunc('DAY', event_ts)) AS event_ts").withColumn(
        "event_ts", F.col("event_ts").cast("timestamp_ntz"))
    root = f"{fresh(spark, 'minutes')}/warehouse"
    loads.load_events(spark, root, rows.where("event_sk % 2 = 0"))
    loads.load_events(spark, root, rows.where("event_sk % 2 = 1"))
    loads.load_events(spark, root, rows.where("event_sk % 9 = 0").withColumn("value_numeric", F.col("value_numeric") * 2))
    return Snapshots(spark, root).table(loads.FACT).select(
        "event_id", "device_sk", "event_name", "event_ts", "value_numeric",
        *[round_numeric(c, 4).alias(c) for c in ("avg_value_1min", "stddev_value_1min")])


def staging_cycle(spark, sf):
    """Two staged batches, the second with keys of the first; the staging prefix is empty after each."""
    rows = T.fact_iot_events(spark, sf, plant=False).select("event_sk", "event_id", "device_sk", "event_name", "value_numeric", "event_ts")
    base = fresh(spark, "staging")
    left = 0
    for part in (rows.where(F.col("event_ts") < ntz(CUTOFF)),
                 rows.where(F.col("event_ts") >= ntz(RESEND_FROM)).withColumn("value_numeric", F.col("value_numeric") + 1)):
        part.write.mode("append").parquet(f"{base}/staging")
        loads.load_and_empty(spark, f"{base}/warehouse", f"{base}/staging")
        left += len(loads.staged_files(spark, f"{base}/staging"))
    return Snapshots(spark, f"{base}/warehouse").table(loads.FACT).select(
        "event_id", "device_sk", "value_numeric", F.lit(left).alias("files_left"))


# ---- the log job over a growing prefix ------------------------------------------------------------
def land_logs(spark, sf, path: str, part: int, parts: int = 2) -> None:
    """Raw log lines of one of several arrivals: re-sent copies come with the last, and of every 50th event a
    line that is cut off comes with its own."""
    rows = T.log_raw(spark, sf).withColumn("no", F.substring("event_id", 5, 20).cast("long"))
    mine = F.when(F.col("resend") == 1, F.lit(parts - 1)).otherwise(F.pmod(F.col("no"), F.lit(parts))) == part
    rows = rows.where(mine)
    lines = rows.select(F.to_json(F.struct(*[c for c in rows.columns if c not in ("resolution_minutes", "no", "resend")])).alias("value"))
    broken = rows.where("no % 50 = 0 AND resend = 0").select(F.concat(F.lit('{"event_id": "LOG-'), F.col("no").cast("string"), F.lit('", ')).alias("value"))
    lines.unionByName(broken).write.mode("append").text(path)


def _log_lake(spark, sf) -> Snapshots:
    base = fresh(spark, "log-lake")
    for part in range(2):
        land_logs(spark, sf, f"{base}/raw", part)
        loads.run_log_increment(spark, f"{base}/raw", f"{base}/lake", run_ts=RUN_TS, run_id=f"run-{part}", partition_cols=lake.BACKFILL_PARTITIONS)
    loads.run_log_increment(spark, f"{base}/raw", f"{base}/lake", run_ts=RUN_TS, run_id="run-idle")
    return Snapshots(spark, f"{base}/lake")


def log_job_twice(spark, sf):
    """Clean rows after two runs over a growing prefix and one without new files."""
    return _log_lake(spark, sf).table(loads.PROCESSED).select(
        "event_id", "event_timestamp", "event_type", "severity", "event_ts", "year", "month", "day", "hour", "plant_code",
        "is_alarm", "is_critical", "temp_fahrenheit")


def log_job_failures(spark, sf):
    return _log_lake(spark, sf).table(loads.FAILURES).select("event_id", "event_timestamp", "plant_code", "dq_pass", "dq_reason", "year", "month")


def log_job_quarantine(spark, sf):
    return _log_lake(spark, sf).table(loads.QUARANTINE).select(F.col(S.CORRUPT_COL).alias("raw_value"), "job_run",
                                                               F.col("event_id").isNull().alias("unparsed"))


def log_job_runs(spark, sf):
    """What the ledger and the quarantine hold per run: files once each, corrupt lines."""
    snap = _log_lake(spark, sf)
    ledger = snap.table(loads.LEDGER).groupBy("job_run").agg((F.count("*") == F.count_distinct("path")).alias("files_once"))
    bad = snap.table(loads.QUARANTINE).groupBy("job_run").agg(F.count("*").alias("corrupt_records"))
    return ledger.join(bad, "job_run", "left").select("job_run", "files_once", F.coalesce("corrupt_records", F.lit(0)).alias("corrupt_records"))


def machine_log_load(spark, sf):
    """Clean log rows of the lake as the machine log fact, in two batches; then the alarms come again, resolved."""
    from sensorwerk.operators import warehouse

    root = f"{fresh(spark, 'log-fact')}/warehouse"
    rows = warehouse.fact_logs(_log_lake(spark, sf).table(loads.PROCESSED), T.dim_device(spark, sf), T.dim_plant(spark, sf))
    no = F.substring("event_id", 5, 20).cast("long")
    for part in (0, 1):
        loads.load_logs(spark, root, rows.where(F.pmod(no, F.lit(2)) == part))
    resolved = F.when(no % 13 != 0, (no % 11).cast("int"))
    loads.load_logs(spark, root, rows.where("is_alarm").withColumn("resolution_minutes", resolved))
    return Snapshots(spark, root).table(loads.MACHINE_LOGS).select(
        "event_id", "machine_id", "device_sk", "plant_sk", "date_sk", "event_ts", "event_type", "severity", "is_alarm", "is_critical",
        "resolution_minutes", "year", "month")


QUERIES = {f.__name__: f for f in (
    machine_log_load, stream_window_stats, stream_window_open, stream_window_arrivals, upsert_snapshot, minute_stats_loads, staging_cycle,
    log_job_twice, log_job_failures, log_job_quarantine, log_job_runs)}


# ---- catalog, models, dimensions, further sinks ------------------------------------------------------
def scd2_asof_carry(spark, sf):
    """The as-of join by carrying versions forward."""
    from sensorwerk.operators import dims

    versions = T.dim_device_scd2(spark, sf).select("device_id", "criticality", "sla_minutes", "valid_from", "valid_to")
    events = T.iot_raw(spark, sf, plant=False).select("event_id", "device_id", "event_ts")
    return dims.asof_carry(events, versions).select("event_id", "device_id", "event_ts", F.col("criticality").alias("criticality_at_event"),
                                                    "sla_minutes", "valid_from")


def lake_discovery(spark, sf):
    """A folder that grows between two visits: first days without ``quality``, later ones with it, and folders
    that are no data."""
    from sensorwerk.sources.raw import sync_lake_table

    base, name = fresh(spark, "discovery"), f"lake_{uuid.uuid4().hex}"
    rows = T.iot_raw(spark, sf, plant=False).withColumn("event_date", F.to_date("event_ts")).where("event_date IS NOT NULL")
    old = rows.where(F.col("event_ts") < ntz(CUTOFF)).select("event_id", "device_id", "value_numeric", "event_date")
    lake.write_partitioned(old, f"{base}/lake", ["event_date"])
    sync_lake_table(spark, name, f"{base}/lake", ["event_date"], {"event_date": "date"})
    new = rows.where(F.col("event_ts") >= ntz(CUTOFF)).select("event_id", "device_id", "value_numeric", "quality", "event_date")
    lake.write_partitioned(new, f"{base}/later", ["event_date"])
    new.select("event_id").write.parquet(f"{base}/lake/_spark_staging")
    lake.write_partitioned(spark.read.schema(new.schema).parquet(f"{base}/later"), f"{base}/lake", ["event_date"])
    rows.select("event_id").write.parquet(f"{base}/lake/_temporary/0")              # what a writer that died left
    sync_lake_table(spark, name, f"{base}/lake", ["event_date"])
    return spark.table(name).select("event_id", "device_id", "value_numeric", "quality", "event_date")


def model_graph(spark, sf):
    """Staging view and weekly mart as models; the mart refers to the view and to the plants."""
    from sensorwerk.operators import aggregates as A
    from sensorwerk.plans.catalog import Catalog
    from sensorwerk.sources.tables import read_table

    tag = uuid.uuid4().hex
    cat = Catalog(spark)
    for name in ("events", "customer", "nation", "region"):
        cat.add_source(name, lambda s, n=name: read_table(s, sf, n))
    sources = ("events", "customer")
    cat.add_model(f"stg_{tag}", lambda c: A.stg_iot_events(T.fact_iot_events(spark, sf)), "view", sources=sources)
    cat.add_model(f"plants_{tag}", lambda c: T.dim_plant(spark, sf), "view", sources=("nation", "region"))
    cat.add_model(f"mart_{tag}", lambda c: A.weekly_plant_events(c.ref(f"stg_{tag}")).join(
        c.ref(f"plants_{tag}").select("plant_sk", "plant_name"), "plant_sk"), "table", refs=(f"stg_{tag}", f"plants_{tag}"))
    cat.run([f"mart_{tag}"])
    if cat.run():
        raise AssertionError("a model was built again without need")
    return cat.ref(f"mart_{tag}").select("week_start", "plant_name", "total_events", "total_alarms", "high_anomalies",
                                         *[round_numeric(c, 4).alias(c) for c in ("avg_value", "avg_quality")])


def registry_missing(spark, sf):
    """Enrichment against a registry path that is not there: every event stays, without attributes."""
    from sensorwerk.operators import enrich
    from sensorwerk.sources.raw import load_registry

    registry = load_registry(spark, f"{fresh(spark, 'registry')}/none")
    return enrich.enrich_with_registry(T.iot_raw(spark, sf, plant=False), registry).select("event_id", "device_id", "asset_name", "criticality")


def staging_json(spark, sf):
    """A staging prefix with nested columns: arrays and structs come as JSON text."""
    from sensorwerk.sources.raw import load_staging

    base = fresh(spark, "nested")
    T.iot_raw(spark, sf, plant=False).select(
        "event_id", F.array("unit", "event_name").alias("tags"), F.struct("device_id", "quality").alias("reading")).write.parquet(f"{base}/staging")
    return load_staging(spark, f"{base}/staging", ["event_id", "tags", "reading"])


def stream_batch_metrics(spark, sf):
    """Record and alarm counts of all micro-batches of the streaming job, added up."""
    base = fresh(spark, "metrics")
    n = _landed_events(spark, sf, f"{base}/landing")
    metrics = iot.BatchMetrics()
    stream = iot.read_iot_stream(spark, f"{base}/landing", max_files=max(1, n // 3))
    iot.run_to_completion(spark, iot.iot_pipeline(stream, T.device_registry(spark, sf)), f"{base}/out", f"{base}/checkpoint", metrics)
    rows = spark.createDataFrame([(r["batch_id"], r["records"], r["alarms"]) for r in metrics.rows], "batch_id long, records long, alarms long")
    return rows.agg(F.sum("records").alias("records"), F.sum("alarms").alias("alarms"), (F.count("*") >= 3).alias("several_batches"))


def topic_landing(spark, sf):
    """Kafka-shaped messages, landed raw by the hour of their own time; every 40th is cut off: it goes to the
    dead letters as well and lies in the partition without a time."""
    from sensorwerk.streaming import landing

    base = fresh(spark, "landing")
    src = T.iot_raw(spark, sf).withColumn("timestamp_ms", ts_to_epoch_ms("event_ts")).drop("event_ts")
    no = F.substring("event_id", 5, 20).cast("long")
    value = F.to_json(F.struct(*src.columns))
    messages = src.select(F.col("device_id").alias("key"), F.when(no % 40 == 0, F.concat(F.lit('{"timestamp_ms": '), F.col("timestamp_ms").cast("string"),
                          F.lit(', "device_id": '))).otherwise(value).alias("value"), F.lit("factory-iot-events").alias("topic"),
                          (no % 3).cast("int").alias("partition"), no.alias("offset"), F.lit(RUN_TS).cast("timestamp").alias("timestamp"))
    messages.write.parquet(f"{base}/topic")
    stream = spark.readStream.schema(messages.schema).parquet(f"{base}/topic")
    _, dead = landing.split_dead_letters(landing.parse_values(stream))
    for q in (landing.start_landing(stream, f"{base}/raw", f"{base}/c1", {"availableNow": True}),
              landing.start_dead_letters(dead, f"{base}/dead", f"{base}/c2", {"availableNow": True})):
        q.awaitTermination()
    raw = spark.read.schema("topic string, year string, month string, day string, hour string, key string, value string, "
                            "partition int, offset long").json(f"{base}/raw")
    lost = spark.read.schema("source_topic string, offset long, error string").json(f"{base}/dead")
    return raw.join(lost.select(F.col("offset").alias("_o"), "error"), F.col("offset") == F.col("_o"), "left").select(
        "topic", "offset", "partition", "key", "year", "month", "day", "hour", F.col("error").isNotNull().alias("dead_letter"))


def hourly_refresh(spark, sf):
    """The hourly roll-up after a full build and an incremental refresh of the days that a second load touched."""
    from sensorwerk.functions.columns import day_start
    from sensorwerk.plans import jobs

    base, plants = fresh(spark, "refresh"), T.dim_plant(spark, sf)
    rows = T.fact_iot_events(spark, sf)
    first = rows.where(F.col("event_ts") < ntz(CUTOFF)).withColumn("event_date", day_start("event_ts"))
    lake.write_partitioned(first, f"{base}/fact", ["event_date"])
    jobs.refresh_hourly(spark, f"{base}/fact", plants, f"{base}/hourly")
    second = rows.where(F.col("event_ts") >= ntz(RESEND_FROM)).withColumn("quality", F.col("quality") - F.lit(1).cast("smallint"))
    touched = jobs.load_fact_batch(spark, f"{base}/fact", second)
    jobs.refresh_hourly(spark, f"{base}/fact", plants, f"{base}/hourly", touched)
    return spark.read.parquet(f"{base}/hourly").select("event_hour", "plant_name", "total_events", "alarm_count", "high_anomaly_count",
                                                       "low_quality_events", "sum_quality", "n_quality")


def cycle_hourly(spark, sf):
    """Two warehouse cycles over staged batches of a snapshot root; the roll-up after the second, whose batch sends a
    week again with other values."""
    base, plants = fresh(spark, "cycle"), T.dim_plant(spark, sf)
    rows = T.fact_iot_events(spark, sf)
    for part in (rows.where(F.col("event_ts") < ntz(CUTOFF)),
                 rows.where(F.col("event_ts") >= ntz(RESEND_FROM)).withColumn("quality", F.col("quality") - F.lit(1).cast("smallint"))):
        part.write.mode("append").parquet(f"{base}/staging")
        loads.run_cycle(spark, f"{base}/warehouse", f"{base}/staging", plants, "2024-01-31", f"{base}/report")
    return Snapshots(spark, f"{base}/warehouse").table(loads.HOURLY).select(
        "event_hour", "plant_name", "total_events", "alarm_count", "high_anomaly_count", "low_quality_events", "sum_quality", "n_quality")


def approx_distinct_bounds(spark, sf):
    """Approximate device counts of every plant-week beside the exact ones: all within their error bounds."""
    from sensorwerk.operators import aggregates as A

    fact = T.fact_iot_events(spark, sf)
    exact = A.weekly_devices(fact, exact=True).withColumnRenamed("active_devices", "exact_devices")
    hll = A.weekly_devices(fact, exact=False, rsd=0.02).withColumnRenamed("active_devices", "hll")
    sketch = A.weekly_devices_from_sketches(A.hourly_plant_kpis(fact, T.dim_plant(spark, sf), device_sketch=True)).withColumnRenamed("active_devices", "sketch")
    near = lambda c, rsd: F.abs(F.col(c) - F.col("exact_devices")) <= F.greatest(F.lit(1.0), 4 * rsd * F.col("exact_devices"))
    both = exact.join(hll, ["week_start", "plant_sk"]).join(sketch, ["week_start", "plant_sk"])
    return both.select("week_start", "plant_sk", "exact_devices", near("hll", 0.02).alias("hll_within"), near("sketch", 0.02).alias("sketch_within"))


QUERIES.update({f.__name__: f for f in (
    scd2_asof_carry, lake_discovery, model_graph, registry_missing, staging_json, stream_batch_metrics, topic_landing, hourly_refresh, cycle_hourly,
    approx_distinct_bounds)})
