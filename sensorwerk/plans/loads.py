"""Loads that commit in one step: event batches with their minute statistics (SNK-8, A-1) and the
batch log job with its ledger of files (SRC-8, SNK-1..3).

Both write to a :class:`~sensorwerk.sinks.snapshot.Snapshots` root, so rows, statistics, ledger and
the mark of what was consumed come into force together. A load that is repeated after a crash begins
at the last state and gives the same result.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sensorwerk import schemas as S
from sensorwerk.config import checkpoint_dir
from sensorwerk.functions.columns import bucket_start, day_start
from sensorwerk.operators import aggregates as A
from sensorwerk.operators import dedup, enrich, moments, quality
from sensorwerk.operators.dedup import keep_latest
from sensorwerk.plans import reports
from sensorwerk.sinks import lake
from sensorwerk.sinks.snapshot import Change, Snapshots, State, replace_rows
from sensorwerk.sources.raw import read_raw_logs

FACT, MINUTES, HOURLY = "fact", "minutes", "hourly"
STALE = "stale_days"                             # note of a state: days whose roll-up is older than the fact
FACT_ORDER = ("event_ts", "device_sk")           # files hold time ranges: range scans skip the others
MACHINE_LOGS, LOG_ORDER = "machine_logs", ("event_ts", "plant_sk")
MINUTE_KEYS = ["device_sk", "event_name", "minute"]
MINUTE_COLUMNS = [*MINUTE_KEYS, *moments.names("value")]


# ---- event batches -------------------------------------------------------------------------------
def _with_minute(rows: DataFrame) -> DataFrame:
    return rows.withColumn("minute", bucket_start("event_ts", "MINUTE"))


def _minutes_of(rows: DataFrame) -> DataFrame:
    """Parts of the statistics of the device-minutes in ``rows`` (rows without device, event or time have none)."""
    timed = _with_minute(rows).dropna(subset=MINUTE_KEYS)
    return timed.groupBy(*MINUTE_KEYS).agg(*moments.parts("value", F.col("value_numeric")))


def load_events(spark: SparkSession, root: str, staging: DataFrame, key: str = "event_id", dedup_staging: bool = False,
                order: tuple[str, ...] = ("event_ts",), notes: dict | None = None,
                before_commit: Callable[[], None] | None = None) -> State:
    """Upserts a batch into the ``fact`` table of ``root`` and merges its device-minutes into ``minutes``.

    A staged key replaces its old row wherever that lies. The statistics of a minute are the held parts
    merged with the batch's (Chan's formula); a minute that loses a row to the batch is made anew from
    the rows that stay. Rows of the touched minutes get the merged ``avg_value_1min`` and
    ``stddev_value_1min``, earlier loads' rows too, so that loads in any number and order of batches
    equal one load of all. Both tables come into force with one commit.
    """
    snap = Snapshots(spark, root)
    state = snap.state()
    scratch = f"{checkpoint_dir(spark).rstrip('/')}/load-{uuid.uuid4().hex}"
    if dedup_staging:
        staging = keep_latest(staging, key, list(order), null_keys="keep")
    staging.withColumn("event_date", day_start("event_ts")).write.parquet(f"{scratch}/staged")      # read several times
    staged = spark.read.parquet(f"{scratch}/staged")
    staged.select(key).where(F.col(key).isNotNull()).distinct().write.parquet(f"{scratch}/keys")
    keys = spark.read.parquet(f"{scratch}/keys")
    new = _minutes_of(staged)
    if state.folders(FACT):
        held, gone = snap.table(FACT, state), lake.join_side(keys)
        lost = _with_minute(held.join(gone, key, "left_semi")).select(*MINUTE_KEYS).dropna().distinct()
        lost.write.parquet(f"{scratch}/lost")
        lost = lake.join_side(spark.read.parquet(f"{scratch}/lost"))
        touched = new.select(*MINUTE_KEYS).unionByName(lost).distinct()
        days = [r[0] for r in touched.select(F.to_date("minute")).distinct().collect()]              # a row a day
        of_days = F.col("event_date").isin(days)
        left = held.where(of_days).join(gone, key, "left_anti")
        again = _minutes_of(_with_minute(left).join(lost, MINUTE_KEYS, "left_semi").drop("minute"))
        stays = snap.table(MINUTES, state).where(of_days).join(touched, MINUTE_KEYS, "left_semi").join(lost, MINUTE_KEYS, "left_anti")
        parts = new.unionByName(again).unionByName(stays.select(*MINUTE_COLUMNS))
    else:
        touched, of_days, parts = new.select(*MINUTE_KEYS), F.lit(False), new
    touched.write.parquet(f"{scratch}/touched")
    touched = lake.join_side(spark.read.parquet(f"{scratch}/touched"))
    moments.merge(parts, MINUTE_KEYS, ["value"]).write.parquet(f"{scratch}/merged")
    merged = spark.read.parquet(f"{scratch}/merged")

    stats = merged.select(*MINUTE_KEYS, F.col("value_mean").alias("avg_value_1min"), moments.stddev("value").alias("stddev_value_1min"))
    touched_stats = touched.join(stats, MINUTE_KEYS, "left").withColumn("_touched", F.lit(True))

    def with_stats(rows: DataFrame) -> DataFrame:
        old = {c: F.col(c) if c in rows.columns else F.lit(None).cast("double") for c in ("avg_value_1min", "stddev_value_1min")}
        own = _with_minute(rows).withColumns({f"_{c}": x for c, x in old.items()}).drop(*old)
        both = own.join(touched_stats, MINUTE_KEYS, "left")
        fresh = {c: F.when(F.col("_touched"), F.col(c)).otherwise(F.col(f"_{c}")) for c in old}
        return both.withColumns(fresh).select(*[c for c in rows.columns if c not in old], *old)

    def same_minute(rows: DataFrame) -> DataFrame:
        return _with_minute(rows.where(of_days)).join(touched, MINUTE_KEYS, "left_semi")

    plain = staged.drop("avg_value_1min", "stddev_value_1min").withColumns(
        {c: F.lit(None).cast("double") for c in ("avg_value_1min", "stddev_value_1min")})
    fact = replace_rows(snap, state, FACT, plain, ["event_date"], keys, key, same_minute, with_stats,
                        order=FACT_ORDER, size=lake.rows_bytes(plain))

    rows = merged.withColumn("event_date", F.to_date("minute"))
    old = snap.holding(MINUTES, state, lambda t: t.where(of_days).join(touched, MINUTE_KEYS, "left_semi"))
    if old:
        kept = snap.table(MINUTES, state, old).join(touched, MINUTE_KEYS, "left_anti")
        rows = kept.unionByName(rows.select(*kept.columns))
    minutes = Change(rows.schema, ["event_date"], old, snap.write(MINUTES, rows, ["event_date"]))
    if before_commit:
        before_commit()
    stale = sorted({*state.notes.get(STALE, []), *map(_day_of, fact.drops + fact.adds)})
    done = snap.commit(state, {FACT: fact, MINUTES: minutes}, {**(notes or {}), STALE: stale})
    lake.remove(spark, scratch)
    return done


def _day_of(folder: str) -> str:
    """The day of a partition folder; events without a time lie in ``__HIVE_DEFAULT_PARTITION__``."""
    return unquote(folder.rsplit("event_date=", 1)[1])


def refresh_hourly(spark: SparkSession, root: str, plants: DataFrame, before_commit: Callable[[], None] | None = None) -> State:
    """Brings the ``hourly`` roll-up of ``root`` up to date (SNK-10): the days that loads have changed since the last
    refresh are made anew from the fact, the others stay. A load notes its days in the same commit, so a
    crash between load and refresh loses none; a day without events any more loses its rows."""
    snap = Snapshots(spark, root)
    state = snap.state()
    days = [d for d in state.notes.get(STALE, []) if d != "__HIVE_DEFAULT_PARTITION__"]
    if days:
        fact = snap.table(FACT, state).where(F.col("event_date").isin([F.lit(d).cast("date") for d in days]))
        rows = A.hourly_plant_kpis(fact, plants, device_sketch=True).withColumn("event_date", F.to_date("event_hour"))
        old = [f for f in state.folders(HOURLY) if _day_of(f) in days]
        change = Change(rows.schema, ["event_date"], old, snap.write(HOURLY, rows, ["event_date"]))
        if before_commit:
            before_commit()
        state = snap.commit(state, {HOURLY: change}, {**state.notes, STALE: []})
    return state


def run_cycle(spark: SparkSession, root: str, staging_path: str, plants: DataFrame, as_of: str, report_path: str, days: int = 7,
              prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """Staging prefix -> fact and minutes -> hourly roll-up of the changed days -> weekly report from the roll-up alone."""
    load_and_empty(spark, root, staging_path, prepare)
    state = refresh_hourly(spark, root, plants)
    hourly = Snapshots(spark, root).table(HOURLY, state).drop("event_date")
    reports.weekly_report_after(None, plants, as_of, days, hourly=hourly, devices="sketch").write.mode("overwrite").parquet(report_path)
    return spark.read.parquet(report_path)


def load_logs(spark: SparkSession, root: str, staging: DataFrame, key: str = "event_id", notes: dict | None = None,
              before_commit: Callable[[], None] | None = None) -> State:
    """Upserts rows of the machine log fact (:func:`~sensorwerk.operators.warehouse.fact_logs`) into the table
    ``machine_logs`` of ``root``, ordered by time and plant inside its days."""
    snap = Snapshots(spark, root)
    state = snap.state()
    scratch = f"{checkpoint_dir(spark).rstrip('/')}/load-{uuid.uuid4().hex}"
    staging.withColumn("event_date", day_start("event_ts")).write.parquet(scratch)
    staged = spark.read.parquet(scratch)
    change = replace_rows(snap, state, MACHINE_LOGS, staged, ["event_date"], key=key, order=LOG_ORDER, size=lake.rows_bytes(staged))
    if before_commit:
        before_commit()
    done = snap.commit(state, {MACHINE_LOGS: change}, {**(notes or {}), STALE: state.notes.get(STALE, [])})
    lake.remove(spark, scratch)
    return done


def staged_files(spark: SparkSession, path: str) -> list[str]:
    """The data files under a prefix (hidden files and folders are not data)."""
    if not lake.exists(spark, path):
        return []
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    return sorted(r[0] for r in found.collect())                     # a batch's files


def load_and_empty(spark: SparkSession, root: str, staging_path: str, prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows,
                   before_commit: Callable[[], None] | None = None, before_delete: Callable[[], None] | None = None, **options) -> State:
    """:func:`load_events` of a staging prefix, which is empty afterwards.

    The commit notes the files that it consumed; files that are still there after a crash are
    deleted by the next call and not loaded again, whatever their keys.
    """
    snap = Snapshots(spark, root)
    state = snap.state()
    consumed = set(state.notes.get("consumed", []))
    files = staged_files(spark, staging_path)
    fresh = [f for f in files if f not in consumed]
    if fresh:
        state = load_events(spark, root, prepare(spark.read.parquet(*fresh)), notes={"consumed": fresh},
                            before_commit=before_commit, **options)
        if before_delete:
            before_delete()
    for f in files:
        lake.remove(spark, f)
    return state


# ---- the batch log job with a ledger -------------------------------------------------------------
PROCESSED, FAILURES, QUARANTINE, LEDGER = "processed", "dq_failures", "quarantine", "ledger"


def new_files(spark: SparkSession, raw_path: str, snap: Snapshots, state: State) -> DataFrame:
    """``path, length, modified`` of the raw files that no committed run has read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(raw_path).select(
        "path", "length", F.col("modificationTime").cast("timestamp").alias("modified"))
    if LEDGER not in state.tables:
        return listed
    return listed.join(snap.table(LEDGER, state).select("path", "length", "modified"), ["path", "length", "modified"], "left_anti")


def run_log_increment(spark: SparkSession, raw_path: str, root: str, run_ts: str | None = None, run_id: str | None = None,
                      prefer_valid: bool = False, partition_cols=lake.LOG_PARTITIONS,
                      before_commit: Callable[[], None] | None = None) -> dict:
    """The batch log job over the files that arrived since its last committed run.

    A record that comes again in a later file meets the row held for its id (clean or failed): the
    latest of both is judged, and takes the place of the old one in either table. Runs over a growing
    prefix therefore equal one run over all of it. Clean rows, failures, quarantined lines and the
    ledger of files are one commit: a run that dies leaves nothing, and its files are new again.
    Returns the run's metrics; without new files nothing is written.
    """
    snap = Snapshots(spark, root)
    state = snap.state()
    run_id = run_id or str(uuid.uuid4())
    fresh = new_files(spark, raw_path, snap, state)
    files = fresh.collect()                                          # the files of one run
    if not files:
        return {"job_run_id": run_id, "files": 0}
    seen = Observation(f"raw-{run_id}")
    raw = read_raw_logs(spark, [r.path for r in files]).persist()
    counts = {"total_raw": F.count(F.lit(1)), "corrupt_records": F.count_if(F.col(S.CORRUPT_COL).isNotNull())}
    good, bad = quality.split_corrupt(raw.observe(seen, *[c.alias(n) for n, c in counts.items()]))
    try:
        bad = bad.withColumns({"quarantine_ts": F.lit(run_ts).cast("timestamp") if run_ts else F.current_timestamp(), "job_run": F.lit(run_id)})
        quarantine = snap.write(QUARANTINE, bad, ["job_run"])        # reads all of raw: its counts are complete after it
        columns = good.columns
        ids = good.select("event_id").where("event_id IS NOT NULL").distinct()
        all_rows = good
        for table in (PROCESSED, FAILURES):
            if state.folders(table):
                all_rows = all_rows.unionByName(snap.table(table, state).join(ids, "event_id", "left_semi").select(*columns))
        flagged = quality.with_dq_flags(all_rows)
        no_id = quality.fail_missing_key(flagged.filter(F.col("event_id").isNull()), "event_id")
        others = sorted(c for c in columns if c not in ("event_id", "event_timestamp"))
        order = (["dq_pass_strict"] if prefer_valid else []) + ["event_timestamp"] + others
        latest = dedup.keep_latest(flagged.filter(F.col("event_id").isNotNull()), "event_id", order).unionByName(no_id)
        enriched = enrich.enrich_logs(latest, run_ts).persist()
        try:
            clean, failed = quality.route(enriched)
            clean = clean.drop(*[c for c in quality.DQ_HELPER_COLUMNS if c in clean.columns])
            n_clean, n_failed = Observation(f"clean-{run_id}"), Observation(f"failed-{run_id}")
            changes = {
                PROCESSED: replace_rows(snap, state, PROCESSED, clean, list(partition_cols), ids,
                                        finish=lambda x: x.observe(n_clean, F.count(F.lit(1)).alias("written"))),
                FAILURES: replace_rows(snap, state, FAILURES, failed, list(lake.DQ_PARTITIONS), ids,
                                       finish=lambda x: x.observe(n_failed, F.count(F.lit(1)).alias("failed")))}
        finally:
            enriched.unpersist()
    finally:
        raw.unpersist()
    ledger = spark.createDataFrame([(r.path, r.length, r.modified, run_id) for r in files],
                                   "path string, length long, modified timestamp, job_run string")
    changes[QUARANTINE] = Change(bad.schema, ["job_run"], [], quarantine)
    changes[LEDGER] = Change(ledger.schema, ["job_run"], [], snap.write(LEDGER, ledger, ["job_run"]))
    if before_commit:
        before_commit()
    done = snap.commit(state, changes, {"job_run": run_id})
    return {"job_run_id": run_id, "files": len(files), "version": done.number, **seen.get,
            "rows_in_rewritten_folders": n_clean.get["written"] + n_failed.get["failed"]}
