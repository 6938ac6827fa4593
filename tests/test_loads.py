"""Loads that commit in one step: crashes, conflicts, splits of a batch, the ledger of the log job."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from sensorwerk.operators import moments
from sensorwerk.operators.aggregates import attach_minute_stats
from sensorwerk.plans import jobs, loads
from sensorwerk.sinks import lake, snapshot
from sensorwerk.sinks.snapshot import Change, Conflict, Snapshots, compact, replace_rows


class Crash(Exception):
    pass


def crash():
    raise Crash


SCHEMA = "event_id string, device_sk long, event_name string, event_ts timestamp_ntz, value_numeric double"


def events(spark, ids, value=1.0, day=0):
    rows = [(None if i is None else f"e{i}", (i or 0) % 3, "T", dt.datetime(2024, 1, 1 + day + (i or 0) % 2, 5, (i or 0) % 4, 10),
             None if i == 5 else value * (1 + (i or 0) * 0.37)) for i in ids]
    return spark.createDataFrame(rows, SCHEMA)


def content(df, *cols):
    cols = cols or [c for c in df.columns]
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(*cols).collect()), key=repr)


# ---- snapshots ----------------------------------------------------------------------------------
def test_readers_see_a_whole_state_or_the_one_before(spark, scratch):
    snap = Snapshots(spark, f"{scratch}/t")
    first = events(spark, range(20)).withColumn("event_date", F.to_date("event_ts"))
    one = snap.commit(snap.state(), {"fact": replace_rows(snap, snap.state(), "fact", first, ["event_date"])})
    before = content(snap.table("fact"))
    again = events(spark, [3, 4, 99], 7.0, day=3).withColumn("event_date", F.to_date("event_ts"))
    change = replace_rows(snap, one, "fact", again, ["event_date"])                   # written, not in force
    assert content(snap.table("fact")) == before
    two = snap.commit(one, {"fact": change})
    after = content(snap.table("fact"))
    assert len(after) == 21 and after != before and content(snap.table("fact", one)) == before
    with pytest.raises(Conflict):                                                     # a load that began at the same state
        snap.commit(one, {"fact": change})
    assert content(snap.table("fact")) == after and snap.state().number == two.number == 2


def test_a_staged_key_rewrites_only_the_folders_that_hold_it(spark, scratch):
    snap = Snapshots(spark, f"{scratch}/t")
    for day in range(5):
        rows = events(spark, [10 * day, 10 * day + 2], day=day).withColumn("event_date", F.to_date("event_ts"))
        snap.commit(snap.state(), {"fact": replace_rows(snap, snap.state(), "fact", rows, ["event_date"])})
    state = snap.state()
    moved = events(spark, [20], 5.0, day=9).withColumn("event_date", F.to_date("event_ts"))
    change = replace_rows(snap, state, "fact", moved, ["event_date"])
    assert len(change.drops) == 1 and "2024-01-03" in change.drops[0]
    new = snap.commit(state, {"fact": change})
    assert set(state.folders("fact")) - set(change.drops) < set(new.folders("fact"))
    assert len(content(snap.table("fact"))) == 10


def test_empty_null_and_odd_partition_values(spark, scratch):
    snap = Snapshots(spark, f"{scratch}/a b%c")
    rows = spark.createDataFrame([("k1", "x/y z", 1), ("k2", None, 2), ("k3", "50%", 3), (None, "", 4), (None, "ü", 5)], "event_id string, part string, n int")
    state = snap.commit(snap.state(), {"t": replace_rows(snap, snap.state(), "t", rows, ["part"])})
    assert sorted(r.n for r in snap.table("t").collect()) == [1, 2, 3, 4, 5]
    staged = spark.createDataFrame([("k1", "q", 10), ("k2", "x/y z", 20), ("k3", None, 30), (None, "ü", 40)], "event_id string, part string, n int")
    state = snap.commit(state, {"t": replace_rows(snap, state, "t", staged, ["part"])})
    assert sorted(r.n for r in snap.table("t").collect()) == [4, 5, 10, 20, 30, 40]   # NULL keys match nothing
    gone = snap.commit(state, {"t": replace_rows(snap, state, "t", staged.limit(0), ["part"], staged.select("event_id"))})
    assert sorted(r.n for r in snap.table("t").collect()) == [4, 5, 40]
    snap.commit(gone, {"t": Change(snap.table("t").schema, ["part"], gone.folders("t"), [])})
    assert snap.table("t").count() == 0 and snap.table("t").columns == ["event_id", "n", "part"] or snap.table("t").columns == rows.columns


def test_vacuum_and_compact_keep_what_is_in_force(spark, scratch):
    snap = Snapshots(spark, f"{scratch}/t")
    for i in range(4):
        rows = events(spark, [2 * i, 100 + 2 * i]).withColumn("event_date", F.to_date("event_ts"))
        snap.commit(snap.state(), {"fact": replace_rows(snap, snap.state(), "fact", rows, ["event_date"])})
    snap.write("fact", events(spark, [7]).withColumn("event_date", F.to_date("event_ts")), ["event_date"])       # a load that died
    before = content(snap.table("fact"))
    compact(snap, "fact")
    assert content(snap.table("fact")) == before
    assert len(snap.state().folders("fact")) == len({f.split("/", 1)[1] for f in snap.state().folders("fact")})
    assert snap.vacuum(keep=1) and snap.numbers() == [5]
    assert content(snap.table("fact")) == before


# ---- event batches ------------------------------------------------------------------------------
def single(spark, rows):
    return content(attach_minute_stats(rows.dropDuplicates(["event_id"])), "event_id", "value_numeric", "avg_value_1min", "stddev_value_1min")


def test_a_minute_split_over_loads_equals_one_load(spark, scratch):
    root = f"{scratch}/w"
    for part in ([0, 4, 8, 12], [1, 2, 3, 16, 20], [24, 28, 5], [40]):
        loads.load_events(spark, root, events(spark, part))
    loads.load_events(spark, root, events(spark, [4, 8], 50.0))                       # values that change minutes held
    loads.load_events(spark, root, events(spark, [12], 3.0, day=2))                   # a row leaves its minute
    want = (events(spark, [0, 16, 20, 24, 28, 40, 1, 2, 3, 5]).unionByName(events(spark, [4, 8], 50.0))
            .unionByName(events(spark, [12], 3.0, day=2)))
    snap = Snapshots(spark, root)
    assert content(snap.table("fact"), "event_id", "value_numeric", "avg_value_1min", "stddev_value_1min") == single(spark, want)
    held = snap.table("minutes")
    fresh = loads._minutes_of(want)
    assert content(held.where("value_n > 0"), "device_sk", "minute", "value_n", "value_mean", "value_min", "value_max") == \
        content(fresh.where("value_n > 0"), "device_sk", "minute", "value_n", "value_mean", "value_min", "value_max")


@pytest.mark.parametrize("seed", range(3))
def test_any_split_of_the_rows_gives_the_same_statistics(spark, seed):
    import numpy as np

    rng = np.random.default_rng(seed)
    rows = [(int(rng.integers(3)), int(rng.integers(4)), None if rng.random() < 0.1 else float(1e9 + rng.normal())) for _ in range(300)]
    df = spark.createDataFrame(rows, "k int, part int, x double")
    parts = df.groupBy("k", "part").agg(*moments.parts("x", F.col("x")))
    got = moments.merge(parts, ["k"], ["x"]).select("k", "x_n", "x_mean", moments.stddev("x").alias("s"), "x_min", "x_max")
    for r in got.collect():
        x = np.array([v for k, _, v in rows if k == r.k and v is not None])
        assert r.x_n == len(x) and r.x_min == x.min() and r.x_max == x.max()
        assert r.x_mean == pytest.approx(x.mean(), rel=1e-15) and r.s == pytest.approx(x.std(ddof=1), rel=1e-6)


def test_staging_is_emptied_and_never_loaded_twice(spark, scratch):
    root, staging = f"{scratch}/w", f"{scratch}/staging"
    events(spark, [1, 2, None]).write.parquet(staging)
    with pytest.raises(Crash):
        loads.load_and_empty(spark, root, staging, before_commit=crash)
    assert Snapshots(spark, root).state().number == 0 and loads.staged_files(spark, staging)
    with pytest.raises(Crash):                                                        # committed, not yet emptied
        loads.load_and_empty(spark, root, staging, before_delete=crash)
    assert Snapshots(spark, root).table("fact").count() == 3
    events(spark, [3, None]).write.mode("append").parquet(staging)
    loads.load_and_empty(spark, root, staging)
    assert Snapshots(spark, root).table("fact").count() == 5                          # the keyless row came once
    assert loads.staged_files(spark, staging) == []
    assert loads.load_and_empty(spark, root, staging).number == 2


def test_a_crash_between_the_two_tables_leaves_both_as_they_were(spark, scratch):
    root = f"{scratch}/w"
    loads.load_events(spark, root, events(spark, range(8)))
    snap = Snapshots(spark, root)
    before = content(snap.table("fact")), content(snap.table("minutes"))
    with pytest.raises(Crash):
        loads.load_events(spark, root, events(spark, range(4, 12), 9.0), before_commit=crash)
    assert (content(snap.table("fact")), content(snap.table("minutes"))) == before
    loads.load_events(spark, root, events(spark, range(4, 12), 9.0))
    assert snap.table("fact").count() == 12


# ---- log job ------------------------------------------------------------------------------------
def log_line(i, ts, kind="START", temp=20.0):
    return ('{"event_id": %s, "machine_id": "m", "plant_code": "P%d", "event_type": "%s", "event_timestamp": %d, "temperature_c": %s}'
            % ("null" if i is None else f'"L{i}"', (i or 0) % 2, kind, 1_700_000_000_000 + ts * 86_400_000, temp))


def put(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


BATCHES = [
    [log_line(1, 1), log_line(2, 1), log_line(3, 2, "BAD"), log_line(None, 2), "{broken", log_line(4, 2)],
    [log_line(1, 3, temp=30.0), log_line(2, 0), log_line(3, 3), log_line(4, 4, "BAD"), log_line(5, 1)],    # later, earlier, mended, spoilt
    [log_line(5, 1), log_line(6, 2, temp="9999"), '{"event_id": 7, '],
]
CLEAN = ("event_id", "event_timestamp", "temperature_c", "event_type", "day")


def state_of(spark, root):
    snap = Snapshots(spark, root)
    return (content(snap.table("processed"), *CLEAN), content(snap.table("dq_failures"), "event_id", "event_timestamp", "dq_reason"),
            content(snap.table("quarantine"), "_corrupt_record"))


def test_runs_over_a_growing_prefix_equal_one_run(spark, scratch):
    for n, lines in enumerate(BATCHES):
        put(spark, f"{scratch}/raw", lines)
        done = loads.run_log_increment(spark, f"{scratch}/raw", f"{scratch}/lake", run_ts="2024-02-01 00:00:00")
        assert done["files"] == 1 and done["total_raw"] == len(lines)
    again = loads.run_log_increment(spark, f"{scratch}/raw", f"{scratch}/lake")
    assert again["files"] == 0
    loads.run_log_increment(spark, f"{scratch}/raw", f"{scratch}/whole", run_ts="2024-02-01 00:00:00")
    got = state_of(spark, f"{scratch}/lake")
    assert got == state_of(spark, f"{scratch}/whole")
    assert [r[0] for r in got[0]] == ["L1", "L2", "L3", "L5"] and got[0][0][2] == 30.0
    assert sorted(str(r[0]) for r in got[1]) == ["L4", "L6", "None"] and len(got[2]) == 2


def test_a_log_run_that_dies_leaves_nothing_and_is_repeated(spark, scratch):
    put(spark, f"{scratch}/raw", BATCHES[0])
    loads.run_log_increment(spark, f"{scratch}/raw", f"{scratch}/lake")
    before = state_of(spark, f"{scratch}/lake")
    put(spark, f"{scratch}/raw", BATCHES[1])
    with pytest.raises(Crash):
        loads.run_log_increment(spark, f"{scratch}/raw", f"{scratch}/lake", before_commit=crash)
    assert state_of(spark, f"{scratch}/lake") == before
    assert loads.run_log_increment(spark, f"{scratch}/raw", f"{scratch}/lake")["files"] == 1
    assert len(state_of(spark, f"{scratch}/lake")[0]) == 4


def test_log_fact_loads_are_one_commit_and_resolve_later(spark, scratch):
    from sensorwerk.operators import warehouse

    root = f"{scratch}/w"
    clean = spark.createDataFrame([(f"L{i}", "M1" if i % 3 else "M9", "P1" if i % 2 else "P7", dt.datetime(2024, 1, 1 + i % 2, i), "ALARM", "INFO") for i in range(8)],
                                  "event_id string, machine_id string, plant_code string, event_ts timestamp_ntz, event_type string, severity string")
    for c, t in (("error_code", "string"), ("temperature_c", "double"), ("vibration_hz", "double"), ("pressure_bar", "double"), ("cycle_count", "long"),
                 ("operator_id", "string"), ("shift", "string"), ("processed_at", "timestamp_ntz")):
        clean = clean.withColumn(c, F.lit(None).cast(t))
    clean = clean.withColumns({"is_alarm": F.lit(True), "is_critical": F.lit(False)})
    devices = spark.createDataFrame([("M1", 11)], "device_id string, device_sk long")
    plants = spark.createDataFrame([("P1", 21)], "plant_id string, plant_sk long")
    rows = warehouse.fact_logs(clean, devices, plants)
    loads.load_logs(spark, root, rows)
    with pytest.raises(Crash):
        loads.load_logs(spark, root, rows.withColumn("resolution_minutes", F.lit(5)), before_commit=crash)
    snap = Snapshots(spark, root)
    assert snap.table("machine_logs").where("resolution_minutes IS NOT NULL").count() == 0
    loads.load_logs(spark, root, rows.where("event_id = 'L4'").withColumn("resolution_minutes", F.lit(5)))
    got = {r.event_id: (r.device_sk, r.plant_sk, r.resolution_minutes) for r in snap.table("machine_logs").collect()}
    assert len(got) == 8 and got["L4"] == (11, -1, 5) and got["L3"] == (-1, 21, None) and got["L1"] == (11, 21, None)


def test_the_roll_up_follows_the_loads_through_a_crash(spark, scratch):
    from sensorwerk.operators import aggregates as A
    from sensorwerk.sources import standins as T
    from tests.conftest import SF_SMALL

    root, plants = f"{scratch}/w", T.dim_plant(spark, SF_SMALL)
    rows = T.fact_iot_events(spark, SF_SMALL)
    cols = ("event_hour", "plant_id", "total_events", "alarm_count", "sum_quality")
    fresh = lambda: content(A.hourly_plant_kpis(Snapshots(spark, root).table("fact").where("event_ts IS NOT NULL"), plants), *cols)
    rows.where("event_sk % 3 > 0").write.parquet(f"{scratch}/staging")
    loads.run_cycle(spark, root, f"{scratch}/staging", plants, "2024-01-31", f"{scratch}/report")
    assert content(Snapshots(spark, root).table("hourly"), *cols) == fresh()
    moved = rows.where("event_ts < timestamp_ntz'2024-01-03 00:00:00'").withColumn("event_ts", F.expr("event_ts + INTERVAL 10 DAYS"))
    loads.load_events(spark, root, moved)                                             # two days empty, their rows go elsewhere
    with pytest.raises(Crash):
        loads.refresh_hourly(spark, root, plants, before_commit=crash)
    assert content(Snapshots(spark, root).table("hourly"), *cols) != fresh()
    loads.load_events(spark, root, rows.where("event_sk % 3 = 0 AND event_ts > timestamp_ntz'2024-01-20 00:00:00'"))
    before = Snapshots(spark, root).state()
    loads.refresh_hourly(spark, root, plants)                                         # the days of both loads
    assert content(Snapshots(spark, root).table("hourly"), *cols) == fresh()
    assert loads.refresh_hourly(spark, root, plants).number == before.number + 1      # nothing left to do


def test_many_staged_keys_are_no_hash_table_in_a_task(spark, scratch, monkeypatch):
    """Files tell little of their rows: keys were a broadcast by 64 MB of files, whatever their table took."""
    from tests.test_plans import plan_text

    seen, write = [], Snapshots.write
    monkeypatch.setattr(Snapshots, "write", lambda self, name, rows, *a, **k: seen.append((name, plan_text(rows))) or write(self, name, rows, *a, **k))
    rows = spark.range(30_000).select(F.concat(F.lit("EVT-"), F.col("id").cast("string")).alias("event_id"), (F.col("id") % 3).alias("device_sk"),
                                       F.lit("T").alias("event_name"), F.expr("timestamp_ntz'2024-01-01 05:00:10'").alias("event_ts"), F.lit(2.0).alias("value_numeric"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")                      # what is broadcast was asked for
    try:
        loads.load_events(spark, f"{scratch}/w", rows)
        for most, kinds in ((lake.JOINED_BYTES, "BroadcastHashJoin"), (1 << 17, "SortMergeJoin")):
            seen.clear()
            monkeypatch.setattr(lake, "JOINED_BYTES", most)
            loads.load_events(spark, f"{scratch}/w", rows.where("device_sk = 1").withColumn("value_numeric", F.lit(5.0)))
            text = next(t for name, t in seen if name == loads.FACT)
            assert next(x for x in text.splitlines() if "LeftAnti" in x).count(kinds) == 1, text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got = Snapshots(spark, f"{scratch}/w").table(loads.FACT).groupBy("device_sk").agg(F.count("*"), F.avg("value_numeric"), F.avg("avg_value_1min"))
    assert content(got) == [(0, 10_000, 2.0, 2.0), (1, 10_000, 5.0, 5.0), (2, 10_000, 2.0, 2.0)]
