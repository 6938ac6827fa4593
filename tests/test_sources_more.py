"""Catalog discovery, model graph, ordered loads, statistics for the planner, as-of carry, sink pruning, window replays."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from sensorwerk.operators import dims
from sensorwerk.plans import loads
from sensorwerk.plans.catalog import Catalog
from sensorwerk.sinks import lake
from sensorwerk.sinks.snapshot import Snapshots
from sensorwerk.sources import standins as T
from sensorwerk.sources.raw import sync_lake_table
from sensorwerk.streaming import iot, windows
from tests.conftest import SF_SMALL
from tests.test_plans import plan_text


# ---- discovery ------------------------------------------------------------------------------------
def test_discovery_adds_partitions_and_columns_and_skips_junk(spark, scratch):
    path = f"{scratch}/lake"
    day = lambda n, **more: spark.range(n).select(F.col("id"), *[F.lit(v).alias(k) for k, v in more.items()])
    day(3).write.parquet(f"{path}/day=2024-01-01")
    day(5).write.parquet(f"{path}/_temporary/0/day=2024-01-09")
    spark.range(9).write.parquet(f"{path}/_spark_staging/x")
    assert sync_lake_table(spark, "disc_t", path, ["day"], {"day": "date"}) == {"added": 1, "dropped": 0, "columns": []}
    assert spark.table("disc_t").count() == 3
    day(4, unit="C").write.parquet(f"{path}/day=2024-01-02")
    assert sync_lake_table(spark, "disc_t", path, ["day"]) == {"added": 1, "dropped": 0, "columns": ["unit"]}
    got = sorted((str(r.day), r.unit) for r in spark.table("disc_t").collect())
    assert got == [("2024-01-01", None)] * 3 + [("2024-01-02", "C")] * 4
    assert sync_lake_table(spark, "disc_t", path, ["day"]) == {"added": 0, "dropped": 0, "columns": []}
    day(2, unit=7).write.parquet(f"{path}/day=2024-01-03")
    with pytest.raises(ValueError, match="unit"):
        sync_lake_table(spark, "disc_t", path, ["day"])
    assert spark.table("disc_t").count() == 7
    lake.remove(spark, f"{path}/day=2024-01-03")
    lake.remove(spark, f"{path}/day=2024-01-01")
    assert sync_lake_table(spark, "disc_t", path, ["day"])["dropped"] == 1
    assert spark.table("disc_t").count() == 4
    spark.range(1).write.parquet(f"{path}/stray")
    with pytest.raises(ValueError, match="stray"):
        sync_lake_table(spark, "disc_t", path, ["day"])
    spark.sql("DROP TABLE disc_t")


def test_discovery_of_null_and_odd_values(spark, scratch):
    path = f"{scratch}/lake"
    spark.createDataFrame([(1, "a b"), (2, None), (3, "it's"), (4, "x=y")], "n int, part string").write.partitionBy("part").parquet(path)
    assert sync_lake_table(spark, "disc_odd", path, ["part"])["added"] == 4
    assert sorted((r.n, r.part) for r in spark.table("disc_odd").collect()) == [(1, "a b"), (2, None), (3, "it's"), (4, "x=y")]
    assert sync_lake_table(spark, "disc_odd", path, ["part"])["added"] == 0
    spark.sql("DROP TABLE disc_odd")


# ---- models ---------------------------------------------------------------------------------------
def test_models_are_built_in_order_and_only_when_stale(spark, scratch):
    path, built = f"{scratch}/src", []
    spark.range(5).write.parquet(path)

    def catalog(version="1"):
        cat = Catalog(spark)
        cat.add_source("numbers", lambda s: s.read.parquet(path))
        cat.add_model("m_total", lambda c: built.append("m_total") or c.ref("m_stage").agg(F.sum("id").alias("s")), "table", refs=("m_stage",))
        cat.add_model("m_stage", lambda c: built.append("m_stage") or c.source("numbers").where("id > 0"), "table", version, sources=("numbers",))
        cat.add_model("m_other", lambda c: built.append("m_other") or c.source("numbers"), "view", sources=("numbers",))
        return cat

    assert catalog().run(["m_total"]) == ["m_stage", "m_total"] == built
    assert catalog().ref("m_total").first().s == 10 and built == ["m_stage", "m_total"]            # fresh: read, not built
    spark.range(100, 101).write.mode("append").parquet(path)
    assert catalog().ref("m_total").first().s == 110 and built[2:] == ["m_stage", "m_total"]       # its source changed
    assert catalog("2").run() == ["m_stage", "m_total", "m_other"] or built[-1] in ("m_total", "m_other")
    loop = Catalog(spark)
    loop.add_model("a", lambda c: None, refs=("b",))
    loop.add_model("b", lambda c: None, refs=("a",))
    with pytest.raises(ValueError, match="a -> b -> a"):
        loop.run()
    spark.range(1).write.saveAsTable("m_foreign")
    cat = catalog()
    cat.add_model("m_foreign", lambda c: c.source("numbers"), "table", sources=("numbers",))
    with pytest.raises(ValueError, match="not made by a model"):
        cat.ref("m_foreign")
    for t in ("m_total", "m_stage", "m_foreign"):
        spark.sql(f"DROP TABLE {t}")


# ---- order and statistics ---------------------------------------------------------------------------
def test_loaded_files_hold_disjoint_time_ranges(spark, scratch, monkeypatch):
    import pyarrow.parquet as pq

    monkeypatch.setattr(lake, "FILE_BYTES", 4_000)
    rows = T.fact_iot_events(spark, SF_SMALL, plant=False).select("event_id", "device_sk", "event_name", "value_numeric", "event_ts")
    root = f"{scratch}/w"
    loads.load_events(spark, root, rows.withColumn("event_ts", F.expr("event_ts - make_dt_interval(day(event_ts) - 1)")))   # one day
    snap = Snapshots(spark, root)
    files = [os.path.join(d, f) for folder in snap.state().folders("fact") for d, _, names in os.walk(f"{root}/fact/{folder}")
             for f in names if f.endswith(".parquet")]
    spans = []
    for f in files:
        meta = pq.ParquetFile(f).metadata
        at = [i for i in range(meta.num_columns) if meta.schema.column(i).name == "event_ts"][0]
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        spans.append((min(s.min for s in stats), max(s.max for s in stats)))
    assert len(spans) >= 4 and all(a[1] <= b[0] for a, b in zip(sorted(spans), sorted(spans)[1:]))
    text = plan_text(snap.table("fact").where("event_ts < timestamp_ntz'2024-01-01 03:00:00'"))
    assert "LessThan(event_ts" in text


def test_rows_that_compress_well_are_sorted_by_many_tasks(spark, scratch, monkeypatch):
    """Tasks follow the bytes of the rows, in the first load and in one that rewrites folders: the files' bytes are a fraction."""
    monkeypatch.setattr(lake, "FILE_BYTES", 100_000)
    rows = spark.range(8_000).select(
        F.format_string("event-%060d", "id").alias("event_id"), (F.col("id") % 3).alias("device_sk"), F.lit("T").alias("event_name"),
        F.lit(1.0).alias("value_numeric"), F.timestamp_add("SECOND", F.col("id").cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("event_ts"))
    asked, write = [], lake.write_clustered
    monkeypatch.setattr(lake, "write_clustered", lambda df, *a, **k: (asked.append(-(-k["size"] // lake.FILE_BYTES)), write(df, *a, **k))[1])
    loads.load_events(spark, f"{scratch}/w", rows)
    loads.load_events(spark, f"{scratch}/w", rows.limit(4_000).withColumn("value_numeric", F.lit(2.0)))
    assert asked[0] >= 8 and asked[1] >= asked[0]
    back = Snapshots(spark, f"{scratch}/w").table("fact")
    assert back.count() == back.select("event_id").distinct().count() == 8_000 and back.where("value_numeric = 2").count() == 4_000


def test_bytes_of_rows_count_texts_nulls_and_nested_values(spark):
    rows = spark.createDataFrame([(1, "ab", [1, 2]), (2, None, None), (None, "ü", [])], "n int, t string, a array<int>")
    assert lake.rows_bytes(rows) == 3 * 24 + (2 + 6) + (2 + 2)
    assert lake.rows_bytes(rows.limit(0)) == 0


def test_statistics_change_the_join(spark, scratch):
    path = f"{scratch}/lake"
    wide = spark.range(20_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 512).alias("text"), F.lit("x").alias("part"))
    lake.write_partitioned(wide, path, ["part"])
    sync_lake_table(spark, "stat_t", path, ["part"])
    other = spark.range(200_000).select((F.col("id") % 20_000).alias("k"), F.rand(1).alias("v"))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.cbo.enabled", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "40000")
        spark.conf.set("spark.sql.cbo.enabled", "true")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        join = lambda: other.join(spark.table("stat_t").where("k < 40").select("k", "text"), "k")
        assert "SortMergeJoin" in plan_text(join())
        lake.analyze_table(spark, "stat_t", ["k", "text", "part"])
        assert "BroadcastHashJoin" in plan_text(join())
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
        spark.sql("DROP TABLE stat_t")


# ---- as-of ------------------------------------------------------------------------------------------
def test_asof_carry_equals_the_range_join(spark):
    from sensorwerk.functions.columns import ntz

    events = T.iot_raw(spark, SF_SMALL, plant=False).unionByName(
        T.iot_raw(spark, SF_SMALL, plant=False).limit(7).withColumn("device_id", F.lit(None).cast("string"))).unionByName(
        T.iot_raw(spark, SF_SMALL, plant=False).limit(9).withColumn("event_ts", F.lit(None).cast("timestamp_ntz")))
    versions = T.dim_device_scd2(spark, SF_SMALL)
    versions = versions.where("device_sk % 3 <> 0 OR valid_to IS NULL").withColumn(         # gaps, and starts within a day
        "valid_from", F.when(F.col("device_sk") % 4 == 0, ntz("2024-01-15 13:30:00")).otherwise(F.col("valid_from")))
    versions = versions.where("valid_to IS NULL OR valid_from < valid_to").select("device_id", "criticality", "sla_minutes", "valid_from", "valid_to")
    cols = ["event_id", "device_id", "event_ts", "criticality", "sla_minutes"]
    want = dims.asof_join(events, versions).select(*cols)
    for bucket in ("DAY", "HOUR"):
        got = dims.asof_carry(events, versions, bucket=bucket).select(*cols)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_asof_of_a_device_with_very_many_versions(spark):
    n = 100_000
    start = dt.datetime(2024, 1, 1)
    versions = spark.range(n).select(F.lit("d").alias("device_id"), F.col("id").alias("v"),
                                     F.expr("timestampadd(SECOND, cast(id AS int), timestamp_ntz'2024-01-01 00:00:00')").alias("valid_from"),
                                     F.expr("timestampadd(SECOND, cast(id AS int) + 1, timestamp_ntz'2024-01-01 00:00:00')").alias("valid_to"))
    events = spark.range(20_000).select(F.lit("d").alias("device_id"), F.col("id"), F.expr(
        "timestampadd(MILLISECOND, id * 5000 + 500, timestamp_ntz'2024-01-01 00:00:00')").alias("event_ts"))
    got = dims.asof_carry(events, versions)
    assert "SortMergeJoin" not in plan_text(got) and "HashJoin" not in plan_text(got)
    rows = got.agg(F.count("v"), F.count_if(F.col("v") == F.col("id") * 5), F.min("event_ts")).first()
    assert tuple(rows) == (20_000, 20_000, start + dt.timedelta(milliseconds=500))


# ---- stream sinks -------------------------------------------------------------------------------------
def test_a_batch_reads_only_the_hours_it_brings(spark, scratch):
    out = f"{scratch}/out"
    rows = spark.range(24 * 30).select(
        F.concat(F.lit("e"), "id").alias("event_id"), F.lit("2024").alias("year"), F.lit("01").alias("month"),
        F.lpad((F.col("id") / 24 + 1).cast("int").cast("string"), 2, "0").alias("day"), F.lpad((F.col("id") % 24).cast("string"), 2, "0").alias("hour"),
        F.lit("P1").alias("plant_id"), F.lit(False).alias("threshold_breach"))
    write = iot.idempotent_batch_writer(out)
    write(rows, 0)
    new = rows.where("day = '07' AND hour = '05'").unionByName(rows.where("day = '07' AND hour = '05'").withColumn("event_id", F.lit("new")))
    write(new, 1)
    assert spark.read.parquet(out).count() == 24 * 30 + 1
    batch = new.withColumn("batch_id", F.lit(2).cast("long"))
    held = iot.landed_before(batch, 2, out, iot.TIME_PARTITIONS)
    assert held.select("event_id").distinct().count() == 2                            # of 720 rows in 720 folders
    text = plan_text(held.select("event_id"))
    assert "PartitionFilters" in text and "concat_ws" in text[text.index("PartitionFilters"):]


def test_keys_held_by_the_sink_are_no_hash_table_in_a_task(spark, scratch):
    rows = spark.range(3000).select(F.concat(F.lit("e"), "id").alias("event_id"), F.lit("2024").alias("year"), F.lit("01").alias("month"),
                                    F.lit("07").alias("day"), F.lit("P1").alias("plant_id"), F.lit(False).alias("threshold_breach"))
    write = iot.idempotent_batch_writer(f"{scratch}/out", iot.BACKFILL_PARTITIONS)
    write(rows.where("event_id < 'e2'"), 0)
    batch = rows.withColumn("batch_id", F.lit(1).cast("long"))
    left = iot.not_landed(batch.unionByName(batch), 1, f"{scratch}/out", "event_id", iot.BACKFILL_PARTITIONS)
    text = plan_text(left)
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
    assert left.count() == rows.where("event_id >= 'e2'").count() == left.select("event_id").distinct().count()


def window_rows(spark, minutes, device="d"):
    rows = [(f"e{m}", device, "p", "l", "T", "C", 1_700_000_000_000 // 60_000 * 60_000 + int(m * 60_000), float(m), 70) for m in minutes]
    return spark.createDataFrame(rows, "event_id string, device_id string, plant_id string, line_id string, event_name string, unit string, "
                                       "timestamp_ms long, value_numeric double, quality int")


def test_late_rows_are_counted_and_a_replayed_batch_replaces_itself(spark, scratch):
    path = f"{scratch}/w"
    write = windows.window_writer(path, "10 minutes")
    write(window_rows(spark, [0, 1, 30]), 0)
    late = window_rows(spark, [2, 3, 31, 3000]).unionByName(window_rows(spark, [5]).withColumn("timestamp_ms", F.lit(None).cast("long")))
    write(late, 1)
    write(late, 1)                                                                    # replay
    write(window_rows(spark, []), 2)
    seen = windows.arrivals(spark, path).first()
    assert (seen.rows_in, seen.on_time, seen.late, seen.untimed, seen.in_windows, seen.batches) == (8, 5, 2, 1, 7, 3)
    all_rows = window_rows(spark, [0, 1, 30, 2, 3, 31, 3000])
    want = sorted(tuple(r) for r in windows.window_parts(
        all_rows.withColumn("event_ts", F.timestamp_millis("timestamp_ms")), "10 minutes").select(
        "window_start", "event_count", "value_mean", "value_min", "value_max").collect())
    got = windows.read_windows(spark, path)
    assert sorted(tuple(r) for r in got.select("window_start", "event_count", "avg_value", "min_value", "max_value").collect()) == want
    assert got.where("late_count > 0").agg(F.sum("late_count")).first()[0] == 2
    assert windows.read_windows(spark, path, closed_after=5).count() == len(want) - 1
