"""Warehouse loads: upsert properties, partition-scoped upsert on disk, incremental
refresh of the hourly roll-up equal to a full rebuild, and the decorrelated subquery."""
import os

from pyspark.sql import functions as F

from sensorwerk.functions.columns import day_start, ntz
from sensorwerk.operators import warehouse
from sensorwerk.plans import jobs
from sensorwerk.sources import standins as T
from tests.conftest import SF_SMALL


def _key(row):
    return tuple((x is None, x if x is not None else 0) for x in row)


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=_key)


def _fact(spark):
    return T.fact_iot_events(spark, SF_SMALL)


def test_upsert_idempotent(spark):
    fact = _fact(spark).select("event_id", "event_ts", "value_numeric")
    target = fact.filter(F.col("event_ts") < ntz("2024-01-20"))
    staging = fact.filter(F.col("event_ts") >= ntz("2024-01-15")).withColumn("value_numeric", F.lit(1.0))
    once = warehouse.upsert(target, staging)
    twice = warehouse.upsert(once, staging)
    assert _sorted(once) == _sorted(twice)
    assert once.count() == fact.count()


def test_upsert_duplicates_and_null_keys(spark):
    target = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "event_id string, v int")
    staging = spark.createDataFrame([("a", 10), ("a", 11), (None, 12)], "event_id string, v int")
    out = _sorted(warehouse.upsert(target, staging))
    assert out == sorted([(None, 2), ("b", 3), ("a", 10), ("a", 11), (None, 12)], key=_key)
    dedup = warehouse.upsert(target, staging.withColumn("event_ts", F.col("v")), dedup_staging=True)
    assert dedup.filter(F.col("event_id") == "a").collect()[0].v == 11


def test_incremental_rows_empty_target(spark):
    fact = _fact(spark).select("event_id", "event_ts")
    empty = fact.limit(0)
    assert warehouse.incremental_rows(empty, fact).count() == fact.count()


def test_partition_scoped_upsert_and_hourly_refresh(spark, scratch):
    plants = T.dim_plant(spark, SF_SMALL)
    fact = _fact(spark).withColumn("event_date", day_start("event_ts"))
    initial = fact.filter(F.col("event_ts") < ntz("2024-01-20"))
    fpath, h_inc, h_full = (os.path.join(scratch, n) for n in ("fact", "hourly_inc", "hourly_full"))
    initial.write.partitionBy("event_date").parquet(fpath)
    jobs.refresh_hourly(spark, fpath, plants, h_inc)

    staging = (fact.filter(F.col("event_ts") >= ntz("2024-01-15"))
               .withColumn("value_numeric", F.col("value_numeric") + 1).drop("event_date"))
    touched = jobs.load_fact_batch(spark, fpath, staging)
    expected = warehouse.upsert(initial.drop("event_date"), staging)
    assert _sorted(spark.read.parquet(fpath).drop("event_date")) == _sorted(expected.select(*initial.drop("event_date").columns))

    jobs.refresh_hourly(spark, fpath, plants, h_inc, touched=touched)
    jobs.refresh_hourly(spark, fpath, plants, h_full)
    cols = ["event_hour", "plant_id", "total_events", "alarm_count", "high_anomaly_count", "low_quality_events"]
    inc, full = spark.read.parquet(h_inc), spark.read.parquet(h_full)
    assert _sorted(inc.select(*cols)) == _sorted(full.select(*cols))
    diff = inc.alias("a").join(full.alias("b"), ["event_hour", "plant_id"]).filter(
        F.abs(F.coalesce(F.col("a.avg_sensor_value"), F.lit(0.0)) - F.coalesce(F.col("b.avg_sensor_value"), F.lit(0.0))) > 1e-9)
    assert diff.count() == 0


def test_correlated_subquery_equals_conditional_aggregate(spark):
    """The slow report's alarm-rate subquery, decorrelated by Spark, equals the single
    conditional aggregate used by the library (J-6)."""
    _fact(spark).createOrReplaceTempView("fact_j6")
    corr = spark.sql("""
        SELECT w.plant_sk, w.wk,
          (SELECT count_if(e2.threshold_breach) * 100.0 / nullif(count(*), 0) FROM fact_j6 e2
            WHERE e2.plant_sk = w.plant_sk AND date_trunc('week', e2.event_ts) = w.wk) AS rate
        FROM (SELECT DISTINCT plant_sk, date_trunc('week', event_ts) AS wk FROM fact_j6) w""")
    direct = spark.sql("""
        SELECT plant_sk, date_trunc('week', event_ts) AS wk, count_if(threshold_breach) * 100.0 / nullif(count(*), 0) AS rate
        FROM fact_j6 GROUP BY 1, 2""")
    assert _sorted(corr) == _sorted(direct)


def test_weekly_report_from_materialized_hourly_table(spark, scratch):
    """Report over the refreshed hourly table (devices from its sketches, partitions pruned
    by day) equals the report computed from the fact."""
    import contextlib
    import io

    from sensorwerk.plans import reports
    plants = T.dim_plant(spark, SF_SMALL)
    fact = _fact(spark).withColumn("event_date", day_start("event_ts"))
    fpath, hpath = os.path.join(scratch, "fact"), os.path.join(scratch, "hourly")
    fact.write.partitionBy("event_date").parquet(fpath)
    jobs.refresh_hourly(spark, fpath, plants, hpath)
    hourly = spark.read.parquet(hpath)
    from_mv = reports.weekly_report_after(None, plants, "2024-01-31", hourly=hourly, devices="sketch")
    from_fact = reports.weekly_report_after(_fact(spark), plants, "2024-01-31", devices="fact_exact")
    cols = from_fact.columns
    assert _sorted(from_mv.select(*cols)) == _sorted(from_fact.select(*cols))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        from_mv.explain("formatted")
    assert "PartitionFilters: [isnotnull(event_date" in buf.getvalue()


def test_warehouse_cycle_idempotent_and_equal_to_direct_report(spark, scratch):
    from sensorwerk.plans import reports
    plants = T.dim_plant(spark, SF_SMALL)
    fact = _fact(spark).withColumn("event_date", day_start("event_ts"))
    fpath, hpath, rpath, spath = (os.path.join(scratch, n) for n in ("fact", "hourly", "report", "staging"))
    initial = fact.filter(F.col("event_ts") < ntz("2024-01-20"))
    initial.write.partitionBy("event_date").parquet(fpath)
    jobs.refresh_hourly(spark, fpath, plants, hpath)
    staging = fact.filter(F.col("event_ts") >= ntz("2024-01-15")).drop("event_date")
    staging.write.parquet(spath)
    first = _sorted(jobs.run_warehouse_cycle(spark, spath, fpath, hpath, plants, rpath, "2024-01-31"))
    second = _sorted(jobs.run_warehouse_cycle(spark, spath, fpath, hpath, plants, rpath, "2024-01-31", catalog_table="cycle_fact"))
    assert first == second
    stats = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED cycle_fact").collect()}
    assert f"{spark.read.parquet(fpath).count()} rows" in stats["Statistics"]
    assert any(r.info_name == "distinct_count" and r.info_value != "NULL" for r in spark.sql("DESCRIBE EXTENDED cycle_fact device_sk").collect())
    spark.sql("DROP TABLE cycle_fact")
    direct = reports.weekly_report_after(_fact(spark), plants, "2024-01-31", devices="fact_exact")
    assert first == _sorted(direct)


def test_upsert_moves_and_undated_rows(spark, scratch):
    from sensorwerk.operators import warehouse

    path = os.path.join(scratch, "fact")
    schema = "event_id string, v int, event_date date"
    day = lambda d: __import__("datetime").date(2024, 1, d)
    rows = [("k1", 1, day(1)), ("k2", 2, day(1)), ("k3", 3, day(3)), ("n1", 4, None), ("n2", 5, None), (None, 6, day(1))]
    spark.createDataFrame(rows, schema).write.partitionBy("event_date").parquet(path)
    sent = [("k1", 10, day(2)), ("k3", 30, day(2)), ("n9", 50, None), ("n2", 51, day(1))]
    for _ in range(2):                                     # replaying the batch changes nothing
        warehouse.write_upsert(spark, path, spark.createDataFrame(sent, schema))
        got = {(r.event_id, r.v, r.event_date) for r in spark.read.schema(schema).parquet(path).collect()}
        assert got == {("k2", 2, day(1)), (None, 6, day(1)), ("n1", 4, None), *sent}
    assert not os.path.exists(os.path.join(path, "event_date=2024-01-03"))           # its last row moved away


def test_cycle_from_the_lake_and_emptied_days(spark, scratch):
    from sensorwerk.functions.columns import ts_to_epoch_ms
    from sensorwerk.operators import enrich, warehouse

    plants, devices = T.dim_plant(spark, SF_SMALL), T.dim_device(spark, SF_SMALL)
    lake_rows = enrich.detect_anomalies(T.iot_raw(spark, SF_SMALL)).withColumns({
        "timestamp_ms": ts_to_epoch_ms("event_ts"), "value_string": F.lit(None).cast("string"),
        "processed_at": F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")}).drop("event_ts")
    fpath, hpath, rpath, spath, s2 = (os.path.join(scratch, n) for n in ("fact", "hourly", "report", "staging", "late"))
    first = warehouse.fact_events(lake_rows, devices, plants).withColumn("event_date", day_start("event_ts"))
    first.filter(F.col("event_ts") < ntz("2024-01-20")).write.partitionBy("event_date").parquet(fpath)
    jobs.refresh_hourly(spark, fpath, plants, hpath)
    lake_rows.write.parquet(spath)
    report = jobs.run_warehouse_cycle(spark, spath, fpath, hpath, plants, rpath, "2024-01-31", devices=devices)
    assert report.count() > 0
    fact = spark.read.parquet(fpath)
    assert fact.count() == lake_rows.count() and fact.filter("device_sk = -1").count() > 0
    # all events of one day are sent again a day later: the day's hours go
    moved = first.filter(F.col("event_ts") >= ntz("2024-01-25")).filter(F.col("event_ts") < ntz("2024-01-26")).select("event_id")
    lake_rows.join(moved, "event_id").withColumn("timestamp_ms", F.col("timestamp_ms") + 86_400_000).write.parquet(s2)
    jobs.run_warehouse_cycle(spark, s2, fpath, hpath, plants, rpath, "2024-01-31", devices=devices)
    assert spark.read.parquet(hpath).filter("event_date = DATE'2024-01-25'").count() == 0
