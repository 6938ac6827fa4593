"""Streaming: file order vs event time, de-dup within the watermark, late rows, idempotent
replay of a micro-batch, new-files-only reruns, windowed stats, Kafka-shaped landing."""
import json
import os
import time

from pyspark.sql import functions as F

from sensorwerk import schemas as S
from sensorwerk.functions.columns import ts_to_epoch_ms
from sensorwerk.sources import standins as T
from sensorwerk.streaming import iot, landing
from tests.conftest import SF_SMALL


def _iot_rows(spark, lo, hi):
    df = T.iot_raw(spark, SF_SMALL).filter((F.col("event_ts") >= F.lit(lo).cast("timestamp_ntz"))
                                           & (F.col("event_ts") < F.lit(hi).cast("timestamp_ntz")))
    out = df.select("event_id", "device_id", "device_type", "plant_id", "line_id",
                    ts_to_epoch_ms("event_ts").alias("timestamp_ms"), "event_name", "value_numeric", "unit",
                    "quality", "alert_threshold")
    return [r.asDict() for r in out.orderBy("timestamp_ms").collect()]


def _write(folder, name, rows, mtime):
    p = os.path.join(folder, name)
    with open(p, "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")
    os.utime(p, (mtime, mtime))


def _registry(spark):
    return T.device_registry(spark, SF_SMALL)


def test_late_week_dropped_and_redelivery_deduped(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    w2 = _iot_rows(spark, "2024-01-08", "2024-01-15")
    w3 = _iot_rows(spark, "2024-01-15", "2024-01-22")
    w1 = _iot_rows(spark, "2024-01-01", "2024-01-08")
    now = time.time()
    _write(src, "a.json", w2, now - 300)
    _write(src, "b.json", w3 + w3[:5], now - 200)      # five re-deliveries
    _write(src, "c.json", w1, now - 100)               # a whole late week
    with open(os.path.join(src, "d.json"), "w") as f:  # malformed line -> dropped as corrupt
        f.write('{"device_id": "X", "timestamp_ms": \n')
    os.utime(os.path.join(src, "d.json"), (now - 50, now - 50))

    stream = iot.read_iot_stream(spark, src, max_files=1)
    out_path = os.path.join(scratch, "out")
    metrics = iot.BatchMetrics()
    # the default: nothing is lost for being late, no copy stays
    every = os.path.join(scratch, "every")
    iot.start_iot_sink(iot.iot_pipeline(stream, _registry(spark)), every, os.path.join(scratch, "ckpt-every"),
                       trigger={"availableNow": True}).awaitTermination()
    kept = spark.read.parquet(every)
    assert kept.count() == kept.select("event_id").distinct().count() == len(w1) + len(w2) + len(w3)
    assert kept.select("batch_id").distinct().count() >= 3
    # de-dup in the stream's own state drops what comes behind the watermark, and counts it
    q = iot.start_iot_sink(iot.iot_pipeline(stream, _registry(spark), dedup="watermark"), out_path,
                           os.path.join(scratch, "ckpt"), trigger={"availableNow": True}, metrics=metrics, dedup_key=None)
    q.awaitTermination()
    dropped = iot.dropped_rows(q)
    out = spark.read.parquet(out_path)
    assert out.count() == len(w2) + len(w3)
    assert out.select("event_id").distinct().count() == len(w2) + len(w3)
    assert dropped == len(w1)
    assert sum(m["records"] for m in metrics.rows) == len(w2) + len(w3)
    assert sum(m["alarms"] for m in metrics.rows) == out.filter("threshold_breach").count()
    assert {"year", "month", "day", "hour", "plant_id", "batch_id", "asset_name"} <= set(out.columns)
    # the malformed line is not lost: it reaches the dead-letter sink with its file
    dlq = os.path.join(scratch, "dlq")
    iot.start_dead_letter_sink(iot.read_iot_stream(spark, src), dlq, os.path.join(scratch, "ckpt-dlq"),
                               trigger={"availableNow": True}).awaitTermination()
    dead = spark.read.json(dlq).collect()
    assert len(dead) == 1 and dead[0].source_file.endswith("d.json") and dead[0].error == "JSON_PARSE_ERROR"


def test_replayed_batch_is_not_duplicated(spark, scratch):
    out_path = os.path.join(scratch, "out")
    batch = iot.iot_pipeline.__wrapped__ if hasattr(iot.iot_pipeline, "__wrapped__") else None  # noqa: F841
    rows = spark.createDataFrame(_iot_rows(spark, "2024-01-08", "2024-01-09"), schema=None)
    df = rows.withColumn("event_ts", F.timestamp_millis("timestamp_ms"))
    from sensorwerk.operators import enrich
    df = enrich.add_partition_cols(enrich.detect_anomalies(df))
    process = iot.idempotent_batch_writer(out_path)
    process(df, 7)
    process(df, 7)          # retry of the same micro-batch
    process(df.limit(0), 8)  # empty batch: skipped
    out = spark.read.parquet(out_path)
    assert out.count() == df.count()
    assert [r.batch_id for r in out.select("batch_id").distinct().collect()] == [7]


def test_only_new_files_on_rerun(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    now = time.time()
    a = _iot_rows(spark, "2024-01-08", "2024-01-09")
    b = _iot_rows(spark, "2024-01-09", "2024-01-10")
    _write(src, "a.json", a, now - 100)
    ckpt, out_path = os.path.join(scratch, "ckpt"), os.path.join(scratch, "out")
    for _ in range(2):   # second run finds nothing new
        iot.start_iot_sink(iot.iot_pipeline(iot.read_iot_stream(spark, src), _registry(spark)), out_path, ckpt,
                           trigger={"availableNow": True}).awaitTermination()
    assert spark.read.parquet(out_path).count() == len(a)
    _write(src, "b.json", b, now - 10)
    iot.start_iot_sink(iot.iot_pipeline(iot.read_iot_stream(spark, src), _registry(spark)), out_path, ckpt,
                       trigger={"availableNow": True}).awaitTermination()
    assert spark.read.parquet(out_path).count() == len(a) + len(b)


def test_windowed_stats_match_batch_twin(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    rows = _iot_rows(spark, "2024-01-08", "2024-01-15")
    _write(src, "a.json", rows, time.time() - 10)
    stream = iot.read_iot_stream(spark, src, corrupt_col=None)
    agg = iot.windowed_stats(stream, "1 hour")
    q = (agg.writeStream.format("memory").queryName("win_stats_test").outputMode("append")
         .trigger(availableNow=True).option("checkpointLocation", os.path.join(scratch, "ckpt")).start())
    q.awaitTermination()
    got = spark.table("win_stats_test")
    batch = iot.windowed_stats(spark.createDataFrame(rows, schema=None), "1 hour")
    assert got.count() > 0
    assert got.join(batch, ["window_start", "device_id", "event_name", "event_count"], "left_anti").count() == 0


def test_kafka_shaped_landing_and_dead_letters(spark, scratch):
    src = os.path.join(scratch, "kafka")
    os.makedirs(src)
    rows = _iot_rows(spark, "2024-01-08", "2024-01-09")
    recs = [{"key": r["device_id"], "value": json.dumps(r), "topic": S.KAFKA_TOPICS[0], "partition": 0,
             "offset": i, "timestamp": "2024-01-08T00:00:00Z"} for i, r in enumerate(rows)]
    recs.append({"key": "bad", "value": '{"device_id": "X", "timestamp_ms": ', "topic": S.KAFKA_TOPICS[0],
                 "partition": 0, "offset": len(rows), "timestamp": "2024-01-08T00:00:00Z"})
    _write(src, "k.json", recs, time.time() - 10)

    batch = spark.read.schema(S.KAFKA_SCHEMA).json(src)
    good, dlq = landing.split_dead_letters(landing.parse_values(batch))
    assert good.count() == len(rows) and dlq.count() == 1
    assert dlq.collect()[0].offset == len(rows)

    stream = spark.readStream.schema(S.KAFKA_SCHEMA).json(src)
    out = os.path.join(scratch, "landing")
    landing.start_landing(stream.filter(F.col("key") != "bad"), out, os.path.join(scratch, "ckpt"),
                          trigger={"availableNow": True}).awaitTermination()
    files = [os.path.join(d, f) for d, _, fs in os.walk(out) for f in fs if f.endswith(".gz")]
    assert files and all("/topic=factory-iot-events/year=2024/month=01/day=08/hour=" in f for f in files)
    back = spark.read.json(out)
    assert back.count() == len(rows)


def test_iot_job_entry_point(spark, scratch):
    from sensorwerk.plans.jobs import run_iot_job
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    rows = _iot_rows(spark, "2024-01-08", "2024-01-09")
    _write(src, "a.json", rows + [{"device_id": "broken"}], time.time() - 10)
    with open(os.path.join(src, "b.json"), "w") as f:
        f.write('{"device_id": "X", "timestamp_ms": oops}\n')
    metrics = run_iot_job(spark, src, os.path.join(scratch, "no-registry"), os.path.join(scratch, "out"),
                          os.path.join(scratch, "ckpt"), os.path.join(scratch, "dlq"), trigger={"availableNow": True})
    out = spark.read.parquet(os.path.join(scratch, "out"))
    assert out.filter(F.col("device_id") != "broken").count() == len(rows)
    assert out.filter(F.col("asset_name").isNotNull()).count() == 0      # registry absent -> empty
    assert sum(m["records"] for m in metrics.rows) == out.count()
    assert spark.read.json(os.path.join(scratch, "dlq")).count() == 1


def test_landing_has_as_many_files_as_its_rows_call_for(spark, scratch, monkeypatch):
    """The planner takes joined rows for the product of both sides: 20,000 short rows were hundreds of files."""
    from sensorwerk.plans import load_queries

    for name in ("a", "b"):
        spark.range(20_000).write.parquet(os.path.join(scratch, name))
    a, b = (spark.read.parquet(os.path.join(scratch, n)) for n in ("a", "b"))
    rows = a.join(b.withColumnRenamed("id", "k"), a.id == F.col("k"), "left").selectExpr("id AS event_id", "repeat('x', 92) AS text")
    assert load_queries.land(rows, os.path.join(scratch, "few"), "event_id") == 6
    monkeypatch.setattr(load_queries, "LANDING_BYTES", 100_000)                   # 108 bytes a row: 21 files and a bit
    assert load_queries.land(rows, os.path.join(scratch, "many"), "event_id") == 21
    for folder, n in (("few", 6), ("many", 21)):
        files = [f for f in os.listdir(os.path.join(scratch, folder)) if f.endswith(".json")]
        assert len(files) == n and spark.read.json(os.path.join(scratch, folder)).distinct().count() == 20_000
