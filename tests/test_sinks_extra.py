"""Dead-letter sink, bucketed tables, JSON field access and the bounded streaming run."""
import json
import os
import time

from pyspark.sql import functions as F

from sensorwerk import schemas as S
from sensorwerk.functions.columns import json_field
from sensorwerk.sinks import lake
from sensorwerk.sources import standins as T
from sensorwerk.streaming import iot, landing
from tests.conftest import SF_SMALL
from tests.test_plans import plan_text


def test_dead_letter_sink(spark, scratch):
    src = os.path.join(scratch, "kafka")
    os.makedirs(src)
    recs = [{"key": "k", "value": json.dumps({"device_id": "D", "timestamp_ms": 1, "event_name": "T"}),
             "topic": S.KAFKA_TOPICS[0], "partition": 1, "offset": 0, "timestamp": "2024-01-08T00:00:00Z"},
            {"key": "k", "value": "{not json", "topic": S.KAFKA_TOPICS[1], "partition": 2, "offset": 7,
             "timestamp": "2024-01-08T00:00:00Z"}]
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write("\n".join(json.dumps(r) for r in recs) + "\n")
    stream = spark.readStream.schema(S.KAFKA_SCHEMA).json(src)
    _, dead = landing.split_dead_letters(landing.parse_values(stream))
    out = os.path.join(scratch, "dlq")
    landing.start_dead_letters(dead, out, os.path.join(scratch, "ckpt"), trigger={"availableNow": True}).awaitTermination()
    rows = spark.read.json(out).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.source_topic, r.partition, r.offset, r.error, r.dlq_topic) == (
        S.KAFKA_TOPICS[1], 2, 7, "JSON_PARSE_ERROR", S.DEAD_LETTER_TOPIC)


def test_bucketed_tables_join_without_shuffle(spark):
    fact = T.fact_iot_events(spark, SF_SMALL)
    dev = T.dim_device(spark, SF_SMALL)
    lake.save_bucketed(fact, "bucketed_fact_t", ["device_sk"], 8, sort_cols=["device_sk"])
    lake.save_bucketed(dev, "bucketed_dev_t", ["device_sk"], 8, sort_cols=["device_sk"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("bucketed_fact_t").join(spark.table("bucketed_dev_t"), "device_sk")
        text = plan_text(j)
        assert "SortMergeJoin" in text and "Exchange" not in text.split("== Physical Plan ==")[1].split("\n\n")[0]
        assert j.count() == fact.join(dev, "device_sk", "left_semi").count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE bucketed_fact_t")
        spark.sql("DROP TABLE bucketed_dev_t")


def test_json_field(spark):
    logs = T.log_raw(spark, SF_SMALL)
    k = logs.select(json_field("metadata", "$.k", "int").alias("k"))
    assert k.filter(F.col("k").isNull()).count() == 0
    assert k.agg(F.min("k"), F.max("k")).collect()[0] == (0, 99)


def test_bounded_run_stops(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write(json.dumps({"device_id": "DEVICE-00001", "plant_id": "PLANT-01", "timestamp_ms": 1704067200000,
                            "event_name": "TEMPERATURE", "value_numeric": 1.0, "event_id": "E1"}) + "\n")
    stream = iot.iot_pipeline(iot.read_iot_stream(spark, src), T.device_registry(spark, SF_SMALL))
    q = iot.start_iot_sink(stream, os.path.join(scratch, "out"), os.path.join(scratch, "ckpt"),
                           trigger={"processingTime": "1 second"})
    t0 = time.time()
    iot.run_bounded(q, minutes=0.1)
    assert not q.isActive and time.time() - t0 < 60
    assert spark.read.parquet(os.path.join(scratch, "out")).count() == 1
