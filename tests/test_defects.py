"""Remaining reference defects decided in the library."""
from pyspark.sql import functions as F

from sensorwerk import schemas as S
from sensorwerk.operators import enrich
from sensorwerk.sources import standins as T
from sensorwerk.streaming import iot
from tests.conftest import SF_SMALL


def test_schema_constant_not_mutated():
    """D2: adding the corrupt column builds a new schema."""
    before = len(S.LOG_SCHEMA.fields)
    extended = S.with_corrupt_column(S.LOG_SCHEMA)
    assert len(S.LOG_SCHEMA.fields) == before and len(extended.fields) == before + 1


def test_missing_event_ids_are_derived(spark):
    """D16: producer ids are kept; missing ones become a content hash, equal for equal content."""
    df = spark.createDataFrame(
        [("E1", "D1", 1, "T", 1.0), (None, "D1", 2, "T", 1.0), (None, "D1", 2, "T", 1.0), (None, "D2", 2, "T", 1.0)],
        "event_id string, device_id string, timestamp_ms long, event_name string, value_numeric double")
    ids = [r.event_id for r in iot.ensure_event_id(df).collect()]
    assert ids[0] == "E1"
    assert ids[1] == ids[2] and ids[1] != ids[3] and ids[1].startswith("H-")


def test_sigma_with_baseline_table(spark):
    """PRJ-7 stream form: a baseline table instead of statistics over the input itself."""
    events = T.iot_raw(spark, SF_SMALL)
    baseline = (events.groupBy("device_id", "event_name")
                .agg(F.avg("value_numeric").alias("mean_value"), F.stddev("value_numeric").alias("stddev_value")))
    a = enrich.sigma_anomalies(events, stats=baseline).select("event_id", "sigma_anomaly")
    b = enrich.sigma_anomalies(events).select("event_id", "sigma_anomaly")
    assert a.exceptAll(b).count() == 0 and a.count() == events.count()
    spread = baseline.filter(F.col("stddev_value") > 0).select("device_id", "event_name").limit(1)
    probe = events.join(spread, ["device_id", "event_name"]).limit(1).withColumn("value_numeric", F.lit(1e9))
    assert enrich.sigma_anomalies(probe, stats=baseline).collect()[0].sigma_anomaly is True


def test_minute_stats_equal_window_definition(spark):
    from pyspark.sql import Window

    from sensorwerk.functions.columns import bucket_start
    from sensorwerk.operators.aggregates import attach_minute_stats
    fact = T.fact_iot_events(spark, SF_SMALL)
    got = attach_minute_stats(fact).select("event_id", "avg_value_1min", "stddev_value_1min")
    w = Window.partitionBy("device_sk", "event_name", bucket_start("event_ts", "MINUTE"))
    want = fact.select("event_id", F.avg("value_numeric").over(w).alias("avg_value_1min"),
                       F.stddev("value_numeric").over(w).alias("stddev_value_1min"))
    assert got.count() == fact.count()
    assert got.exceptAll(want).count() == 0
