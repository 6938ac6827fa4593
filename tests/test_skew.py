"""A device holding a third of all rows: the join operators stay whole and AQE splits the
hot partition (thresholds scaled down to test size)."""
import contextlib
import io

import pytest
from pyspark.sql import functions as F

from sensorwerk.operators import dims, enrich
from sensorwerk.sources import standins as T
from tests.conftest import SF_MID

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _hot_events(spark):
    ev = T.iot_raw(spark, SF_MID)
    return ev.withColumn("device_id", F.when(F.abs(F.hash("event_id")) % 3 == 0, F.lit("DEVICE-00007"))
                         .otherwise(F.col("device_id")))


def _final_plan(df) -> str:
    df.collect()   # runs this DataFrame's own query execution, so explain shows its final plan
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_asof_join_splits_hot_device(spark, skew_conf):
    events = _hot_events(spark)
    versions = T.dim_device_scd2(spark, SF_MID)
    out = dims.asof_join(events, versions)
    plan = _final_plan(out)
    assert "isFinalPlan=true" in plan and "skew=true" in plan, plan
    assert out.count() == events.count()
    unknown = events.join(versions, "device_id", "left_anti").count()          # devices the dimension does not know
    assert out.filter(F.col("valid_from").isNull()).count() == unknown


def test_sigma_join_back_is_whole_under_skew(spark, skew_conf):
    events = _hot_events(spark)
    out = enrich.sigma_anomalies(events)
    assert out.count() == events.count()
    hot = out.filter(F.col("device_id") == "DEVICE-00007").select("baseline_readings").distinct().collect()
    assert len(hot) == events.filter(F.col("device_id") == "DEVICE-00007").select("event_name").distinct().count()
