"""Registry fallback and uniqueness, staging load, lake catalog, catalog models, ordering."""
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sensorwerk import schemas as S
from sensorwerk.operators import enrich
from sensorwerk.plans.catalog import Catalog
from sensorwerk.sinks import lake
from sensorwerk.sources import standins as T
from sensorwerk.sources.raw import load_registry, load_staging, register_lake_table
from tests.conftest import SF_SMALL


def test_registry_missing_path_is_empty(spark, scratch):
    reg = load_registry(spark, os.path.join(scratch, "nope"))
    assert reg.count() == 0 and reg.schema == S.REGISTRY_SCHEMA


def test_registry_other_errors_raise(spark, scratch):
    p = os.path.join(scratch, "reg.json")
    spark.range(3).write.json(p)   # not parquet
    with pytest.raises(Exception):
        load_registry(spark, p).collect()


def test_duplicate_registry_does_not_fan_out(spark):
    events = T.iot_raw(spark, SF_SMALL)
    reg = T.device_registry(spark, SF_SMALL)
    dup = reg.unionByName(reg.withColumn("asset_name", F.concat(F.col("asset_name"), F.lit("-v2"))))
    out = enrich.enrich_with_registry(events, dup)
    assert out.count() == events.count()


def test_staging_serialises_nested(spark, scratch):
    p = os.path.join(scratch, "lake")
    spark.createDataFrame([("e1", ["a", "b"])], "event_id string, tags array<string>").write.parquet(p)
    assert load_staging(spark, p, ["event_id", "tags"]).collect()[0].tags == '["a","b"]'
    with pytest.raises(ValueError, match="unit"):
        load_staging(spark, p, ["event_id", "tags", "unit"])


def test_register_lake_table(spark, scratch):
    p = os.path.join(scratch, "iot")
    df = T.iot_raw(spark, SF_SMALL).withColumn("month", F.lpad(F.month("event_ts").cast("string"), 2, "0"))
    lake.write_partitioned(df, p, ["month"], mode="overwrite")
    t = register_lake_table(spark, "lake_iot_test", p, ["month"])
    assert t.count() == df.count()
    assert dict(t.dtypes)["month"] in ("string", "int")
    spark.sql("DROP TABLE lake_iot_test")


def test_catalog_models(spark):
    cat = Catalog(spark)
    cat.add_source("events", lambda s: T.fact_iot_events(s, SF_SMALL))
    cat.add_model("stg_events_model", lambda c: c.source("events").filter(F.col("event_ts").isNotNull()))
    cat.add_model("weekly_model", lambda c: c.ref("stg_events_model").groupBy("plant_sk").count())
    cat.run(["stg_events_model", "weekly_model"])
    expected = T.fact_iot_events(spark, SF_SMALL).select("plant_sk").distinct().count()
    assert spark.table("weekly_model").count() == expected


def test_clustered_write_sorted(spark, scratch):
    p = os.path.join(scratch, "sorted")
    fact = T.fact_iot_events(spark, SF_SMALL)
    lake.write_clustered(fact, p, ["event_ts"], ["event_ts", "plant_sk", "event_name"], num_partitions=4)
    back = spark.read.parquet(p)
    per_file = back.groupBy(F.input_file_name().alias("f")).agg(F.min("event_ts").alias("lo"), F.max("event_ts").alias("hi"))
    ranges = sorted((r.lo, r.hi) for r in per_file.collect())
    for (lo1, hi1), (lo2, hi2) in zip(ranges, ranges[1:]):
        assert hi1 <= lo2   # disjoint ranges -> min/max skipping works per file


def test_analyze(spark):
    spark.range(10).withColumn("k", F.col("id") % 3).write.mode("overwrite").saveAsTable("analyze_t")
    lake.analyze_table(spark, "analyze_t", ["k"])
    spark.sql("DROP TABLE analyze_t")
