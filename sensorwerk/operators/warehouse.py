"""Warehouse loads: upsert by key (SNK-8), incremental high-water-mark load (SNK-11) and
the partition-scoped refresh of the hourly roll-up table (SNK-10).

No table format (Delta / Iceberg) is assumed: a load computes the new content of the
touched partitions, writes it to a fresh folder (which also cuts lineage), then swaps the
partitions in with a dynamic partition overwrite. The path being overwritten is never read
by the same job stage.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import StructType

from sensorwerk import schemas as S
from sensorwerk.config import bounded_broadcast, checkpoint_dir
from sensorwerk.functions.columns import epoch_ms_to_ts
from sensorwerk.operators import dims
from sensorwerk.operators.aggregates import attach_minute_stats
from sensorwerk.operators.dedup import keep_latest
from sensorwerk.sinks import lake


def upsert(target: DataFrame, staging: DataFrame, key: str = "event_id", dedup_staging: bool = False,
           order: tuple[str, ...] = ("event_ts",)) -> DataFrame:
    """Delete target rows whose key is in staging, then insert all staging rows (SNK-8).

    As in the reference, duplicate keys inside staging are all inserted and NULL keys never
    match, unless ``dedup_staging`` keeps only the latest staging row per key.
    """
    if dedup_staging:
        staging = keep_latest(staging, key, list(order))
    keys = bounded_broadcast(staging.select(key).filter(F.col(key).isNotNull()))
    kept = target.join(keys, key, "left_anti")
    return kept.unionByName(staging.select(*target.columns))


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema`` by name, cast to its types; an absent column is an error."""
    absent = [f.name for f in schema if f.name not in df.columns]
    if absent:
        raise ValueError(f"columns are missing: {', '.join(absent)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def fact_events(lake_rows: DataFrame, devices: DataFrame, plants: DataFrame) -> DataFrame:
    """Lake events (natural ids, anomaly flags, epoch ms) as rows of the event fact: surrogate keys
    (-1 for unknown members, J-7), ``date_sk``, the 1-minute statistics of the event's own device
    (A-1) and the fact's types."""
    timed = lake_rows.withColumn("event_ts", epoch_ms_to_ts("timestamp_ms"))
    keyed = attach_minute_stats(dims.lookup_keys(timed, devices, plants), key="device_id")
    return conform(keyed.withColumns({
        "event_sk": F.xxhash64("event_id"), "year": F.year("event_ts"), "month": F.month("event_ts")}), S.FACT_IOT_SCHEMA)


def fact_logs(clean: DataFrame, devices: DataFrame, plants: DataFrame) -> DataFrame:
    """Clean log records of the lake as rows of the machine log fact: surrogate keys of machine and plant (-1
    for unknown members, J-7), ``date_sk`` and the fact's types. A lake without ``resolution_minutes``
    gives NULL (not resolved yet); it may also come with a later load of the same event."""
    keyed = dims.lookup_keys(clean, devices, plants, device_col="machine_id", plant_col="plant_code")
    extra = {"log_sk": F.xxhash64("event_id"), "year": F.year("event_ts"), "month": F.month("event_ts")}
    if "resolution_minutes" not in clean.columns:
        extra["resolution_minutes"] = F.lit(None).cast("int")
    return conform(keyed.withColumns(extra), S.FACT_LOG_SCHEMA)


def incremental_rows(target: DataFrame, source: DataFrame, ts: str = "event_ts",
                     floor: str = "0001-01-01 00:00:00") -> DataFrame:
    """Source rows strictly newer than the target's high-water mark (SNK-11). The mark is a
    scalar subquery, planned once, never collected by the caller."""
    hwm = target.select(F.max(ts)).scalar()
    return source.filter(F.col(ts) > F.coalesce(hwm, F.lit(floor).cast(source.schema[ts].dataType)))


def incremental_load(target: DataFrame, source: DataFrame, key: str = "event_id",
                     ts: str = "event_ts") -> DataFrame:
    """Incremental model: new rows by high-water mark, merged by key."""
    return upsert(target, incremental_rows(target, source, ts), key)


def _scratch(spark: SparkSession, tag: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


MAX_TOUCHED = 40_000       # partition values (days: a century) a load may touch; more is junk in the column


def _partition_values(frame: DataFrame, col: str) -> list:
    values = [r[0] for r in frame.select(col).distinct().limit(MAX_TOUCHED + 1).collect()]
    if len(values) > MAX_TOUCHED:
        raise ValueError(f"a load touches more than {MAX_TOUCHED} values of {col}")
    return values


def _in(col: str, values: list):
    """Null-safe membership that still prunes partitions."""
    inside = F.col(col).isin([v for v in values if v is not None])
    return inside | F.col(col).isNull() if None in values else inside


def write_upsert(spark: SparkSession, target_path: str, staging: DataFrame, key: str = "event_id",
                 partition_col: str = "event_date", dedup_staging: bool = False) -> list:
    """Apply an upsert over the whole of a Parquet table partitioned by ``partition_col``.

    A staged key replaces its old row wherever that lies: the touched partitions are those of the
    staged rows and those of the target rows with a staged key (a semi-join that reads the key and
    partition columns only), NULL included. The new content of these partitions is written to the
    shared folder, swapped in by a dynamic partition overwrite, partitions left without rows are
    removed, and the scratch copy is deleted. Returns the touched partition values.
    """
    schema = spark.read.parquet(target_path).schema
    target = spark.read.schema(schema).parquet(target_path)
    keys = staging.select(key).filter(F.col(key).isNotNull()).distinct()
    replaced = target.select(key, partition_col).join(keys, key, "left_semi").select(partition_col)
    staged_in = staging.select(F.col(partition_col).cast(schema[partition_col].dataType).alias(partition_col))
    touched = _partition_values(staged_in.unionByName(replaced), partition_col)
    merged = upsert(target.filter(_in(partition_col, touched)), staging, key, dedup_staging)
    scratch = _scratch(spark, "upsert")
    lake.write_partitioned(merged, scratch, [partition_col], mode="errorifexists")
    fresh = spark.read.schema(schema).parquet(scratch)
    refresh_partitions(spark, target_path, fresh, partition_col, touched)
    lake.remove(spark, scratch)
    return touched


def refresh_partitions(spark: SparkSession, table_path: str, content: DataFrame, partition_col: str,
                       touched: list | None = None) -> None:
    """Replace the partitions present in ``content`` (SNK-10 incremental refresh) and remove the
    ``touched`` ones that it has no rows for any more. ``content`` is read twice: pass a written table."""
    present = _partition_values(content, partition_col)
    lake.write_partitioned(content, table_path, [partition_col], mode="overwrite", dynamic_overwrite=True)
    for value in touched or []:
        if value not in present:
            name = "__HIVE_DEFAULT_PARTITION__" if value is None else value
            lake.remove(spark, f"{table_path.rstrip('/')}/{partition_col}={name}")


def refresh_through_scratch(spark: SparkSession, table_path: str, content: DataFrame, partition_col: str,
                            touched: list | None = None) -> None:
    """:func:`refresh_partitions` of rows that are computed, by way of the shared folder."""
    scratch = _scratch(spark, "refresh")
    content.write.parquet(scratch)
    refresh_partitions(spark, table_path, spark.read.schema(content.schema).parquet(scratch), partition_col, touched)
    lake.remove(spark, scratch)
