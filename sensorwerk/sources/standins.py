"""Telemetry tables derived from the driver's star schema.

``events`` plays the sensor stream, ``customer`` the device population, ``nation`` the plants
and ``region`` their regions. Every derived table is a projection or join of those tables,
so its size grows with them. NULLs, out-of-domain values and re-sent rows are injected by
arithmetic on ``event_id`` so that the quality rules have something to reject.

Each builder has a DuckDB twin in :data:`DUCKDB_CTES` (same semantics, written
independently in SQL) used by the oracle check.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorwerk.functions.columns import (
    anomaly_score, date_sk, quality_bad, threshold_breach,
)
from sensorwerk.sources.tables import read_table


# Devices that the reference tables do not know, told by their key: lookups must cope with them.
NOT_IN_REGISTRY = "{0} % 17 = 3"
NOT_IN_DIMENSION = "{0} % 19 = 5"


def iot_base(spark: SparkSession, sf_dir: str, plant: bool = True) -> DataFrame:
    """Sensor readings with natural ids (as landed in the lake) and surrogate keys; ``plant=False``
    leaves the plant columns out, and with them the join that finds them.

    Projections are SQL expression strings: each column is one parse in the JVM instead of
    a tree of Column objects built call by call from Python.
    """
    e = read_table(spark, sf_dir, "events")
    if plant:
        c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        e = e.join(c, e.user_id == c.c_custkey, "left")
    columns = [
        "event_id AS event_sk",
        "concat('EVT-', cast(event_id AS string)) AS event_id",
        "user_id AS device_sk",
        "cast(c_nationkey AS bigint) AS plant_sk",
        "concat('DEVICE-', printf('%05d', user_id)) AS device_id",
        "CASE user_id % 3 WHEN 0 THEN 'SENSOR' WHEN 1 THEN 'PLC' ELSE 'HMI' END AS device_type",
        "concat('PLANT-', printf('%02d', c_nationkey)) AS plant_id",
        "concat('LINE-', cast(user_id % 4 AS string)) AS line_id",
        "ts AS event_ts",
        "CASE event_type WHEN 'click' THEN 'TEMPERATURE' WHEN 'view' THEN 'VIBRATION' WHEN 'error' THEN 'PRESSURE' "
        "WHEN 'signup' THEN 'HUMIDITY' ELSE 'CURRENT' END AS event_name",
        "CASE WHEN event_id % 89 = 0 THEN CAST(NULL AS double) ELSE value END AS value_numeric",
        "CASE event_type WHEN 'click' THEN 'C' WHEN 'view' THEN 'Hz' WHEN 'error' THEN 'bar' WHEN 'signup' THEN 'pct' "
        "ELSE 'A' END AS unit",
        "CASE WHEN event_id % 97 = 0 THEN CAST(NULL AS int) "
        "ELSE cast(regexp_extract(props, '[0-9]+', 0) AS int) END AS quality",
        "cast(CASE event_type WHEN 'click' THEN 150 WHEN 'view' THEN 200 WHEN 'error' THEN 250 "
        "WHEN 'purchase' THEN 300 END AS double) AS alert_threshold",
    ]
    return e.selectExpr(*[c for c in columns if plant or "c_nationkey" not in c])


IOT_RAW_COLUMNS = ["event_id", "device_id", "device_type", "plant_id", "line_id", "event_ts",
                   "event_name", "value_numeric", "unit", "quality", "alert_threshold"]


def iot_raw(spark: SparkSession, sf_dir: str, plant: bool = True) -> DataFrame:
    """IoT events as the streaming job sees them (natural ids only)."""
    return iot_base(spark, sf_dir, plant).select(*[c for c in IOT_RAW_COLUMNS if plant or c != "plant_id"])


def fact_iot_events(spark: SparkSession, sf_dir: str, plant: bool = True) -> DataFrame:
    """``fact_iot_events`` as loaded by the warehouse (surrogate keys + anomaly flags).

    The 1-minute statistics columns are attached by
    :func:`sensorwerk.operators.aggregates.attach_minute_stats` where a query needs them.
    """
    b = iot_base(spark, sf_dir, plant)
    breach = threshold_breach()
    return b.select(
        "event_sk", "event_id", "device_sk", *(["plant_sk"] if plant else []),
        date_sk("event_ts").alias("date_sk"),
        "event_ts", "event_name", "value_numeric", "unit",
        F.col("quality").cast("smallint").alias("quality"),
        "alert_threshold",
        breach.alias("threshold_breach"),
        anomaly_score(breach, quality_bad()).alias("anomaly_score"),
        F.year("event_ts").cast("smallint").alias("year"),
        F.month("event_ts").cast("smallint").alias("month"),
    )


def dim_plant(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey, "left").selectExpr(
        "cast(n_nationkey AS bigint) AS plant_sk",
        "concat('PLANT-', printf('%02d', n_nationkey)) AS plant_id",
        "n_name AS plant_name",
        "concat('N', printf('%02d', n_nationkey)) AS country_code",
        "r_name AS region",
        "'UTC' AS timezone",
        "cast(100 + n_nationkey * 10 AS int) AS capacity_units",
    )


_CRITICALITY = "CASE WHEN c_acctbal >= 5000 THEN 'HIGH' WHEN c_acctbal >= 0 THEN 'MEDIUM' ELSE 'LOW' END"


def dim_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current device dimension (one version per device)."""
    known = read_table(spark, sf_dir, "customer").where(f"NOT ({NOT_IN_DIMENSION.format('c_custkey')})")
    return known.selectExpr(
        "c_custkey AS device_sk",
        "concat('DEVICE-', printf('%05d', c_custkey)) AS device_id",
        "CASE c_custkey % 3 WHEN 0 THEN 'SENSOR' WHEN 1 THEN 'PLC' ELSE 'HMI' END AS device_type",
        "c_name AS asset_name",
        "concat('PLANT-', printf('%02d', c_nationkey)) AS plant_id",
        "concat('LINE-', cast(c_custkey % 4 AS string)) AS line_id",
        "c_mktsegment AS location",
        f"{_CRITICALITY} AS criticality",
        "cast(5 * (c_custkey % 3 + 1) AS int) AS sla_minutes",
    )


# Versions of a device: every device whose key is a multiple of 5 changed criticality
# at the cut-over below, giving two rows (old, current) in the SCD2 dimension.
SCD2_CUTOVER = "2024-01-15 00:00:00"
SCD2_START = "2000-01-01 00:00:00"


def dim_device_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = dim_device(spark, sf_dir)
    changed = (F.col("device_sk") % 5 == 0)
    cut = F.lit(SCD2_CUTOVER).cast("timestamp_ntz")
    start = F.lit(SCD2_START).cast("timestamp_ntz")
    current = d.select(
        "device_sk", "device_id", "plant_id", "criticality", "sla_minutes",
        F.when(changed, cut).otherwise(start).alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_active"),
    )
    old = d.filter(changed).select(
        "device_sk", "device_id", "plant_id",
        F.when(F.col("criticality") == "HIGH", "MEDIUM").otherwise("HIGH").alias("criticality"),
        "sla_minutes",
        start.alias("valid_from"), cut.alias("valid_to"), F.lit(False).alias("is_active"),
    )
    return current.unionByName(old)


def device_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = read_table(spark, sf_dir, "customer").where(f"NOT ({NOT_IN_REGISTRY.format('c_custkey')})")
    return known.selectExpr(
        "concat('DEVICE-', printf('%05d', c_custkey)) AS device_id",
        "c_name AS asset_name",
        "c_mktsegment AS location",
        f"{_CRITICALITY} AS criticality",
        "concat('SUN-', printf('%02d', c_custkey % 24)) AS maintenance_window",
    )


def log_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Machine logs as parsed from JSON (machines are devices): every 20th event is re-sent one
    second later."""
    e = read_table(spark, sf_dir, "events")
    # one scan: each event yields its original row and, every 20th, a re-sent copy
    t = e.withColumn("resend", F.explode(F.when(F.col("event_id") % 20 == 0, F.array(F.lit(0), F.lit(1)))
                                         .otherwise(F.array(F.lit(0)))))
    return t.selectExpr(
        "concat('LOG-', cast(event_id AS string)) AS event_id",
        "concat('DEVICE-', printf('%05d', user_id)) AS machine_id",
        "concat('PLANT-', printf('%02d', user_id % 25)) AS plant_code",
        "concat('LINE-', cast(user_id % 4 AS string)) AS line_id",
        "CASE WHEN event_id % 67 = 0 THEN CAST(NULL AS string) WHEN event_id % 61 = 0 THEN 'UNKNOWN' "
        "WHEN event_type = 'click' THEN 'START' WHEN event_type = 'view' THEN 'STOP' "
        "WHEN event_type = 'error' THEN 'ALARM' WHEN event_type = 'signup' THEN 'MAINTENANCE' "
        "ELSE 'CYCLE_COMPLETE' END AS event_type",
        "CASE WHEN event_id % 101 = 0 THEN CAST(0 AS bigint) "
        "ELSE timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) + resend * 1000 END AS event_timestamp",
        "CASE WHEN event_id % 59 = 0 THEN 'FATAL' WHEN event_id % 5 = 0 THEN 'INFO' WHEN event_id % 5 = 1 THEN 'WARNING' "
        "WHEN event_id % 5 = 2 THEN 'ERROR' WHEN event_id % 5 = 3 THEN 'CRITICAL' END AS severity",
        "CASE WHEN event_id % 71 = 0 THEN CAST(NULL AS double) ELSE value * 4 - 60 END AS temperature_c",
        "CASE WHEN event_id % 13 = 0 THEN CAST(NULL AS int) ELSE cast(event_id % 11 AS int) END AS resolution_minutes",
        "props AS metadata",
        "resend",
    )


# --------------------------------------------------------------------------------------
# DuckDB twins (oracle only). Names are CTE names usable in ``WITH`` lists.
# --------------------------------------------------------------------------------------
DUCKDB_CTES = {
    "iot_base": """
iot_base AS (
  SELECT e.event_id AS event_sk,
    'EVT-' || CAST(e.event_id AS VARCHAR) AS event_id,
    e.user_id AS device_sk,
    CAST(c.c_nationkey AS BIGINT) AS plant_sk,
    'DEVICE-' || printf('%05d', e.user_id) AS device_id,
    CASE e.user_id % 3 WHEN 0 THEN 'SENSOR' WHEN 1 THEN 'PLC' ELSE 'HMI' END AS device_type,
    'PLANT-' || printf('%02d', c.c_nationkey) AS plant_id,
    'LINE-' || CAST(e.user_id % 4 AS VARCHAR) AS line_id,
    e.ts AS event_ts,
    CASE e.event_type WHEN 'click' THEN 'TEMPERATURE' WHEN 'view' THEN 'VIBRATION'
      WHEN 'error' THEN 'PRESSURE' WHEN 'signup' THEN 'HUMIDITY' ELSE 'CURRENT' END AS event_name,
    CASE WHEN e.event_id % 89 = 0 THEN NULL ELSE e.value END AS value_numeric,
    CASE e.event_type WHEN 'click' THEN 'C' WHEN 'view' THEN 'Hz' WHEN 'error' THEN 'bar'
      WHEN 'signup' THEN 'pct' ELSE 'A' END AS unit,
    CASE WHEN e.event_id % 97 = 0 THEN NULL
      ELSE CAST(regexp_extract(e.props, '[0-9]+', 0) AS INTEGER) END AS quality,
    CAST(CASE e.event_type WHEN 'click' THEN 150 WHEN 'view' THEN 200 WHEN 'error' THEN 250
      WHEN 'purchase' THEN 300 END AS DOUBLE) AS alert_threshold
  FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id)""",
    "iot_raw": """
iot_raw AS (
  SELECT event_id, device_id, device_type, plant_id, line_id, event_ts, event_name,
    value_numeric, unit, quality, alert_threshold FROM iot_base)""",
    "fact": """
fact AS (
  SELECT event_sk, event_id, device_sk, plant_sk,
    CAST(strftime(event_ts, '%Y%m%d') AS INTEGER) AS date_sk,
    event_ts, event_name, value_numeric, unit, CAST(quality AS SMALLINT) AS quality, alert_threshold,
    CASE WHEN alert_threshold IS NOT NULL AND value_numeric IS NOT NULL
      THEN value_numeric > alert_threshold ELSE FALSE END AS threshold_breach,
    CAST(CASE WHEN alert_threshold IS NOT NULL AND value_numeric IS NOT NULL AND value_numeric > alert_threshold THEN 1.0
      WHEN quality < 60 THEN 0.5 ELSE 0.0 END AS DOUBLE) AS anomaly_score,
    CAST(year(event_ts) AS SMALLINT) AS year, CAST(month(event_ts) AS SMALLINT) AS month
  FROM iot_base)""",
    "dim_plant": """
dim_plant AS (
  SELECT CAST(n.n_nationkey AS BIGINT) AS plant_sk,
    'PLANT-' || printf('%02d', n.n_nationkey) AS plant_id,
    n.n_name AS plant_name,
    'N' || printf('%02d', n.n_nationkey) AS country_code,
    r.r_name AS region, 'UTC' AS timezone,
    CAST(100 + n.n_nationkey * 10 AS INTEGER) AS capacity_units
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)""",
    "dim_device": """
dim_device AS (
  SELECT c_custkey AS device_sk,
    'DEVICE-' || printf('%05d', c_custkey) AS device_id,
    CASE c_custkey % 3 WHEN 0 THEN 'SENSOR' WHEN 1 THEN 'PLC' ELSE 'HMI' END AS device_type,
    c_name AS asset_name,
    'PLANT-' || printf('%02d', c_nationkey) AS plant_id,
    'LINE-' || CAST(c_custkey % 4 AS VARCHAR) AS line_id,
    c_mktsegment AS location,
    CASE WHEN c_acctbal >= 5000 THEN 'HIGH' WHEN c_acctbal >= 0 THEN 'MEDIUM' ELSE 'LOW' END AS criticality,
    CAST(5 * (c_custkey % 3 + 1) AS INTEGER) AS sla_minutes
  FROM customer WHERE c_custkey % 19 <> 5)""",
    "dim_device_scd2": f"""
dim_device_scd2 AS (
  SELECT device_sk, device_id, plant_id, criticality, sla_minutes,
    CASE WHEN device_sk % 5 = 0 THEN TIMESTAMP '{SCD2_CUTOVER}' ELSE TIMESTAMP '{SCD2_START}' END AS valid_from,
    CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_active
  FROM dim_device
  UNION ALL
  SELECT device_sk, device_id, plant_id,
    CASE WHEN criticality = 'HIGH' THEN 'MEDIUM' ELSE 'HIGH' END AS criticality, sla_minutes,
    TIMESTAMP '{SCD2_START}' AS valid_from, TIMESTAMP '{SCD2_CUTOVER}' AS valid_to, FALSE AS is_active
  FROM dim_device WHERE device_sk % 5 = 0)""",
    "registry": """
registry AS (
  SELECT 'DEVICE-' || printf('%05d', c_custkey) AS device_id, c_name AS asset_name,
    c_mktsegment AS location,
    CASE WHEN c_acctbal >= 5000 THEN 'HIGH' WHEN c_acctbal >= 0 THEN 'MEDIUM' ELSE 'LOW' END AS criticality,
    'SUN-' || printf('%02d', c_custkey % 24) AS maintenance_window
  FROM customer WHERE c_custkey % 17 <> 3)""",
    "log_raw": """
log_raw AS (
  SELECT 'LOG-' || CAST(event_id AS VARCHAR) AS event_id,
    'DEVICE-' || printf('%05d', user_id) AS machine_id,
    'PLANT-' || printf('%02d', user_id % 25) AS plant_code,
    'LINE-' || CAST(user_id % 4 AS VARCHAR) AS line_id,
    CASE WHEN event_id % 67 = 0 THEN NULL WHEN event_id % 61 = 0 THEN 'UNKNOWN'
      WHEN event_type = 'click' THEN 'START' WHEN event_type = 'view' THEN 'STOP'
      WHEN event_type = 'error' THEN 'ALARM' WHEN event_type = 'signup' THEN 'MAINTENANCE'
      ELSE 'CYCLE_COMPLETE' END AS event_type,
    CASE WHEN event_id % 101 = 0 THEN CAST(0 AS BIGINT)
      ELSE (epoch_us(ts) // 1000) + resend * 1000 END AS event_timestamp,
    CASE WHEN event_id % 59 = 0 THEN 'FATAL' WHEN event_id % 5 = 0 THEN 'INFO'
      WHEN event_id % 5 = 1 THEN 'WARNING' WHEN event_id % 5 = 2 THEN 'ERROR'
      WHEN event_id % 5 = 3 THEN 'CRITICAL' END AS severity,
    CASE WHEN event_id % 71 = 0 THEN NULL ELSE value * 4 - 60 END AS temperature_c,
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(event_id % 11 AS INTEGER) END AS resolution_minutes,
    props AS metadata,
    resend
  FROM (SELECT *, 0 AS resend FROM events
        UNION ALL SELECT *, 1 AS resend FROM events WHERE event_id % 20 = 0) t)""",
}

# CTE dependencies, so an oracle query can ask for what it uses and get the chain
_DEPS = {"iot_raw": ["iot_base"], "fact": ["iot_base"], "dim_device_scd2": ["dim_device"]}


def duckdb_with(*names: str) -> str:
    """``WITH`` clause holding the named CTEs and what they depend on, in order."""
    order: list[str] = []

    def add(n):
        for d in _DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(DUCKDB_CTES[n].strip() for n in order) + "\n"
