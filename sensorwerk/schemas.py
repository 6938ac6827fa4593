"""Record schemas of the telemetry lake and warehouse, and the fixed domain values.

Schemas are always given explicitly on read; ``nullable=False`` is documentation only on
file sources, so required fields are checked by the quality rules instead.
"""
from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, FloatType, IntegerType, LongType,
    ShortType, StringType, StructField, StructType, TimestampNTZType, TimestampType,
)

# ---- fixed values (must equal the reference for identical results) -------------------
VALID_SEVERITIES = ("INFO", "WARNING", "ERROR", "CRITICAL")
VALID_EVENT_TYPES = ("START", "STOP", "ALARM", "MAINTENANCE", "CYCLE_COMPLETE")
TEMPERATURE_RANGE_C = (-50, 1500)        # inclusive
LOW_QUALITY_1MIN = 80                    # "low quality" inside the 1-minute aggregate
BAD_QUALITY = 60                         # "bad quality" of the anomaly flags and the KPI roll-up
HIGH_ANOMALY_SCORE = 0.8                 # strict: score > 0.8
SCORE_BREACH, SCORE_BAD_QUALITY, SCORE_NORMAL = 1.0, 0.5, 0.0
SLA_ALARM_RATE_PCT = 1.0                 # alarm rate below this is COMPLIANT
SLA_ACK_MINUTES = 5                      # default alarm acknowledgement SLA
SIGMA_LIMIT = 3.0                        # statistical anomaly: |x - mean| > 3 stddev
WATERMARK_MINUTES = 5
MAX_FILES_PER_TRIGGER = 500
MAX_OFFSETS_PER_TRIGGER = 5000
TRIGGER_INTERVAL = "5 minutes"
STREAM_RUN_MINUTES = 110
LANDING_MAX_RECORDS_PER_FILE = 10000
KAFKA_TOPICS = ("factory-iot-events", "factory-machine-logs", "factory-alerts")
DEAD_LETTER_TOPIC = "factory-iot-dlq"
# ----------------------------------------------------------------------------------------

CORRUPT_COL = "_corrupt_record"

# Record schemas below: field names and types are fixed values as well.

LOG_SCHEMA = StructType([
    StructField("event_id", StringType(), False),
    StructField("machine_id", StringType(), False),
    StructField("plant_code", StringType(), False),
    StructField("line_id", StringType(), True),
    StructField("event_type", StringType(), False),
    StructField("event_timestamp", LongType(), False),   # epoch milliseconds
    StructField("severity", StringType(), True),
    StructField("error_code", StringType(), True),
    StructField("temperature_c", DoubleType(), True),
    StructField("vibration_hz", DoubleType(), True),
    StructField("pressure_bar", DoubleType(), True),
    StructField("cycle_count", LongType(), True),
    StructField("operator_id", StringType(), True),
    StructField("shift", StringType(), True),
    StructField("metadata", StringType(), True),          # JSON text, parsed on demand
])

IOT_SCHEMA = StructType([
    StructField("event_id", StringType(), True),          # sent by producers, absent upstream
    StructField("device_id", StringType(), False),
    StructField("device_type", StringType(), True),
    StructField("plant_id", StringType(), False),
    StructField("line_id", StringType(), True),
    StructField("timestamp_ms", LongType(), False),
    StructField("event_name", StringType(), False),
    StructField("value_numeric", DoubleType(), True),
    StructField("value_string", StringType(), True),
    StructField("unit", StringType(), True),
    StructField("quality", IntegerType(), True),
    StructField("tags", ArrayType(StringType()), True),
    StructField("alert_threshold", DoubleType(), True),
    StructField("firmware_version", StringType(), True),
])

REGISTRY_SCHEMA = StructType([
    StructField("device_id", StringType(), False),
    StructField("asset_name", StringType(), True),
    StructField("location", StringType(), True),
    StructField("criticality", StringType(), True),
    StructField("maintenance_window", StringType(), True),
])

FACT_IOT_SCHEMA = StructType([
    StructField("event_sk", LongType(), True),
    StructField("event_id", StringType(), True),
    StructField("device_sk", LongType(), True),
    StructField("plant_sk", LongType(), True),
    StructField("date_sk", IntegerType(), True),
    StructField("event_ts", TimestampNTZType(), False),
    StructField("event_name", StringType(), True),
    StructField("value_numeric", DoubleType(), True),
    StructField("value_string", StringType(), True),
    StructField("unit", StringType(), True),
    StructField("quality", ShortType(), True),
    StructField("alert_threshold", DoubleType(), True),
    StructField("threshold_breach", BooleanType(), True),
    StructField("anomaly_score", DoubleType(), True),
    StructField("avg_value_1min", DoubleType(), True),
    StructField("stddev_value_1min", DoubleType(), True),
    StructField("processed_at", TimestampNTZType(), True),
    StructField("year", ShortType(), True),
    StructField("month", ShortType(), True),
])

FACT_LOG_SCHEMA = StructType([
    StructField("log_sk", LongType(), True),
    StructField("event_id", StringType(), False),
    StructField("machine_id", StringType(), False),
    StructField("device_sk", LongType(), True),
    StructField("plant_sk", LongType(), True),
    StructField("date_sk", IntegerType(), True),
    StructField("event_ts", TimestampNTZType(), False),
    StructField("event_type", StringType(), True),
    StructField("severity", StringType(), True),
    StructField("error_code", StringType(), True),
    StructField("temperature_c", FloatType(), True),
    StructField("vibration_hz", FloatType(), True),
    StructField("pressure_bar", FloatType(), True),
    StructField("cycle_count", LongType(), True),
    StructField("operator_id", StringType(), True),
    StructField("shift", StringType(), True),
    StructField("is_alarm", BooleanType(), True),
    StructField("is_critical", BooleanType(), True),
    StructField("resolution_minutes", IntegerType(), True),   # NULL until resolved
    StructField("processed_at", TimestampNTZType(), True),
    StructField("year", ShortType(), True),
    StructField("month", ShortType(), True),
])

# Kafka source columns (what ``readStream.format("kafka")`` yields)
KAFKA_SCHEMA = StructType([
    StructField("key", StringType(), True),
    StructField("value", StringType(), True),
    StructField("topic", StringType(), True),
    StructField("partition", IntegerType(), True),
    StructField("offset", LongType(), True),
    StructField("timestamp", TimestampType(), True),
])


def with_corrupt_column(schema: StructType, name: str = CORRUPT_COL) -> StructType:
    """New schema with the corrupt-record column appended (the input is not mutated)."""
    return StructType(list(schema.fields) + [StructField(name, StringType(), True)])
