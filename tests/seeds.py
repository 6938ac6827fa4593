"""Literal seed rows of the warehouse (SRC-9), used as golden fixtures in tests."""
from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    BooleanType, DateType, DoubleType, IntegerType, LongType, ShortType, StringType, StructField,
    StructType, TimestampNTZType,
)

# ---- fixed values: seed rows of the reference warehouse -------------------------------------
SEED_PLANTS = [
    (1, "LYON-01", "Usine Lyon Nord", "FRA", "EMEA", "Europe/Paris", "06:00", "14:00", "22:00", 500),
    (2, "PARIS-01", "Usine Paris Sud", "FRA", "EMEA", "Europe/Paris", "06:00", "14:00", "22:00", 300),
    (3, "BERLIN-01", "Usine Berlin Est", "DEU", "EMEA", "Europe/Berlin", "06:00", "14:00", "22:00", 800),
]
SEED_DEVICES = [
    (1, "DEVICE-001", "SENSOR", "Capteur Température L1", "LYON-01", "LINE-A", "Hall A", "HIGH",
     "Siemens", "S7-1200", "2022-01-15", 5),
    (2, "DEVICE-002", "PLC", "Automate Ligne 2", "LYON-01", "LINE-B", "Hall B", "HIGH",
     "ABB", "AC500", "2021-06-01", 10),
    (3, "DEVICE-003", "SENSOR", "Capteur Pression P1", "PARIS-01", "LINE-A", "Hall C", "MEDIUM",
     "Bosch", "BMP280", "2023-03-20", 15),
]
SEED_DATES = [
    (20240101, "2024-01-01", 2024, 1, 1, "January", 1, 1, 1, "Monday", False, True, "FY24-Q1"),
    (20240515, "2024-05-15", 2024, 2, 5, "May", 20, 15, 3, "Wednesday", False, False, "FY24-Q2"),
    (20241201, "2024-12-01", 2024, 4, 12, "December", 48, 1, 7, "Sunday", True, False, "FY24-Q4"),
]
# event_id, device_sk, plant_sk, date_sk, event_ts, event_name, value, unit, quality, threshold, breach, score
SEED_EVENTS = [
    ("EVT-001", 1, 1, 20240515, "2024-05-15 08:00:00", "TEMPERATURE", 85.3, "°C", 95, 90.0, False, 0.1),
    ("EVT-002", 1, 1, 20240515, "2024-05-15 08:05:00", "TEMPERATURE", 92.7, "°C", 90, 90.0, True, 0.8),
    ("EVT-003", 2, 1, 20240515, "2024-05-15 08:10:00", "VIBRATION", 1.2, "Hz", 88, 2.0, False, 0.2),
    ("EVT-004", 3, 2, 20240515, "2024-05-15 09:00:00", "PRESSURE", 4.8, "bar", 72, 5.0, False, 0.3),
    ("EVT-005", 1, 1, 20240515, "2024-05-15 09:15:00", "TEMPERATURE", 110.0, "°C", 85, 90.0, True, 0.9),
]
# ------------------------------------------------------------------------------------------------

_PLANT = StructType([
    StructField("plant_sk", LongType()), StructField("plant_id", StringType()),
    StructField("plant_name", StringType()), StructField("country_code", StringType()),
    StructField("region", StringType()), StructField("timezone", StringType()),
    StructField("shift_morning_start", StringType()), StructField("shift_afternoon_start", StringType()),
    StructField("shift_night_start", StringType()), StructField("capacity_units", IntegerType()),
])
_DEVICE = StructType([
    StructField("device_sk", LongType()), StructField("device_id", StringType()),
    StructField("device_type", StringType()), StructField("asset_name", StringType()),
    StructField("plant_id", StringType()), StructField("line_id", StringType()),
    StructField("location", StringType()), StructField("criticality", StringType()),
    StructField("manufacturer", StringType()), StructField("model", StringType()),
    StructField("install_date", DateType()), StructField("sla_minutes", IntegerType()),
])
_DATE = StructType([
    StructField("date_sk", IntegerType()), StructField("full_date", DateType()),
    StructField("year", ShortType()), StructField("quarter", ShortType()), StructField("month", ShortType()),
    StructField("month_name", StringType()), StructField("week_of_year", ShortType()),
    StructField("day_of_month", ShortType()), StructField("day_of_week", ShortType()),
    StructField("day_name", StringType()), StructField("is_weekend", BooleanType()),
    StructField("is_holiday", BooleanType()), StructField("fiscal_period", StringType()),
])
_EVENT = StructType([
    StructField("event_id", StringType()), StructField("device_sk", LongType()),
    StructField("plant_sk", LongType()), StructField("date_sk", IntegerType()),
    StructField("event_ts", TimestampNTZType()), StructField("event_name", StringType()),
    StructField("value_numeric", DoubleType()), StructField("unit", StringType()),
    StructField("quality", ShortType()), StructField("alert_threshold", DoubleType()),
    StructField("threshold_breach", BooleanType()), StructField("anomaly_score", DoubleType()),
])


def seed_plants(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SEED_PLANTS, _PLANT)


def seed_devices(spark: SparkSession) -> DataFrame:
    rows = [r[:10] + (date.fromisoformat(r[10]), r[11]) for r in SEED_DEVICES]
    return spark.createDataFrame(rows, _DEVICE)


def seed_dates(spark: SparkSession) -> DataFrame:
    rows = [(r[0], date.fromisoformat(r[1])) + r[2:] for r in SEED_DATES]
    return spark.createDataFrame(rows, _DATE)


def seed_events(spark: SparkSession) -> DataFrame:
    rows = [r[:4] + (datetime.fromisoformat(r[4]),) + r[5:] for r in SEED_EVENTS]
    return spark.createDataFrame(rows, _EVENT)
