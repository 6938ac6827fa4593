"""Raw landing of Kafka topics (SRC-4, SNK-6, SNK-7).

Input is any DataFrame with the Kafka source columns (``key, value, topic, partition,
offset, timestamp``), batch or streaming: ``readStream.format("kafka")`` in production, a
file stream of that shape in tests (no Kafka client jar is installed here).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sensorwerk import schemas as S
from sensorwerk.functions.columns import epoch_ms_to_ts, partition_strings


def kafka_source(spark: SparkSession, servers: str, topics=S.KAFKA_TOPICS,
                 max_offsets: int = S.MAX_OFFSETS_PER_TRIGGER) -> DataFrame:
    """Multi-topic Kafka stream from the earliest offset, bounded per trigger."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", ",".join(topics)).option("startingOffsets", "earliest")
            .option("maxOffsetsPerTrigger", str(max_offsets)).load()
            .select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                    "topic", "partition", "offset", "timestamp"))


def parse_values(df: DataFrame, schema: StructType = S.IOT_SCHEMA, corrupt_col: str = S.CORRUPT_COL) -> DataFrame:
    """Parse the JSON ``value`` with a schema; unparseable values keep their text in
    ``corrupt_col`` and NULL fields."""
    full = S.with_corrupt_column(schema, corrupt_col)
    parsed = F.from_json(F.col("value").cast("string"), full,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_col})
    return df.withColumn("_parsed", parsed).select("topic", "partition", "offset", "_parsed.*")


def split_dead_letters(parsed: DataFrame, corrupt_col: str = S.CORRUPT_COL,
                       dlq_topic: str = S.DEAD_LETTER_TOPIC) -> tuple[DataFrame, DataFrame]:
    """(good records, dead letters with topic / partition / offset / error context)."""
    bad = parsed.filter(F.col(corrupt_col).isNotNull()).select(
        F.lit(dlq_topic).alias("dlq_topic"), F.col("topic").alias("source_topic"), "partition", "offset",
        F.lit("JSON_PARSE_ERROR").alias("error"), F.col(corrupt_col).alias("raw_value"))
    good = parsed.filter(F.col(corrupt_col).isNull()).drop(corrupt_col)
    return good, bad


def landing_columns(df: DataFrame, ms_field: str = "timestamp_ms") -> DataFrame:
    """Hour partition chosen from the record's own epoch-ms field, in UTC (SNK-6)."""
    ts = epoch_ms_to_ts(F.get_json_object(F.col("value"), f"$.{ms_field}").cast("long"))
    return df.withColumns(partition_strings(ts))


def start_landing(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                  max_records: int = S.LANDING_MAX_RECORDS_PER_FILE):
    """gzip JSON lines under ``topic=/year=/month=/day=/hour=``, at most ``max_records`` per
    file, one micro-batch per trigger (5 minutes by default)."""
    out = landing_columns(df).select("topic", "year", "month", "day", "hour", "key", "value", "partition", "offset")
    return (out.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint)
            .option("compression", "gzip").option("maxRecordsPerFile", str(max_records))
            .partitionBy("topic", "year", "month", "day", "hour")
            .trigger(**(trigger or {"processingTime": S.TRIGGER_INTERVAL})).start())


def start_dead_letters(dead: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Dead-letter sink (SNK-7): failed records with their source topic / partition / offset
    and error, as JSON lines partitioned by source topic."""
    return (dead.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint)
            .partitionBy("source_topic")
            .trigger(**(trigger or {"processingTime": S.TRIGGER_INTERVAL})).start())
