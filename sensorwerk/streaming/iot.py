"""Streaming IoT job (ST-1..8, SRC-2, SRC-8, SNK-4, SNK-5b).

The chain is the batch chain (``detect_anomalies`` / registry join / partition columns) on
a streaming DataFrame, plus the stateful steps a stream needs: an event-time watermark and
de-duplication within it, which bound the state kept in the (RocksDB) state store.
"""
from __future__ import annotations

import logging
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sensorwerk import schemas as S
from sensorwerk.functions.columns import epoch_ms_to_instant, epoch_ms_to_ts
from sensorwerk.operators import aggregates as A
from sensorwerk.operators import enrich
from sensorwerk.sinks import lake

log = logging.getLogger(__name__)


def read_iot_stream(spark: SparkSession, path: str, schema: StructType = S.IOT_SCHEMA,
                    max_files: int = S.MAX_FILES_PER_TRIGGER, corrupt_col: str | None = S.CORRUPT_COL) -> DataFrame:
    """JSON file stream, oldest files first, at most ``max_files`` per micro-batch (SRC-2,
    ST-8). New files only are picked up; the checkpoint remembers the ones done (SRC-8)."""
    full = S.with_corrupt_column(schema, corrupt_col) if corrupt_col else schema
    r = (spark.readStream.format("json").schema(full)
         .option("maxFilesPerTrigger", str(max_files)).option("latestFirst", "false"))
    if corrupt_col:
        r = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_col)
    return r.load(path)


def apply_watermark(df: DataFrame, minutes: int = S.WATERMARK_MINUTES, ms_col: str = "timestamp_ms") -> DataFrame:
    """``event_ts`` from epoch ms (TIMESTAMP: watermarks need an instant type) (ST-1)."""
    return df.withColumn("event_ts", epoch_ms_to_instant(ms_col)).withWatermark("event_ts", f"{minutes} minutes")


def ensure_event_id(df: DataFrame) -> DataFrame:
    """Keep the producer's ``event_id``; derive a content hash when it is missing (D16)."""
    derived = F.concat(F.lit("H-"), F.sha2(F.concat_ws("|", F.col("device_id"), F.col("timestamp_ms").cast("string"),
                                                      F.col("event_name"), F.col("value_numeric").cast("string")), 256))
    return df.withColumn("event_id", F.coalesce(F.col("event_id"), derived))


def dedup_within_watermark(df: DataFrame, key: str = "event_id") -> DataFrame:
    """Drop re-deliveries of a key seen within the watermark delay (ST-3); state per key is
    evicted once the watermark passes, so state size follows the delay, not the stream."""
    return df.dropDuplicatesWithinWatermark([key])


def iot_pipeline(stream: DataFrame, registry: DataFrame, watermark_minutes: int = S.WATERMARK_MINUTES,
                 dedup: str = "sink") -> DataFrame:
    """event time -> event ids -> de-dup -> anomaly flags -> registry -> partition columns (ST-5).

    ``dedup="sink"`` leaves re-deliveries to the sink, which compares a batch with what it holds for
    the same days: rows of any lateness are kept, and no state grows. ``"watermark"`` drops copies
    inside the watermark in the stream's own state (ST-3); rows behind the watermark are dropped
    with them (ST-4; :func:`dropped_rows` counts them)."""
    df = stream
    if S.CORRUPT_COL in df.columns:
        df = df.filter(F.col(S.CORRUPT_COL).isNull()).drop(S.CORRUPT_COL)
    df = ensure_event_id(apply_watermark(df, watermark_minutes))
    if dedup == "watermark":
        df = dedup_within_watermark(df)
    elif dedup != "sink":
        raise ValueError("dedup must be 'sink' or 'watermark'")
    df = enrich.detect_anomalies(df)
    df = enrich.enrich_with_registry(df, registry)
    # hour partition from the record's own epoch ms in UTC, whatever the session time zone
    return enrich.add_partition_cols(df.withColumn("_utc_ts", epoch_ms_to_ts("timestamp_ms")), "_utc_ts").drop("_utc_ts")


def corrupt_records(stream: DataFrame) -> DataFrame:
    """Malformed lines of the file stream with their source file, for a dead-letter sink (D9):
    they are kept out of the pipeline but not dropped silently. The fields that did parse
    are kept as context (a query over raw JSON may not read the corrupt column alone)."""
    return stream.filter(F.col(S.CORRUPT_COL).isNotNull()).select(
        F.col("_metadata.file_path").alias("source_file"), F.lit("JSON_PARSE_ERROR").alias("error"),
        "device_id", "timestamp_ms", F.col(S.CORRUPT_COL).alias("raw_value"))


def start_dead_letter_sink(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """JSON dead-letter sink for :func:`corrupt_records` of the same source."""
    return (corrupt_records(stream).writeStream.format("json").option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": S.TRIGGER_INTERVAL})).start())


def windowed_stats(stream: DataFrame, window: str = "1 minute", watermark_minutes: int = S.WATERMARK_MINUTES,
                   keys=("device_id", "plant_id", "line_id", "event_name", "unit")) -> DataFrame:
    """Tumbling-window statistics on the stream (ST-2); rows of a window are emitted once
    the watermark passes its end (append mode); later rows for it are dropped (ST-4)."""
    return A.window_aggregate(apply_watermark(stream, watermark_minutes), window, keys=keys)


def drain_to_table(spark: SparkSession, stream_df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run an append-mode stream over everything available into a Parquet file sink and
    return the sink's table (the file sink's log makes the output exactly-once)."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(spark.sparkContext.defaultParallelism))   # state partitions of a new query
    try:
        q = (stream_df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
             .outputMode("append").trigger(availableNow=True).start())
    finally:
        spark.conf.set(key, before)
    q.awaitTermination()
    if lost := dropped_rows(q):
        log.warning("%s rows came behind the watermark and are in no window", lost)
    return spark.read.schema(stream_df.schema).parquet(path)


@dataclass
class BatchMetrics:
    rows: list = field(default_factory=list)

    def add(self, batch_id: int, records: int, alarms: int) -> None:
        self.rows.append({"batch_id": batch_id, "records": records, "alarms": alarms})
        log.info("METRIC batch_id=%s records=%s alarms=%s", batch_id, records, alarms)


PRUNED_HOURS = 10_000            # distinct time partitions of a batch that are named to the scan
TIME_PARTITIONS = ("year", "month", "day", "hour")


def landed_before(batch: DataFrame, batch_id: int, output_path: str, time_cols=TIME_PARTITIONS[:3]) -> DataFrame:
    """What earlier batches have written for the time partitions of ``batch``. A copy of a record carries the
    record's own time, so it lies in the same hour; only these folders are read, however large the
    table is. A batch that names too many of them (a backfill) is compared with the whole table."""
    held = batch.sparkSession.read.schema(batch.schema).parquet(output_path).where(F.col("batch_id") != batch_id)
    at = F.concat_ws("-", *time_cols)
    hours = [r[0] for r in batch.select(at).distinct().limit(PRUNED_HOURS + 1).collect()]
    return held.where(at.isin(hours)) if len(hours) <= PRUNED_HOURS else held


def not_landed(batch: DataFrame, batch_id: int, output_path: str, key: str, time_cols=TIME_PARTITIONS[:3]) -> DataFrame:
    """The batch's rows, one per ``key``, that no earlier batch has written for the same time partitions. Only
    the key column is read; a replay does not meet its own files. The batch lies by key already, so the keys are
    sorted in as many tasks: a hash table of all keys held, which their files make look small, is in no task."""
    once = batch.dropDuplicates([key])
    if not lake.exists(batch.sparkSession, output_path):
        return once
    held = landed_before(batch, batch_id, output_path, time_cols)
    return once.join(held.select(key).hint("merge"), key, "left_anti").select(*batch.columns)


def idempotent_batch_writer(output_path: str, partition_cols=("year", "month", "day", "hour", "plant_id"),
                            metrics: BatchMetrics | None = None, key: str | None = "event_id"):
    """``foreachBatch`` function (SNK-4, SNK-5b).

    Each micro-batch lands under a ``batch_id`` leaf partition written with dynamic partition
    overwrite: if a batch is replayed after a failure, its files are replaced, not appended twice.
    Re-delivered records are left out by ``key`` (:func:`not_landed`), however late they come. An empty
    batch replaces nothing. The record / alarm counts are read from the batch's own files.
    """
    cols = list(partition_cols) + ["batch_id"]

    def process(batch_df: DataFrame, batch_id: int) -> None:
        rows = batch_df.withColumn("batch_id", F.lit(batch_id).cast("long"))
        if key:
            times = [c for c in TIME_PARTITIONS if c in cols]
            kept = rows.persist()                        # its hours, then its rows: one pass over the source
            try:
                lake.write_partitioned(not_landed(kept, batch_id, output_path, key, times), output_path, cols, mode="overwrite", dynamic_overwrite=True)
            finally:
                kept.unpersist()
        else:
            lake.write_partitioned(rows, output_path, cols, mode="overwrite", dynamic_overwrite=True)
        if metrics is None:
            return
        landed = batch_df.sparkSession.read.schema(rows.schema).parquet(output_path).where(F.col("batch_id") == batch_id)
        records, alarms = landed.agg(F.count(F.lit(1)), F.count_if(F.col("threshold_breach"))).first()
        if records:
            metrics.add(batch_id, records, alarms)

    return process


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that the query's state operators dropped behind the watermark, over the progress kept."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in p.get("stateOperators", []))


IOT_PARTITIONS = ("year", "month", "day", "hour", "plant_id")
BACKFILL_PARTITIONS = ("year", "month", "day")


def start_iot_sink(df: DataFrame, output_path: str, checkpoint: str, trigger: dict | None = None,
                   metrics: BatchMetrics | None = None, query_name: str | None = None,
                   partition_cols=IOT_PARTITIONS, state_partitions: int | None = None,
                   dedup_key: str | None = "event_id") -> StreamingQuery:
    """Start the stream (ST-6, ST-7). ``trigger`` defaults to a 5-minute processing-time
    trigger; pass ``{"availableNow": True}`` for a bounded catch-up run (bookmark-like).

    The hourly x plant layout suits 5-minute micro-batches (a batch touches a few hour
    partitions of a large stream). A backfill that pushes weeks through one batch should
    pass ``BACKFILL_PARTITIONS``: hour x plant would make a file per hour and plant.

    ``dedup_key``: None for a stream that drops copies in its own state, whose batch must then be
    evaluated once only.

    ``state_partitions``: number of state-store / shuffle partitions of a *new* query (it is
    fixed in the checkpoint at the first start). Applied only while the query starts (the
    stream clones the session then); the session setting is restored right after."""
    w = (df.writeStream.foreachBatch(idempotent_batch_writer(output_path, partition_cols, metrics, dedup_key))
         .option("checkpointLocation", checkpoint))
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"processingTime": S.TRIGGER_INTERVAL}))
    if state_partitions is None:
        return w.start()
    spark = df.sparkSession
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions))
    try:
        return w.start()
    finally:
        spark.conf.set(key, before)


def run_to_completion(spark: SparkSession, stream_df: DataFrame, output_path: str, checkpoint: str,
                      metrics: BatchMetrics | None = None, partition_cols=BACKFILL_PARTITIONS) -> DataFrame:
    """Process everything available now through the sink, then return the sink's table."""
    start_iot_sink(stream_df, output_path, checkpoint, trigger={"availableNow": True}, metrics=metrics,
                   partition_cols=partition_cols,
                   state_partitions=spark.sparkContext.defaultParallelism).awaitTermination()
    # read back with the sink's own schema: partition values such as "05" stay strings
    schema = stream_df.schema.add("batch_id", "long")
    return spark.read.schema(schema).parquet(output_path)


def run_bounded(query: StreamingQuery, minutes: float = S.STREAM_RUN_MINUTES) -> None:
    """Run for at most ``minutes`` then stop the query cleanly (the reference only waited)."""
    finished = query.awaitTermination(timeout=int(minutes * 60))
    if not finished:
        query.stop()


def run_all(spark: SparkSession, queries: list[StreamingQuery], minutes: float | None = None) -> None:
    """Run several queries under one deadline. A query that fails ends the run: the others are
    stopped and its error is raised, whichever of them it is."""
    ends = None if minutes is None else time.monotonic() + minutes * 60
    try:
        while any(q.isActive for q in queries):
            left = 1.0 if ends is None else min(1.0, ends - time.monotonic())
            if left <= 0:
                break
            for q in queries:
                if q.exception() is not None:
                    raise q.exception()
            next(q for q in queries if q.isActive or q is queries[-1]).awaitTermination(timeout=max(0.05, left))
        for q in queries:
            if q.exception() is not None:
                raise q.exception()
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
