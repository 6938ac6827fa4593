"""Windowed statistics that keep late rows (ST-2, ST-4).

In append mode a window is emitted once and rows behind the watermark are dropped. Here every
micro-batch writes the parts of the windows that its rows fall into (counts, means, squared
deviations, extremes) and a reader merges the parts, so a row counts in its window whenever it
arrives, no state grows with the stream, and a window's figures are those of a batch over all rows.

``path/parts/window_date=<d>/batch_id=<n>``  the parts a batch wrote; a replay overwrites its own
``path/progress/batch_id=<n>``               rows, late rows and the latest event time so far

A row is late if it lies behind the watermark of the batches before its own (latest event time less
the delay): ``late_count`` tells how much of a window came late, and on-time and late rows together
are the rows that arrived. Rows without an event time are in no window and counted as ``untimed``.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorwerk import schemas as S
from sensorwerk.functions.columns import epoch_ms_to_instant
from sensorwerk.operators import moments
from sensorwerk.sinks import lake

KEYS = ("device_id", "plant_id", "line_id", "event_name", "unit")
SUMS = ["event_count", "low_quality_count", "late_count"]
PROGRESS = "rows long, timed long, late long, latest timestamp, batch_id long"


def window_parts(rows: DataFrame, window: str = "1 minute", keys=KEYS, ts: str = "event_ts", behind=None) -> DataFrame:
    """Parts of the windows that ``rows`` fall into; rows before ``behind`` count as late."""
    late = F.count_if(F.col(ts) < F.lit(behind)) if behind is not None else F.lit(0).cast("long")
    timed = rows.where(F.col(ts).isNotNull())
    return timed.groupBy(F.window(ts, window).alias("w"), *keys).agg(
        *moments.parts("value", F.col("value_numeric")), *moments.parts("quality", F.col("quality")),
        F.count(F.lit(1)).alias("event_count"), F.count_if(F.col("quality") < S.LOW_QUALITY_1MIN).alias("low_quality_count"),
        late.alias("late_count"), F.max(ts).alias("latest")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, *moments.names("value"),
        *moments.names("quality"), *SUMS, "latest", F.to_date("w.start").alias("window_date"))


def _progress(spark: SparkSession, path: str, batch_id: int):
    folder = f"{path}/progress/batch_id={batch_id}"
    if not lake.exists(spark, folder):
        return None
    return spark.read.option("basePath", f"{path}/progress").schema(PROGRESS).parquet(folder).first()


def window_writer(path: str, window: str, keys=KEYS, delay_minutes: int = S.WATERMARK_MINUTES) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: the batch's parts and its progress row, both replaced by a replay."""
    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _progress(spark, path, batch_id - 1)
        behind = None
        if before is not None and before.latest is not None:
            behind = spark.range(1).select((F.lit(before.latest) - F.expr(f"INTERVAL {int(delay_minutes)} MINUTES")).alias("t")).first().t
        rows = batch.withColumn("event_ts", epoch_ms_to_instant("timestamp_ms")).persist()
        try:
            parts = window_parts(rows, window, keys, behind=behind).withColumn("batch_id", F.lit(batch_id).cast("long"))
            lake.write_partitioned(parts, f"{path}/parts", ["window_date", "batch_id"], mode="overwrite", dynamic_overwrite=True)
            late = F.count_if(F.col("event_ts") < F.lit(behind)) if behind is not None else F.lit(0).cast("long")
            now = rows.agg(F.count(F.lit(1)).alias("rows"), F.count("event_ts").alias("timed"), late.alias("late"),
                           F.max("event_ts").alias("latest")).first()
        finally:
            rows.unpersist()
        so_far = [x for x in (now.latest, before.latest if before is not None else None) if x is not None]
        row = spark.createDataFrame([(now["rows"], now.timed, now.late, max(so_far, default=None), batch_id)], PROGRESS)
        lake.write_partitioned(row, f"{path}/progress", ["batch_id"], mode="overwrite", dynamic_overwrite=True)

    return process


def start_windows(stream: DataFrame, path: str, checkpoint: str, window: str = "1 minute", keys=KEYS,
                  delay_minutes: int = S.WATERMARK_MINUTES, trigger: dict | None = None) -> StreamingQuery:
    """Starts the windowed statistics of a raw event stream (``timestamp_ms``)."""
    return (stream.writeStream.foreachBatch(window_writer(path.rstrip("/"), window, keys, delay_minutes))
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": S.TRIGGER_INTERVAL})).start())


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path.rstrip('/')}/parts")


def read_windows(spark: SparkSession, path: str, keys=KEYS, closed_after: int | None = None) -> DataFrame:
    """The windows' statistics as of now (the columns of the batch aggregate, and ``late_count``).

    ``closed_after``: only windows that ended that many minutes before the latest event.
    """
    by = ["window_start", "window_end", *keys]
    parts = read_parts(spark, path)
    whole = moments.merge(parts.select(*by, *moments.names("value"), *moments.names("quality"), *SUMS), by, ["value", "quality"], SUMS)
    if closed_after is not None:
        latest = parts.select(F.max("latest")).scalar()
        whole = whole.where(F.col("window_end") <= latest - F.expr(f"INTERVAL {int(closed_after)} MINUTES"))
    return whole.select(
        "window_start", "window_end", *keys, F.col("value_mean").alias("avg_value"), F.col("value_min").alias("min_value"),
        F.col("value_max").alias("max_value"), moments.stddev("value").alias("stddev_value"), F.col("quality_mean").alias("avg_quality"),
        "event_count", "low_quality_count", "late_count")


def arrivals(spark: SparkSession, path: str) -> DataFrame:
    """One row: rows that arrived, those on time, late and untimed, those in windows, and the number of batches."""
    seen = spark.read.schema(PROGRESS).parquet(f"{path.rstrip('/')}/progress").agg(
        F.sum("rows").alias("rows_in"), (F.sum("timed") - F.sum("late")).alias("on_time"), F.sum("late").alias("late"),
        (F.sum("rows") - F.sum("timed")).alias("untimed"), F.count(F.lit(1)).alias("batches"))
    held = read_parts(spark, path).agg(F.coalesce(F.sum("event_count"), F.lit(0)).alias("in_windows")).select("in_windows")
    return seen.select("*", held.scalar().alias("in_windows"))
