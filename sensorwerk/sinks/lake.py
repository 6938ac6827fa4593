"""Lake writes (SNK-1..3, SNK-12, SNK-13).

Partitioned writes go through a ``REBALANCE`` on the partition columns: AQE then sizes the
write tasks toward the advisory partition size and splits a hot partition value over
several tasks and files instead of one straggler.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from sensorwerk.operators.quality import DQ_HELPER_COLUMNS

LOG_PARTITIONS = ("year", "month", "day", "hour", "plant_code")
IOT_PARTITIONS = ("year", "month", "day", "hour", "plant_id")
DQ_PARTITIONS = ("year", "month", "plant_code")
BACKFILL_PARTITIONS = ("year", "month", "day")


def write_partitioned(df: DataFrame, path: str, partition_cols, fmt: str = "parquet", mode: str = "append",
                      max_records_per_file: int | None = None, dynamic_overwrite: bool = False, **options) -> None:
    cols = list(partition_cols)
    w = df.hint("rebalance", *cols).write.mode(mode).format(fmt).partitionBy(*cols)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    if dynamic_overwrite:
        w = w.option("partitionOverwriteMode", "dynamic")
    for k, v in options.items():
        w = w.option(k, v)
    w.save(path)


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the lake or of the scratch area, if it is there."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(folder):
        fs.delete(folder, True)


def write_processed(clean: DataFrame, path: str, partition_cols=LOG_PARTITIONS) -> None:
    """Clean logs without the rule helper columns (SNK-1)."""
    keep = clean.drop(*[c for c in DQ_HELPER_COLUMNS if c in clean.columns])
    write_partitioned(keep, path, partition_cols)


def write_quarantine(bad: DataFrame, path: str, run_id: str) -> None:
    """Corrupt records as JSON under ``job_run=<id>/`` with the quarantine time (SNK-2).
    Written in parallel: no ``coalesce(1)`` funnel."""
    tagged = bad.withColumns({"quarantine_ts": F.current_timestamp(), "job_run": F.lit(run_id)})
    write_partitioned(tagged, path, ["job_run"], fmt="json")


def write_dq_failures(failed: DataFrame, path: str, partition_cols=DQ_PARTITIONS) -> None:
    """Rows failing a rule, with their rule flags and reason (SNK-3)."""
    write_partitioned(failed, path, partition_cols)


FILE_BYTES = 128 << 20           # of a file's rows as the task that sorts them holds them; the file is several times smaller


def rows_bytes(df: DataFrame) -> int:
    """Bytes of the rows as a task holds them: eight a column and the texts' own, in one pass over the rows. Files tell
    less (encoded columns shrink ten times and more), a plan's estimate far more (a join's is the product of its sides)."""
    wide = [f.name for f in df.schema if isinstance(f.dataType, (StringType, BinaryType, ArrayType, MapType, StructType))]
    texts = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)).cast("long") for c in wide]
    row = sum(texts, F.lit(8 * len(df.columns)).cast("long"))
    return df.agg(F.coalesce(F.sum(row), F.lit(0))).first()[0]


JOINED_BYTES = 16 << 20          # of a broadcast side's rows; their hash table takes about seven times as much in every task


def join_side(df: DataFrame) -> DataFrame:
    """A join side of keys: broadcast if its rows are few by their own bytes (:func:`rows_bytes`, one pass), else
    for a sort-merge join, whose tasks hold a partition and spill, however little its files tell of the rows."""
    return F.broadcast(df) if rows_bytes(df) <= JOINED_BYTES else df.hint("merge")


def write_clustered(df: DataFrame, path: str, cluster_cols, sort_cols, partition_cols=(),
                    num_partitions: int | None = None, mode: str = "overwrite", size: int | None = None) -> None:
    """Load-time physical ordering (SNK-12): range-partition on the leading sort key and sort
    inside each file, so Parquet row-group min/max statistics skip most of a range scan.

    The number of ranges follows ``size``, the bytes of the rows (:func:`rows_bytes`, the default), one for
    every ``FILE_BYTES``, so that no task sorts more however well the rows compress; a partition value with
    many rows spans several ranges."""
    n = num_partitions or max(1, -(-(size if size is not None else rows_bytes(df)) // FILE_BYTES))
    ordered = df.repartitionByRange(n, *partition_cols, *cluster_cols).sortWithinPartitions(*partition_cols, *sort_cols)
    w = ordered.write.mode(mode)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)


def analyze_table(spark: SparkSession, table: str, columns=()) -> None:
    """Table and column statistics for the cost-based optimizer (SNK-13)."""
    if columns:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")
    else:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")


def save_bucketed(df: DataFrame, table: str, bucket_cols, buckets: int, sort_cols=(), mode: str = "overwrite") -> None:
    """Saved table bucketed on the join key (the DISTKEY of the reference): later joins or
    aggregations on ``bucket_cols`` between tables with the same bucketing skip the shuffle."""
    w = df.write.mode(mode).format("parquet").bucketBy(buckets, *bucket_cols)
    if sort_cols:
        w = w.sortBy(*sort_cols)
    w.saveAsTable(table)
