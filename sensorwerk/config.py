"""Session settings and size-checked planning helpers.

Nothing here creates a session at import time. Jobs, the bench and the tests call
:func:`build_session`; library functions take the caller's session.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every job runs with. AQE re-plans joins from runtime sizes (a side that turns
# out small becomes a broadcast; a skewed partition is split), and coalesces shuffle
# output toward the advisory size so tasks stay near 128 MB at any input scale.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Byte bound, by the planner's own statistics, up to which a join side is hinted for broadcast.
BROADCAST_MAX_BYTES = 64 << 20


def build_session(master: str | None = None, app_name: str = "sensorwerk",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    for key, value in JOB_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder named by the cluster in ``spark.checkpoint.dir``.

    Lineage is cut by writing there (``DataFrame.checkpoint`` or a written table); a
    machine-local temp folder would vanish with the executor that wrote it. Only when the
    session names none is a folder chosen, under the SQL warehouse directory (the shared
    table location of the deployment), and recorded on the session.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        path = f"{warehouse.rstrip('/')}/_checkpoints"
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of a frame (files and their row widths; no job is run)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def bounded_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint only when the plan's statistics bound the side; otherwise the choice is the
    planner's (sort-merge join, re-planned by AQE from the sizes it meets)."""
    return F.broadcast(df) if plan_bytes(df) <= max_bytes else df
