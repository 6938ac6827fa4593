"""Dataset size report (Q-10): files, bytes and rows per table from Parquet file metadata."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def dataset_size_report(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """``tables``: name -> path. Rows are counted per file from the hidden ``_metadata``
    column (a partial aggregate per task), then summed per table."""
    parts = []
    for name, path in tables.items():
        per_file = (spark.read.parquet(path)
                    .select(F.col("_metadata.file_path").alias("file_path"),
                            F.col("_metadata.file_size").alias("file_size"))
                    .groupBy("file_path").agg(F.max("file_size").alias("file_size"),
                                              F.count(F.lit(1)).alias("rows")))
        parts.append(per_file.agg(F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("bytes"),
                                  F.sum("rows").alias("rows")).select(F.lit(name).alias("table_name"),
                                                                      "files", "bytes", "rows"))
    return reduce(lambda a, b: a.unionByName(b), parts)
