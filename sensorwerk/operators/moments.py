"""Mergeable statistics: count, mean and sum of squared deviations of parts of a group (A-1, ST-2).

Parts (of a load, of a micro-batch) merge by Chan's formula, which subtracts no large sums from each
other: with n and the mean of the whole, every part adds its own squared deviations and
``n_part * (mean_part - mean) ** 2``. A group without values has n 0 and no mean.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PARTS = ("n", "mean", "dev", "min", "max")


def names(measure: str) -> list[str]:
    return [f"{measure}_{p}" for p in PARTS]


def parts(measure: str, column: Column) -> list[Column]:
    """Aggregates that make a part of ``measure`` out of rows."""
    n = F.count(column)
    return [n.alias(f"{measure}_n"), F.avg(column).alias(f"{measure}_mean"),
            F.coalesce(F.var_pop(column) * n, F.lit(0.0)).alias(f"{measure}_dev"),
            F.min(column).alias(f"{measure}_min"), F.max(column).alias(f"{measure}_max")]


def merge(rows: DataFrame, keys: list[str], measures: list[str], sums: list[str] = (), greatest: list[str] = ()) -> DataFrame:
    """One row per key out of its parts; ``sums`` and ``greatest`` are plain columns that add up or take the most.

    The mean of the whole comes from a window over the key, whose rows are the key's parts (one a batch
    that met it), and the sums from an aggregate over the same partitioning: one shuffle.
    """
    part = Window.partitionBy(*keys)
    whole = rows
    for m in measures:
        n, mean = F.col(f"{m}_n"), F.col(f"{m}_mean")
        whole = whole.withColumn(f"_{m}", F.sum(n * mean).over(part) / F.nullif(F.sum(n).over(part), F.lit(0).cast("long")))
    merged = []
    for m in measures:
        n, mean, all_mean = F.col(f"{m}_n"), F.col(f"{m}_mean"), F.col(f"_{m}")
        apart = F.when(n > 0, n * (mean - all_mean) * (mean - all_mean)).otherwise(0.0)
        merged += [F.sum(n).alias(f"{m}_n"), F.first(all_mean).alias(f"{m}_mean"), F.sum(F.col(f"{m}_dev") + apart).alias(f"{m}_dev"),
                   F.min(f"{m}_min").alias(f"{m}_min"), F.max(f"{m}_max").alias(f"{m}_max")]
    return whole.groupBy(*keys).agg(*merged, *[F.sum(c).alias(c) for c in sums], *[F.max(c).alias(c) for c in greatest])


def stddev(measure: str) -> Column:
    """Sample standard deviation; NULL below two values."""
    n = F.col(f"{measure}_n")
    return F.when(n > 1, F.sqrt(F.greatest(F.col(f"{measure}_dev"), F.lit(0.0)) / (n - 1)))
