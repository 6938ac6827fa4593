"""Keep-latest de-duplication (W-1) for batches; streams use ``dropDuplicatesWithinWatermark``.

``row_number() = 1`` prunes: only the key, the ordering and the columns that the caller goes on
to use reach the scan and the shuffle, and Spark limits every key to its first row per task before
the shuffle (partial ``WindowGroupLimit``), so a key re-sent a million times ships one row a task.
Where the caller also wants the number of copies, the survivors and the counts come from one
aggregate (``max_by`` over the named columns), which is reduced map-side as well. Ties are broken by
the extra ordering columns the caller names, so the result is deterministic.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, key: str, order: Sequence[str], copies_col: str | None = None,
                null_keys: str = "collapse", columns: Sequence[str] | None = None) -> DataFrame:
    """One row per ``key``: the one with the greatest ``order`` tuple (NULLs lose).

    ``columns`` names what the result carries (all by default). ``copies_col`` adds how many input
    rows each survivor stood for. ``null_keys``: ``"collapse"`` (all NULL-key rows form one group,
    as in the reference) or ``"keep"`` (they pass through; a second branch over the input).
    """
    if null_keys not in ("collapse", "keep"):
        raise ValueError("null_keys must be 'collapse' or 'keep'")
    wanted = list(columns or df.columns)
    keyed = df if null_keys == "collapse" else df.filter(F.col(key).isNotNull())
    if copies_col:
        latest = F.max_by(F.struct(*wanted), F.struct(*order)).alias("_row")
        out = keyed.groupBy(F.col(key).alias("_key")).agg(latest, F.count(F.lit(1)).alias(copies_col)).select("_row.*", copies_col)
    else:
        nth = F.row_number().over(Window.partitionBy(key).orderBy(*[F.desc_nulls_last(c) for c in order]))
        out = keyed.withColumn("_nth", nth).filter(F.col("_nth") == 1).select(*wanted)
    if null_keys == "collapse":
        return out
    nulls = df.filter(F.col(key).isNull()).select(*wanted)
    return out.unionByName(nulls.withColumn(copies_col, F.lit(1).cast("long")) if copies_col else nulls)
