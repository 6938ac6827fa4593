"""Record quality: corrupt-row split, domain rules, routing and run accounting
(PRJ-1..3, A-9, SNK-5a, Q-9).

Rules keep the reference's three-valued meaning in ``dq_pass`` (a NULL required field makes
it NULL). Routing is strict by default: only a TRUE ``dq_pass`` is clean, everything else —
NULL included — goes to the failure side with a reason, so no row falls between outputs.
"""
from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorwerk import schemas as S

@dataclass(frozen=True)
class Rule:
    """A domain rule of one column. ``domain``: the allowed values, or an inclusive (low, high) range
    whose open end is None. ``null_ok``: a NULL passes; otherwise it leaves the flag unknown."""
    flag: str
    column: str
    domain: tuple
    null_ok: bool
    is_range: bool = False

    def holds(self) -> Column:
        value = F.col(self.column)
        if not self.is_range:
            inside = value.isin(list(self.domain))
        else:
            low, high = self.domain
            bounds = [b for b in (None if low is None else value >= low, None if high is None else value <= high) if b is not None]
            inside = reduce(lambda x, y: x & y, bounds)
        return F.coalesce(inside, F.lit(True)) if self.null_ok else inside


LOG_RULES = (
    Rule("severity_valid", "severity", S.VALID_SEVERITIES, null_ok=True),
    Rule("event_type_valid", "event_type", S.VALID_EVENT_TYPES, null_ok=False),
    Rule("temp_valid", "temperature_c", S.TEMPERATURE_RANGE_C, null_ok=True, is_range=True),
    Rule("ts_valid", "event_timestamp", (1, None), null_ok=False, is_range=True),
)
RULE_COLUMNS = tuple(r.flag for r in LOG_RULES)
DQ_HELPER_COLUMNS = RULE_COLUMNS + ("dq_pass", "dq_pass_strict", "dq_reason")


def split_corrupt(df: DataFrame, corrupt_col: str = S.CORRUPT_COL) -> tuple[DataFrame, DataFrame]:
    """(rows that parsed, without the raw text; rows that did not, with it)."""
    parsed = F.col(corrupt_col).isNull()
    return df.where(parsed).select(*[c for c in df.columns if c != corrupt_col]), df.where(~parsed)


def with_dq_flags(df: DataFrame) -> DataFrame:
    """Adds the four rule flags, ``dq_pass`` (three-valued AND), ``dq_pass_strict`` (NULL is
    a failure) and ``dq_reason`` (comma list of failed or unknown rules, NULL when clean)."""
    out = df.withColumns({r.flag: r.holds() for r in LOG_RULES})
    passed = reduce(lambda x, y: x & y, [F.col(c) for c in RULE_COLUMNS])
    reasons = [F.when(~F.coalesce(F.col(c), F.lit(False)), F.lit(c[: -len("_valid")])) for c in RULE_COLUMNS]
    reason = F.concat_ws(",", *reasons)
    return out.withColumns({
        "dq_pass": passed,
        "dq_pass_strict": F.coalesce(passed, F.lit(False)),
        "dq_reason": F.when(reason == "", F.lit(None).cast("string")).otherwise(reason),
    })


def fail_missing_key(df: DataFrame, key: str) -> DataFrame:
    """Mark rows whose record key is NULL as failing, with the key named in the reason."""
    reason = F.when(F.col("dq_reason").isNull(), F.lit(key)).otherwise(F.concat_ws(",", F.lit(key), F.col("dq_reason")))
    return df.withColumns({"dq_pass": F.lit(False), "dq_pass_strict": F.lit(False), "dq_reason": reason})


def route(df: DataFrame, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """(clean, failed). ``strict=False`` reproduces the reference: NULL goes to neither side."""
    clean = df.filter(F.col("dq_pass") == F.lit(True))
    failed = df.filter(~F.col("dq_pass_strict")) if strict else df.filter(F.col("dq_pass") == F.lit(False))
    return clean, failed


def route_clean(df: DataFrame) -> DataFrame:
    """The clean side of :func:`route` alone."""
    return df.filter(F.col("dq_pass"))


def run_metrics(raw: DataFrame, deduped: DataFrame, copies_col: str = "copies",
                corrupt_col: str = S.CORRUPT_COL) -> DataFrame:
    """All job counts in one aggregation pass (A-9, SNK-5a).

    ``deduped`` carries, per surviving row, how many raw rows it absorbed (``copies``), so
    duplicates removed = sum(copies) - rows. Corrupt rows come from ``raw`` in the same
    union; the global aggregate is partial per task, one row reaches the final stage.
    """
    parts = deduped.select(
        F.col(copies_col).cast("long").alias("_raw"),
        F.lit(1).cast("long").alias("_kept"),
        F.col("dq_pass").alias("_pass"),
        F.lit(0).cast("long").alias("_corrupt"),
    )
    if corrupt_col in raw.columns:
        bad = raw.filter(F.col(corrupt_col).isNotNull()).select(
            F.lit(1).cast("long").alias("_raw"), F.lit(0).cast("long").alias("_kept"),
            F.lit(None).cast("boolean").alias("_pass"), F.lit(1).cast("long").alias("_corrupt"))
        parts = parts.unionByName(bad)
    total = F.coalesce(F.sum("_raw"), F.lit(0))
    kept = F.coalesce(F.sum("_kept"), F.lit(0))
    corrupt = F.coalesce(F.sum("_corrupt"), F.lit(0))
    written = F.count_if(F.col("_pass") == F.lit(True))
    m = parts.agg(
        total.alias("total_raw"),
        corrupt.alias("corrupt_records"),
        kept.alias("after_dedup"),
        (total - corrupt - kept).alias("duplicates_removed"),
        written.alias("written"),
        F.count_if((F.col("_kept") == 1) & ~F.coalesce(F.col("_pass"), F.lit(False))).alias("dq_failed"),
        F.count_if((F.col("_kept") == 1) & F.col("_pass").isNull()).alias("dq_unknown"),
    )
    return m.withColumn(
        "dq_fail_rate",
        F.round(F.lit(1.0) - F.col("written").cast("double") / F.greatest(F.col("total_raw"), F.lit(1)), 4))


def dq_fail_rate_by(df_flagged: DataFrame, by: str = "plant_code") -> DataFrame:
    """Quality failure rate per plant (Q-9): rows, failing rows, failing share in percent."""
    failed = F.count_if(~F.col("dq_pass_strict"))
    return df_flagged.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows"),
        failed.alias("failed_rows"),
        F.count_if(F.col("dq_pass").isNull()).alias("unknown_rows"),
        F.round(failed.cast("double") / F.count(F.lit(1)) * 100, 2).alias("fail_rate_pct"),
    )
