"""Column expressions shared by batch and streaming stages.

All of them are built-in Catalyst expressions (whole-stage codegen, no Python in tasks).
Time bucketing works on TIMESTAMP_NTZ wall-clock values (UTC by convention) so results
do not depend on the session time zone.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorwerk import schemas as S

__all__ = [
    "col_of", "epoch_ntz", "epoch_ms_to_ts", "epoch_ms_to_instant", "ts_to_epoch_ms",
    "hour_start", "week_start", "day_start", "date_sk", "partition_strings", "ratio_pct",
    "wow_delta_pct", "sla_status", "threshold_breach", "anomaly_score", "quality_bad",
    "bucket_start", "ntz", "round_numeric", "json_field",
]

def epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms_to_ts(ms) -> Column:
    """Epoch milliseconds -> TIMESTAMP_NTZ wall clock in UTC (session-tz independent)."""
    return F.timestamp_add("MILLISECOND", col_of(ms), epoch_ntz())


def epoch_ms_to_instant(ms) -> Column:
    """Epoch milliseconds -> TIMESTAMP (an instant); needed for streaming watermarks."""
    return F.timestamp_millis(col_of(ms))


def ts_to_epoch_ms(ts) -> Column:
    """TIMESTAMP_NTZ wall clock (UTC) -> epoch milliseconds."""
    return F.timestamp_diff("MILLISECOND", epoch_ntz(), col_of(ts))


def hour_start(ts) -> Column:
    """Start of the hour, kept as TIMESTAMP_NTZ."""
    return F.timestamp_add("HOUR", F.timestamp_diff("HOUR", epoch_ntz(), col_of(ts)), epoch_ntz())


def day_start(ts) -> Column:
    return F.to_date(col_of(ts))


def week_start(ts) -> Column:
    """Monday of the ISO week, as DATE."""
    d = F.to_date(col_of(ts))
    return F.date_sub(d, F.weekday(d))


def date_sk(ts) -> Column:
    """Calendar key YYYYMMDD as INT."""
    d = F.to_date(col_of(ts))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def partition_strings(ts) -> dict[str, Column]:
    """Hive partition values year / month / day / hour as zero-padded strings."""
    t = col_of(ts)
    return {
        "year": F.year(t).cast("string"),
        "month": F.lpad(F.month(t).cast("string"), 2, "0"),
        "day": F.lpad(F.dayofmonth(t).cast("string"), 2, "0"),
        "hour": F.lpad(F.hour(t).cast("string"), 2, "0"),
    }


def ratio_pct(num, den, scale: int | None = 2) -> Column:
    """``num / NULLIF(den, 0) * 100`` in double, optionally rounded (ANSI-safe)."""
    r = col_of(num).cast("double") / F.nullif(col_of(den), F.lit(0)) * 100
    return F.round(r, scale) if scale is not None else r


def wow_delta_pct(cur, prev, scale: int = 1) -> Column:
    """Week-over-week change in percent; NULL when there is no (or a zero) previous week."""
    cur, prev = col_of(cur), col_of(prev)
    return F.round((cur - F.coalesce(prev, cur)).cast("double") / F.nullif(prev, F.lit(0)) * 100, scale)


def sla_status(rate_pct) -> Column:
    """Alarm rate below the SLA limit is COMPLIANT; anything else, NULL included, is not."""
    return F.when(col_of(rate_pct) < F.lit(S.SLA_ALARM_RATE_PCT), F.lit("COMPLIANT")).otherwise(F.lit("NON-COMPLIANT"))


def threshold_breach(value="value_numeric", threshold="alert_threshold") -> Column:
    v, t = col_of(value), col_of(threshold)
    return F.when(t.isNotNull() & v.isNotNull(), v > t).otherwise(F.lit(False))


def quality_bad(quality="quality") -> Column:
    return col_of(quality) < F.lit(S.BAD_QUALITY)


def anomaly_score(breach="threshold_breach", bad="quality_bad") -> Column:
    return (F.when(col_of(breach), F.lit(S.SCORE_BREACH))
            .when(col_of(bad), F.lit(S.SCORE_BAD_QUALITY))
            .otherwise(F.lit(S.SCORE_NORMAL)))


def bucket_start(ts, unit: str) -> Column:
    """Start of the MINUTE / HOUR / DAY bucket holding ``ts`` (TIMESTAMP_NTZ in, NTZ out)."""
    return F.timestamp_add(unit, F.timestamp_diff(unit, epoch_ntz(), col_of(ts)), epoch_ntz())


def ntz(value: str) -> Column:
    """TIMESTAMP_NTZ literal from 'YYYY-MM-DD[ HH:MM:SS]'."""
    return F.lit(value if " " in value else value + " 00:00:00").cast("timestamp_ntz")


def round_numeric(c, scale: int) -> Column:
    """Round like a NUMERIC value: on the decimal value, half away from zero.

    For aggregates (averages, standard deviations) whose last binary digits depend on the
    summation order: the value is first normalised to 10 decimal places, so the result does
    not flip at an exact tie such as 20.5425 depending on how the partial sums were combined.
    Values beyond DECIMAL(38,10) fall back to a plain ``round``.
    """
    c = col_of(c)
    return F.coalesce(F.round(c.try_cast("decimal(38,10)"), scale).cast("double"), F.round(c, scale))


def json_field(c, path: str, cast: str | None = None) -> Column:
    """One field of a JSON text column (the ``metadata`` blob stays text until asked)."""
    v = F.get_json_object(col_of(c), path)
    return v.cast(cast) if cast else v
