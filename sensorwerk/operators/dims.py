"""Dimensions and dimension joins: calendar generator (DIM-1), surrogate-key lookup (J-7),
as-of join to versioned dimensions (J-8) and referential-integrity report (J-9)."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorwerk.config import bounded_broadcast
from sensorwerk.functions.columns import date_sk

# ---- fixed values: fixed-date public holidays (MM-dd) of the plants' calendar --------------
HOLIDAYS_MM_DD = ("01-01", "05-01", "05-08", "07-14", "08-15", "11-01", "11-11", "12-25")
# ---------------------------------------------------------------------------------------------

UNKNOWN_SK = -1


def calendar_between(bounds: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Calendar rows for every day in [lo, hi] of a one-row ``bounds`` frame."""
    days = bounds.select(F.explode(F.sequence(F.col(lo), F.col(hi))).alias("full_date"))
    d = F.col("full_date")
    dow = (F.weekday(d) + 1)  # Monday = 1 ... Sunday = 7
    return days.select(
        date_sk(d).alias("date_sk"),
        d,
        F.year(d).cast("smallint").alias("year"),
        F.quarter(d).cast("smallint").alias("quarter"),
        F.month(d).cast("smallint").alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).cast("smallint").alias("week_of_year"),
        F.dayofmonth(d).cast("smallint").alias("day_of_month"),
        dow.cast("smallint").alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        (dow >= 6).alias("is_weekend"),
        F.date_format(d, "MM-dd").isin(*HOLIDAYS_MM_DD).alias("is_holiday"),
        F.concat(F.lit("FY"), F.date_format(d, "yy"), F.lit("-Q"), F.quarter(d).cast("string")).alias("fiscal_period"),
    )


def calendar_for(df: DataFrame, ts: str = "event_ts") -> DataFrame:
    """Calendar covering the days present in ``df`` (bounds from one global aggregate)."""
    bounds = df.agg(F.min(F.to_date(ts)).alias("lo"), F.max(F.to_date(ts)).alias("hi"))
    return calendar_between(bounds)


def lookup_keys(df: DataFrame, devices: DataFrame, plants: DataFrame, device_col: str = "device_id",
                plant_col: str = "plant_id", ts: str = "event_ts") -> DataFrame:
    """Natural ids -> surrogate keys; unknown members get -1 (J-7).

    The plant dimension is bounded (one row per plant) and is broadcast after a size check;
    the device dimension grows with the fleet, so its join is left to the planner / AQE.
    ``devices`` must hold one current row per device id.
    """
    d = devices.select(F.col("device_id").alias(device_col), F.col("device_sk"))
    p = plants.select(F.col("plant_id").alias(plant_col), F.col("plant_sk"))
    out = df.join(d, device_col, "left").join(bounded_broadcast(p), plant_col, "left")
    return out.withColumns({
        "device_sk": F.coalesce(F.col("device_sk"), F.lit(UNKNOWN_SK).cast("bigint")),
        "plant_sk": F.coalesce(F.col("plant_sk"), F.lit(UNKNOWN_SK).cast("bigint")),
        "date_sk": date_sk(ts),
    })


def asof_join(df: DataFrame, versions: DataFrame, key: str = "device_id", ts: str = "event_ts",
              valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """Left join each event to the dimension version valid at its time (J-8).

    The equality on ``key`` keeps this a hash / sort-merge join (no nested loop); the range
    is a residual condition evaluated per matching key. ``valid_to`` NULL means current.
    """
    v = versions.withColumnRenamed(key, "_vkey")
    cond = ((df[key] == v["_vkey"]) & (df[ts] >= v[valid_from])
            & (v[valid_to].isNull() | (df[ts] < v[valid_to])))
    return df.join(v, cond, "left").drop("_vkey")


def asof_carry(df: DataFrame, versions: DataFrame, key: str = "device_id", ts: str = "event_ts", valid_from: str = "valid_from",
               valid_to: str = "valid_to", bucket: str = "DAY") -> DataFrame:
    """:func:`asof_join` by carrying versions forward instead of meeting every version (J-8).

    Events and version starts of a key and day are sorted together, and each event takes the last
    start before or at its time, so the cost is events + versions however many versions a key has.
    A day begins with the version in force at its start, found from the versions and the days that
    have events alone; sorting by key and day spreads a key with many events. For versions that do not
    overlap (the latest start wins otherwise); of equal starts the later end wins, an open one first.
    Events without a key or time get no version.
    """
    columns = [c for c in versions.columns if c != key]
    begin, end = F.col(valid_from), F.col(valid_to)
    packed = versions.where(F.col(key).isNotNull() & begin.isNotNull()).groupBy(F.col(key).alias("_key"), begin.alias("_ts")).agg(
        F.max_by(F.struct(*columns), F.struct(end.isNull().alias("open"), end.alias("end"))).alias("_version"))
    day = F.date_trunc(bucket, F.col("_ts")).cast("timestamp_ntz")
    starts = packed.withColumn("_day", day)
    able = F.col(key).isNotNull() & F.col(ts).isNotNull()
    events = df.where(able).select(F.struct(*df.columns).alias("_event"), F.col(key).alias("_key"), F.col(ts).alias("_ts")).withColumn("_day", day)
    version_type = starts.schema["_version"].dataType

    # the version in force when a day with events begins
    days = events.groupBy("_key", "_day").agg(F.lit(None).cast(version_type).alias("_version")).withColumn("_ts", F.col("_day"))
    earlier = Window.partitionBy("_key").orderBy("_ts", F.col("_version").isNull()).rowsBetween(Window.unboundedPreceding, -1)
    carried = starts.select("_key", "_ts", "_day", "_version").unionByName(days.select("_key", "_ts", "_day", "_version"))
    carried = carried.withColumn("_held", F.last("_version", ignorenulls=True).over(earlier)).where("_version IS NULL AND _held IS NOT NULL")

    none = F.lit(None).cast(events.schema["_event"].dataType).alias("_event")
    rows = (starts.select("_key", "_day", "_ts", F.lit(1).alias("_kind"), "_version", none)
            .unionByName(carried.select("_key", "_day", "_ts", F.lit(0).alias("_kind"), F.col("_held").alias("_version"), none))
            .unionByName(events.select("_key", "_day", "_ts", F.lit(2).alias("_kind"), F.lit(None).cast(version_type).alias("_version"), "_event")))
    so_far = Window.partitionBy("_key", "_day").orderBy("_ts", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.withColumn("_found", F.last("_version", ignorenulls=True).over(so_far)).where("_kind = 2")
    in_force = F.col(f"_found.{valid_to}").isNull() | (F.col("_ts") < F.col(f"_found.{valid_to}"))
    got = found.select("_event.*", *[F.when(in_force, F.col(f"_found.{c}")).alias(c) for c in columns])
    others = df.where(~able).select(*df.columns, *[F.lit(None).cast(versions.schema[c].dataType).alias(c) for c in columns])
    return got.unionByName(others)


def orphan_report(checks: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Rows and distinct keys of each foreign key with no parent row (J-9).

    ``checks``: (name, fact, fact column, parent, parent column). A fact is read once for all its keys: they are
    counted by grouping sets, each on its own type, in one aggregate that is partial before its shuffle (a hot
    key never ships its rows). The distinct values meet all their parents in one anti-join, told apart by the
    check's number. NULL keys are not orphans (SQL semantics). Every check gets a row.
    """
    facts: dict[tuple[int, int], list[tuple[int, str, DataFrame, str]]] = {}
    frames = {}
    for no, (_, fact, column, parent, parent_column) in enumerate(checks):
        again = 0                                        # a column that is checked twice is counted twice
        while any(c == column for _, c, _, _ in facts.get((id(fact), again), [])):
            again += 1
        facts.setdefault((id(fact), again), []).append((no, column, parent, parent_column))
        frames[id(fact)] = fact
    lost = []
    for (which, _), items in facts.items():
        fact, columns = frames[which], [c for _, c, _, _ in items]
        types = {c: fact.schema[c].dataType for c in columns}
        number = reduce(lambda rest, i: F.when(F.grouping(i[1]) == 0, F.lit(i[0])).otherwise(rest), items, F.lit(-1))
        used = fact.groupingSets([[c] for c in columns], *columns).agg(F.count(F.lit(1)).alias("rows"), number.alias("check"))
        used = used.where(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in columns]))
        held = reduce(DataFrame.unionByName, [
            parent.select(F.lit(no).alias("of"), *[(F.col(parent_column) if c == column else F.lit(None)).cast(types[c]).alias(f"_{c}") for c in columns])
            for no, column, parent, parent_column in items])
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns], F.col("check") == F.col("of"))
        lost.append(used.join(held, same, "left_anti").groupBy("check").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("keys")))
    names = F.array(*[F.lit(name) for name, *_ in checks])
    every = checks[0][1].sparkSession.range(len(checks)).select(F.col("id").cast("int").alias("no"), F.element_at(names, (F.col("id") + 1).cast("int")).alias("fk_name"))
    found = reduce(DataFrame.unionByName, lost)
    return every.join(found, F.col("no") == F.col("check"), "left").select(
        "fk_name", F.coalesce("rows", F.lit(0).cast("long")).alias("orphan_rows"), F.coalesce("keys", F.lit(0).cast("long")).alias("orphan_keys"))
