"""Keep-latest semantics: ties, NULL keys, preferring valid rows, and a hot key."""
from pyspark.sql import functions as F

from sensorwerk.operators.dedup import keep_latest


def test_latest_with_tie_breaker(spark):
    df = spark.createDataFrame(
        [("a", 1, 0, "x"), ("a", 2, 0, "y"), ("a", 2, 1, "z"), ("b", 5, 0, "w")],
        "event_id string, ts long, resend int, payload string")
    out = {r.event_id: r for r in keep_latest(df, "event_id", ["ts", "resend"], copies_col="n").collect()}
    assert out["a"].payload == "z" and out["a"].n == 3
    assert out["b"].payload == "w" and out["b"].n == 1


def test_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "event_id string, ts long")
    assert keep_latest(df, "event_id", ["ts"], null_keys="keep").count() == 3
    assert keep_latest(df, "event_id", ["ts"]).count() == 2


def test_prefer_valid(spark):
    df = spark.createDataFrame([("a", 1, True), ("a", 2, False)], "event_id string, ts long, ok boolean")
    assert keep_latest(df, "event_id", ["ts"]).collect()[0].ok is False
    assert keep_latest(df, "event_id", ["ok", "ts"]).collect()[0].ok is True


def test_hot_key(spark):
    """A third of the rows share one key: still one survivor, the latest."""
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("event_id"),
        F.col("id").alias("ts"))
    out = keep_latest(df, "event_id", ["ts"], copies_col="n")
    hot = out.filter(F.col("event_id") == "hot").collect()
    assert len(hot) == 1 and hot[0].ts == n - 3 and hot[0].n == n // 3
    assert out.count() == n - n // 3 + 1
