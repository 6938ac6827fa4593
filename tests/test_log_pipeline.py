"""Raw JSON logs: corrupt rows, typing defects, routing of NULL rule results, and the
end-to-end job with its accounting identity."""
import json
import os

from pyspark.sql import functions as F

from sensorwerk import schemas as S
from sensorwerk.operators import quality
from sensorwerk.plans.jobs import run_log_job
from sensorwerk.sources.raw import read_raw_logs

BASE = {"machine_id": "M-1", "plant_code": "PLANT-01", "event_type": "START",
        "event_timestamp": 1704067200000, "severity": "INFO", "temperature_c": 20.5}


def _line(**kw):
    d = dict(BASE)
    d.update(kw)
    return json.dumps(d)


def write_lines(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


LOGS_JSON = [
    _line(event_id="A"),                                   # valid
    '{"event_id": "B", "machine_id": "M-1", "plant_co',    # truncated JSON
    _line(event_id="C", event_timestamp="abc"),            # wrong-typed long
    _line(event_id="D", cycle_count=95.5),                 # float in a long field
    json.dumps({**{k: v for k, v in BASE.items() if k != "event_type"}, "event_id": "E"}),  # missing key
    _line(event_id="F", event_type=None),                  # explicit null key
    '{"event_id": "G", "machine_id": "M-1", "plant_code": "PLANT-01", "event_type": "START", '
    '"event_timestamp": 1704067200000, "temperature_c": NaN}',   # NaN temperature
]


def test_corrupt_and_typing(spark, scratch):
    write_lines(scratch, "a.json", LOGS_JSON)
    raw = read_raw_logs(spark, scratch).cache()
    rows = {r.event_id: r for r in raw.collect()}
    assert rows["A"][S.CORRUPT_COL] is None
    corrupt = [r for r in raw.collect() if r[S.CORRUPT_COL] is not None]
    assert len(corrupt) == 3                               # truncated, "abc" long, 95.5 long
    assert rows["C"].event_timestamp is None and rows["C"].machine_id == "M-1"   # other fields kept
    assert rows["E"][S.CORRUPT_COL] is None and rows["E"].event_type is None      # missing key -> NULL
    good, bad = quality.split_corrupt(raw)
    assert good.count() + bad.count() == raw.count()
    assert S.CORRUPT_COL not in good.columns


def test_null_rule_result_routed_to_failures(spark, scratch):
    write_lines(scratch, "a.json", LOGS_JSON)
    good, _ = quality.split_corrupt(read_raw_logs(spark, scratch).cache())
    flagged = quality.with_dq_flags(good).cache()
    by_id = {r.event_id: r for r in flagged.collect()}
    assert by_id["E"].dq_pass is None and by_id["E"].dq_pass_strict is False
    assert by_id["E"].dq_reason == "event_type"
    assert by_id["G"].temp_valid is False                  # NaN is outside the range
    clean, failed = quality.route(flagged)
    assert clean.count() + failed.count() == flagged.count()
    ref_clean, ref_failed = quality.route(flagged, strict=False)
    assert ref_clean.count() + ref_failed.count() < flagged.count()   # the reference loses NULL rows


def test_log_job_end_to_end(spark, scratch):
    src = os.path.join(scratch, "raw")
    lines = list(LOGS_JSON)
    # re-sent copies of A: an older one and a newer invalid one
    lines.append(_line(event_id="A", event_timestamp=1704067100000))
    lines.append(_line(event_id="H", severity="FATAL"))
    lines.append(_line(event_id=None))                 # two id-less records: failures, not merged
    lines.append(_line(event_id=None, event_timestamp=1704067300000))
    write_lines(src, "a.json", lines)
    res = run_log_job(spark, src, os.path.join(scratch, "out"), os.path.join(scratch, "q"),
                      os.path.join(scratch, "dq"), metrics_path=os.path.join(scratch, "m"),
                      run_id="run-1", run_ts="2024-02-01 00:00:00")
    m = res.metrics
    assert m["total_raw"] == len(lines)
    assert m["corrupt_records"] == 3
    # accounting identity: raw = corrupt + duplicates removed + clean + failing
    assert m["total_raw"] == m["corrupt_records"] + m["duplicates_removed"] + m["written"] + m["dq_failed"]
    assert m["duplicates_removed"] == 1
    out = spark.read.parquet(os.path.join(scratch, "out"))
    assert "dq_pass" not in out.columns and "year" in out.columns and "plant_code" in out.columns
    assert out.count() == m["written"]
    q = spark.read.json(os.path.join(scratch, "q"))
    assert q.filter(F.col("job_run") == "run-1").count() == 3
    dq = spark.read.parquet(os.path.join(scratch, "dq"))
    assert dq.count() == m["dq_failed"] and "dq_reason" in dq.columns
    assert dq.filter(F.col("event_id").isNull() & (F.col("dq_reason") == "event_id")).count() == 2
    assert spark.read.json(os.path.join(scratch, "m")).count() == 1
