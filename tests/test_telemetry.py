import json

import pytest
from pyspark.sql import functions as F

from siltstone.operators.aggregates import daily, device_summary, histogram, region_metric
from siltstone.operators.checks import apply_checks, has_errors, has_warnings
from siltstone.plans import telemetry
from siltstone.plans.telemetry import quarantined, silver
from siltstone.sources.readers import message_columns

OK = {"device_id": "SN-0001", "event_ts": "2026-07-28T01:02:03", "metric": "temperature", "value": 21.5, "unit": "C", "battery_pct": 80, "rssi": -60, "seq": 1000, "_inject_kind": "ok"}


def message(**changes):
    return json.dumps({**OK, **changes})


CASES = {
    "ok": (message(), None),
    "no device": (message(device_id=None), "null_device_id"),
    "too hot": (message(value=9999.0), "value_out_of_range"),
    "no value": (message(value=None), "value_out_of_range"),
    "unknown metric": (message(metric="pressure"), "value_out_of_range"),
    "negative battery": (message(battery_pct=-3), "negative_battery"),
    "no battery": (message(battery_pct=None), "null_rule_input"),
    "no metric": (message(metric=None), "null_rule_input"),
    "bad time": (message(event_ts="nope"), None),
    "wrong type": (message(value="hot"), "value_out_of_range"),
    "not JSON": ("{broken", "null_device_id"),
    "not there": (None, "null_device_id"),
}


@pytest.fixture
def raw(spark):
    data = [(None if text is None else text.encode(), 0, i) for i, (text, _) in enumerate(CASES.values())]
    log = spark.createDataFrame(data, "value binary, partition int, offset long")
    return message_columns(log.withColumn("timestamp", F.lit("2026-07-28 01:02:04").cast("timestamp")))


def test_every_message_goes_one_way(raw):
    got = {r["log_offset"]: r["quarantine_reason"] for r in telemetry.quarantined(raw).collect()}
    kept = {r["log_offset"] for r in telemetry.silver(raw).collect()}
    wanted = [reason for _, reason in CASES.values()]
    assert got == {i: reason for i, reason in enumerate(wanted) if reason}
    assert kept == {i for i, reason in enumerate(wanted) if reason is None}


def test_layouts(raw):
    fields = ["device_id", "event_ts", "metric", "value", "unit", "battery_pct", "rssi", "seq"]
    silver, bad = telemetry.silver(raw), telemetry.quarantined(raw)
    assert silver.columns == [*fields, "log_partition", "log_offset", "enqueued_ts"]
    assert dict(silver.dtypes)["event_ts"] == "timestamp" and dict(bad.dtypes)["event_ts"] == "string"
    assert bad.columns == [*fields, "_inject_kind", "raw_json", "log_partition", "log_offset", "quarantine_reason"]
    assert silver.where("event_ts IS NULL").count() == 1


def test_json_is_parsed_once(raw, capsys):
    telemetry.silver(raw).explain()
    plan = capsys.readouterr().out
    assert plan.count("from_json") == 1


def test_enriched_gold(spark, raw, rows):
    ref = spark.createDataFrame([("SN-0001", "m", "north", "s1", "active")], "device_id string, model string, region string, site string, status string")
    enriched = telemetry.enriched(telemetry.silver(raw), ref)
    assert enriched.columns == ["device_id", "event_ts", "metric", "value", "unit", "battery_pct", "rssi", "model", "region", "site", "device_status"]
    assert rows(region_metric(enriched)) == [("north", "temperature", 2, 21.5, 21.5, 21.5, 80.0, 1)]
    summary = device_summary(enriched).first()
    assert (summary["readings"], summary["avg_battery"], str(summary["last_event_ts"])) == (2, 80.0, "2026-07-28 01:02:03")
    assert rows(histogram(telemetry.quarantined(raw), "quarantine_reason")) == [
        ("negative_battery", 1), ("null_device_id", 3), ("null_rule_input", 2), ("value_out_of_range", 4),
    ]


def test_stored_checks_are_milder_on_battery(spark, raw):
    ref = spark.createDataFrame([("SN-0001",)], "device_id string")
    parsed = telemetry.parse_messages(raw).where("log_offset IN (0, 5)").withColumn("seq", F.col("log_offset"))
    got = apply_checks(parsed, telemetry.stored_checks(row_limit=100_000), {"device_reference": ref})
    assert got.where(has_errors()).count() == 0
    assert [r["log_offset"] for r in got.where(has_warnings()).collect()] == [5]


def test_injecting_twice_breaks_uniqueness(spark, raw):
    ref = spark.createDataFrame([("SN-0001",)], "device_id string")
    once = telemetry.parse_messages(raw).where("log_offset = 0")
    got = apply_checks(once.unionByName(once), telemetry.stored_checks(row_limit=100_000), {"device_reference": ref})
    assert [[d["name"] for d in r["_errors"]] for r in got.collect()] == [["seq_unique"]] * 2


def test_daily_vitals(spark, rows):
    data = [("P001", "2026-07-01 09:00:00", 72, 120), ("P001", "2026-07-01 19:00:00", 75, 122), ("P002", "2026-07-02 09:00:00", 68, 118)]
    vitals = spark.createDataFrame(data, "patient_id string, measured_at string, heart_rate int, systolic int")
    measures = {"avg_hr": F.round(F.avg("heart_rate"), 1), "max_sys": F.max("systolic")}
    got = daily(vitals.withColumn("measured_at", F.col("measured_at").cast("timestamp")), ["patient_id"], "measured_at", measures)
    assert [(r[0], str(r[1]), r[2], r[3]) for r in got.orderBy("patient_id").collect()] == [
        ("P001", "2026-07-01", 73.5, 122), ("P002", "2026-07-02", 68.0, 118),
    ]


def test_one_run_stores_both_outcomes(spark, tmp_path, rows):
    """Silver and quarantine from one pass, with the reasons and texts of the batch functions; a batch again replaces itself."""
    from siltstone.plans.telemetry import read_telemetry, run_telemetry
    from siltstone.sources.readers import stream_table

    texts = [
        '{"device_id":"SN-1","event_ts":"2024-01-01T00:00:00","metric":"co2","value":400.5,"unit":"ppm","battery_pct":50,"rssi":-40,"seq":1,"_inject_kind":"none"}',
        '{"device_id":"SN-2","event_ts":"2024-01-01T00:00:05","metric":"co2","value":9000,"battery_pct":50,"seq":2}',
        '{"event_ts":"no time","metric":"co2","value":400,"battery_pct":50,"seq":3}',
        '{"device_id":"SN-1","event_ts":"2024-01-01T00:01:00","metric":"humidity","value":4,"battery_pct":-1,"seq":4,"_inject_kind":"battery"}',
        "no json at all",
        '{"device_id":"SN-3","event_ts":"2024-01-02T00:00:00","metric":"humidity","value":40,"battery_pct":9,"seq":5}',
    ]
    schema = "raw_json string, log_partition int, log_offset bigint, enqueued_ts timestamp"
    log = spark.createDataFrame([(t, 0, i) for i, t in enumerate(texts)], "raw_json string, log_partition int, log_offset bigint")
    log = log.withColumn("enqueued_ts", F.timestamp_seconds(F.col("log_offset") + 1_700_000_000))
    landing, root = str(tmp_path / "log"), str(tmp_path / "tables")
    taken = []
    for part in (log.where("log_offset < 3"), log.where("log_offset >= 3")):
        part.coalesce(1).write.mode("append").parquet(landing)
        taken.append(run_telemetry(stream_table(spark, landing, schema), root))
    assert taken == [3, 3]
    (tmp_path / "tables" / "checkpoint" / "commits" / "1").unlink()
    (tmp_path / "tables" / "checkpoint" / "commits" / ".1.crc").unlink(missing_ok=True)
    run_telemetry(stream_table(spark, landing, schema), root)
    reference = spark.createDataFrame([("SN-1", "m", "north", "s", "active")], "device_id string, model string, region string, site string, status string")
    tables = read_telemetry(spark, root, reference)
    assert rows(tables["silver"]) == rows(silver(log)) and tables["silver"].columns == silver(log).columns
    assert rows(tables["quarantine"]) == rows(quarantined(log)) and tables["quarantine"].columns == quarantined(log).columns
    assert {(r.seq, r.quarantine_reason) for r in tables["quarantine"].collect()} == {
        (2, "value_out_of_range"), (3, "null_device_id"), (4, "negative_battery"), (None, "null_device_id")
    }
    assert {(r.device_id, r.region) for r in tables["gold_device_summary"].collect()} == {("SN-1", "north"), ("SN-3", None)}
    assert {r.region for r in tables["gold_region_metric"].collect()} == {"north", None}
