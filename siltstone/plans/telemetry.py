"""Device telemetry: messages to silver, quarantine and enriched rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltstone.functions.casts import iso_timestamp, struct_of
from siltstone.functions.means import rounded_mean
from siltstone.functions.names import BATCH, RESERVED, VERDICT
from siltstone.functions.text import open_json
from siltstone.functions.rules import first_reason, range_arms, range_rule
from siltstone.operators.aggregates import Mean, device_summary, region_metric
from siltstone.operators.joins import enrich
from siltstone.operators.quality import BROKEN, PASSED, expect_or_drop, quarantine, with_reason, with_verdict
from siltstone.streaming.ingest import run_batches

# Message layout, allowed range per metric, rules and reasons.
MESSAGE = (
    "device_id string, event_ts string, metric string, value double, unit string, "
    "battery_pct int, rssi int, seq bigint, _inject_kind string"
)
METRIC_RANGES = {
    "temperature": (-50, 100),
    "humidity": (0, 100),
    "co2": (300, 5000),
    "vibration": (0, 100),
}
RANGE = range_rule("metric", "value", METRIC_RANGES)
RULES = {
    "valid_device_id": "device_id IS NOT NULL",
    "value_in_metric_range": RANGE,
    "battery_non_negative": "battery_pct >= 0",
}
REASONS = (
    ("device_id IS NULL", "null_device_id"),
    (f"NOT ({RANGE})", "value_out_of_range"),
    ("battery_pct < 0", "negative_battery"),
)
LOG_COLUMNS = ("log_partition", "log_offset", "enqueued_ts")


def open_messages(raw: DataFrame, schema: str | StructType = MESSAGE, keep: Sequence[str] = LOG_COLUMNS) -> DataFrame:
    """JSON text to columns, all values as sent; unreadable text gives NULLs."""
    return open_json(raw, "raw_json", schema, keep)


def parse_messages(
    raw: DataFrame,
    schema: str | StructType = MESSAGE,
    ts_col: str = "event_ts",
    drop: Sequence[str] = ("_inject_kind",),
    keep: Sequence[str] = LOG_COLUMNS,
) -> DataFrame:
    """Messages as typed rows; works on batches and streams."""
    return open_messages(raw, schema, keep).withColumn(ts_col, iso_timestamp(ts_col)).drop(*drop)


def silver(raw: DataFrame) -> DataFrame:
    return expect_or_drop(parse_messages(raw), RULES)


def quarantined(raw: DataFrame) -> DataFrame:
    """Broken messages with the reason, values as sent, and the text they came from."""
    opened = open_messages(raw, keep=("raw_json", "log_partition", "log_offset"))
    return with_reason(quarantine(opened, RULES), REASONS)


def enriched(silver_df: DataFrame, reference: DataFrame) -> DataFrame:
    """Silver rows with what the reference knows of their device."""
    facts = silver_df.select("device_id", "event_ts", "metric", "value", "unit", "battery_pct", "rssi")
    return enrich(
        facts, reference, ["device_id"], ["model", "region", "site", "status"], {"status": "device_status"}
    )


REASON = "quarantine_reason"
_SENT = f"{RESERVED}ts_as_sent"


def run_telemetry(stream: DataFrame, root: str) -> int:
    """Takes in the messages of a raw ``stream`` not seen before; returns how many.

    Each is opened once and stored once below ``root``: judged, with its reason if it is broken, its time both typed
    and as sent, and its text.  Silver and quarantine are two layouts of that table.  A batch that runs again
    replaces itself.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        opened = open_messages(batch, keep=("raw_json", *LOG_COLUMNS))
        judged = with_verdict(opened, RULES).withColumn(REASON, F.when(F.col(VERDICT) == BROKEN, first_reason(REASONS)))
        typed = judged.withColumn(_SENT, F.col("event_ts")).withColumn("event_ts", iso_timestamp("event_ts"))
        broken_text = F.when(F.col(VERDICT) == BROKEN, F.col("raw_json"))  # silver rows do without it
        typed.withColumn("raw_json", broken_text).write.mode("overwrite").partitionBy(VERDICT).parquet(f"{root}/messages/{BATCH}={batch_id}")

    return run_batches(stream, f"{root}/checkpoint", write)


def read_telemetry(spark: SparkSession, root: str, reference: DataFrame, mean: Mean = rounded_mean) -> dict[str, DataFrame]:
    """What the runs below ``root`` make up: silver, quarantine, enriched, gold_region_metric, gold_device_summary."""
    names = struct_of(MESSAGE).names
    stored = spark.read.parquet(f"{root}/messages")
    passed, broken = (stored.where(F.col(VERDICT) == v) for v in (PASSED, BROKEN))
    sent = [F.col(_SENT).alias(n) if n == "event_ts" else F.col(n) for n in names]
    tables = {
        "silver": passed.select(*(n for n in names if n != "_inject_kind"), *LOG_COLUMNS),
        "quarantine": broken.select(*sent, "raw_json", "log_partition", "log_offset", REASON),
    }
    tables["enriched"] = enriched(tables["silver"], reference)
    tables["gold_region_metric"] = region_metric(tables["enriched"], mean=mean)
    tables["gold_device_summary"] = device_summary(tables["enriched"], mean=mean)
    return tables


def stored_checks(reference_table: str = "device_reference", *, row_limit: int) -> list[dict]:
    """The checks run on stored telemetry; a table of more than ``row_limit`` rows is in error as a whole."""
    return [
        _check("device_id_not_null", "error", "is_not_null", column="device_id"),
        _check(
            "value_in_metric_range",
            "error",
            "sql_expression",
            expression=range_arms("metric", "value", METRIC_RANGES),
            msg="value out of physical range for metric",
        ),
        _check("battery_healthy", "warn", "is_in_range", column="battery_pct", min_limit=0, max_limit=100),
        _check("signal_ok", "warn", "is_not_less_than", column="rssi", limit=-100),
        _check("event_ts_not_in_future", "warn", "is_not_in_future", column="event_ts", offset=0),
        _check("seq_unique", "error", "is_unique", columns=["seq"]),
        _check(
            "device_in_reference",
            "error",
            "foreign_key",
            columns=["device_id"],
            ref_columns=["device_id"],
            ref_table=reference_table,
        ),
        _check(
            "rowcount_guard", "error", "is_aggr_not_greater_than", column="*", aggr_type="count", limit=row_limit
        ),
    ]


def _check(name: str, criticality: str, function: str, **arguments) -> dict:
    return {"name": name, "criticality": criticality, "check": {"function": function, "arguments": arguments}}
