"""Streaming runs over the given tables, read back as batches."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.functions.means import stable_mean
from siltstone.functions.names import BATCH
from siltstone.operators.aggregates import region_metric
from siltstone.operators.eventlog import recorded_metrics
from siltstone.operators.joins import enrich
from siltstone.plans import telemetry
from siltstone.session import fresh_path
from siltstone.sources.readers import message_columns, stream_table
from siltstone.sources.writers import write_table
from siltstone.streaming.enrich import run_enriched
from siltstone.streaming.ingest import (
    full_refresh,
    read_quarantine,
    read_silver,
    run_incremental,
    silver_and_quarantine,
)
from siltstone.streaming.keyindex import run_unique
from siltstone.streaming.states import Gold, read_gold, run_gold
from siltstone.workloads.enrichment import MESSAGES_SQL, PASS_SQL, QUARANTINE_SQL, USERS_SQL, messages, users
from siltstone.workloads.layers import ALL_EVENT_RULES, BROKEN_EVENT, EVENT_RULES
from siltstone.workloads.registry import mean_sql, query, stream_of, table


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_of(spark, sf_dir, "events")


@query("streaming_events", "SELECT * FROM events")
def streaming_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the same source: the second finds nothing new."""
    root = fresh_path(spark, "stream")
    for _ in range(2):
        run_incremental(event_stream(spark, sf_dir), f"{root}/data", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/data")


@query("streaming_refresh", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def streaming_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"siltstone_events_{uuid.uuid4().hex}"
    full_refresh(spark, event_stream(spark, sf_dir), "refresh", name)
    return spark.table(name).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def _split(spark: SparkSession, sf_dir: str) -> str:
    root = fresh_path(spark, "split")
    silver_and_quarantine(event_stream(spark, sf_dir), EVENT_RULES, f"{root}/data", f"{root}/checkpoint")
    return f"{root}/data"


@query("streaming_silver", f"SELECT * FROM events WHERE {ALL_EVENT_RULES}")
def streaming_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_silver(spark, _split(spark, sf_dir), table(spark, sf_dir, "events").schema)


_ADDED_SQL = "event_id, value, event_type AS verdict, event_id % 7 AS batch_id, user_id AS run_id, event_type AS gold"


@query("split_keeps_columns", f"SELECT {_ADDED_SQL}, ({ALL_EVENT_RULES}) IS TRUE AS passed FROM events")
def split_keeps_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns with everyday names go through the split, both ways."""
    root = fresh_path(spark, "split-columns")
    events = event_stream(spark, sf_dir)
    added = {"verdict": F.col("event_type"), "batch_id": F.col("event_id") % 7, "run_id": F.col("user_id"), "gold": F.col("event_type")}
    stream = events.withColumns(added)
    silver_and_quarantine(stream, EVENT_RULES, f"{root}/data", f"{root}/checkpoint")
    silver, broken = (f(spark, f"{root}/data", stream.schema) for f in (read_silver, read_quarantine))
    both = silver.withColumn("passed", F.lit(True)).unionByName(broken.withColumn("passed", F.lit(False)))
    return both.select("event_id", "value", *added, "passed")


@query(
    "run_write_metrics",
    "SELECT 1 AS run, count(*) AS input_rows, count(*) FILTER (value > 50) AS written_rows, 1 AS batches FROM events WHERE event_id % 3 = 0 "
    "UNION ALL SELECT 2, count(*), count(*) FILTER (value > 50), 1 FROM events WHERE event_id % 3 <> 0",
)
def run_write_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of an ingest that keeps some of the new rows; their record is read back."""
    root = fresh_path(spark, "recorded")
    events = table(spark, sf_dir, "events")
    for part in ("event_id % 3 = 0", "event_id % 3 <> 0"):
        events.where(part).write.mode("append").parquet(f"{root}/landing")
        stream = stream_table(spark, f"{root}/landing", events.schema)
        run_incremental(stream.where("value > 50"), f"{root}/data", f"{root}/checkpoint", record=f"{root}/record")
    # a handful of runs, so one window over all of them is small
    number = F.row_number().over(Window.orderBy("started_at"))
    return recorded_metrics(spark, f"{root}/record").select(number.alias("run"), "input_rows", "written_rows", F.col("batches").cast("int").alias("batches"))


@query("streaming_quarantine", f"SELECT * FROM events WHERE {BROKEN_EVENT}")
def streaming_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_quarantine(spark, _split(spark, sf_dir), table(spark, sf_dir, "events").schema)


_ENRICHED_SQL = (
    "SELECT event_id, e.user_id, event_type, value, model, region, status AS device_status FROM events e "
    f"LEFT JOIN (SELECT * FROM {USERS_SQL} WHERE model = 'BUILDING') b ON e.user_id = b.user_id"
)


@query("streaming_enriched_fresh", _ENRICHED_SQL)
def streaming_enriched_fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference is read again for every batch."""
    root = fresh_path(spark, "enriched-fresh")
    run_enriched(
        event_stream(spark, sf_dir).select("event_id", "user_id", "event_type", "value"),
        lambda: users(spark, sf_dir, "BUILDING"),
        ["user_id"],
        ["model", "region", "status"],
        {"status": "device_status"},
        f"{root}/data",
        f"{root}/checkpoint",
    )
    return spark.read.parquet(f"{root}/data").drop(BATCH)


@query("streaming_enriched", _ENRICHED_SQL)
def streaming_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_path(spark, "enriched")
    facts = event_stream(spark, sf_dir).select("event_id", "user_id", "event_type", "value")
    dims = users(spark, sf_dir, "BUILDING")
    joined = enrich(facts, dims, ["user_id"], ["model", "region", "status"], {"status": "device_status"})
    run_incremental(joined, f"{root}/data", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/data")


def _devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users(spark, sf_dir).select(
        F.concat(F.lit("SN-"), F.col("user_id").cast("string")).alias("device_id"),
        "model",
        "region",
        F.col("nation").alias("site"),
        "status",
    )


@query(
    "streaming_telemetry_gold",
    f"SELECT region, metric, count(*) AS readings, {mean_sql('value', 2)} AS avg_value, min(value) AS min_value, "
    f"max(value) AS max_value, {mean_sql('battery_pct', 1)} AS avg_battery, count(DISTINCT m.device_id) AS active_devices "
    f"FROM (SELECT * FROM {MESSAGES_SQL} WHERE {PASS_SQL}) m LEFT JOIN (SELECT 'SN-' || CAST(user_id AS VARCHAR) AS "
    f"device_id, region FROM {USERS_SQL}) d ON m.device_id = d.device_id GROUP BY 1, 2",
)
def streaming_telemetry_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message log, parsed and enriched as a stream, summarised as a batch."""
    root = fresh_path(spark, "telemetry")
    log = messages(spark, sf_dir)
    stored = stream_table(spark, write_table(log, f"{root}/log"), log.schema)
    silver = telemetry.silver(message_columns(stored))
    run_incremental(telemetry.enriched(silver, _devices(spark, sf_dir)), f"{root}/silver", f"{root}/checkpoint")
    return region_metric(spark.read.parquet(f"{root}/silver"), mean=stable_mean)


def _telemetry(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Everything that two runs make of the message log, each of which finds half of it."""
    root, log = fresh_path(spark, "telemetry-run"), messages(spark, sf_dir)
    for part in range(2):
        log.where(F.col("offset") % 2 == part).write.mode("append").parquet(f"{root}/log")
        telemetry.run_telemetry(message_columns(stream_table(spark, f"{root}/log", log.schema)), f"{root}/tables")
    return telemetry.read_telemetry(spark, f"{root}/tables", _devices(spark, sf_dir), stable_mean)


@query("streaming_telemetry_quarantine", QUARANTINE_SQL)
def streaming_telemetry_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored by the same pass as silver, with the reason and the text as it came."""
    return _telemetry(spark, sf_dir)["quarantine"]


_SILVER_SQL = (
    f"(SELECT m.*, d.model, d.region, d.status FROM (SELECT * FROM {MESSAGES_SQL} WHERE {PASS_SQL}) m "
    f"LEFT JOIN (SELECT 'SN-' || CAST(user_id AS VARCHAR) AS device_id, model, region, status FROM {USERS_SQL}) d ON m.device_id = d.device_id) s"
)


@query(
    "streaming_device_summary",
    f"SELECT device_id, model, region, status AS device_status, count(*) AS readings, {mean_sql('battery_pct', 1)} AS avg_battery, "
    f"strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_event_ts FROM {_SILVER_SQL} GROUP BY 1, 2, 3, 4",
)
def streaming_device_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _telemetry(spark, sf_dir)["gold_device_summary"]
    return found.withColumn("last_event_ts", F.date_format("last_event_ts", "yyyy-MM-dd HH:mm:ss"))


@query(
    "telemetry_update_counts",
    f"SELECT 'silver' AS dataset, count(*) AS n FROM {_SILVER_SQL} UNION ALL SELECT 'enriched', count(*) FROM {_SILVER_SQL} "
    f"UNION ALL SELECT 'quarantine', count(*) FROM {MESSAGES_SQL} WHERE NOT coalesce({PASS_SQL}, false) "
    f"UNION ALL SELECT 'gold_region_metric', count(*) FROM (SELECT DISTINCT region, metric FROM {_SILVER_SQL}) "
    f"UNION ALL SELECT 'gold_device_summary', count(*) FROM (SELECT DISTINCT device_id, model, region, status FROM {_SILVER_SQL})",
)
def telemetry_update_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("dataset"), "n") for name, df in _telemetry(spark, sf_dir).items()]
    return reduce(DataFrame.unionByName, counted)


GOLD = Gold(
    {"event_type": "event_type", "d": "to_date(ts)"},
    {
        "n": ("count", "*"),
        "cents": ("sum", "CAST(round(value * 100) AS BIGINT)"),
        "mean_cents": ("mean", "CAST(round(value * 100) AS BIGINT)"),
        "low": ("min", "value"),
        "high": ("max", "value"),
        "users": ("distinct", "user_id"),
        "props_seen": ("distinct", "props"),
    },
)


@query(
    "gold_incremental",
    "SELECT event_type, CAST(ts AS DATE) AS d, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents, "
    "sum(CAST(round(value * 100) AS BIGINT))::DOUBLE / count(value) AS mean_cents, min(value) AS low, max(value) AS high, "
    "count(DISTINCT user_id) AS users, count(DISTINCT props) AS props_seen FROM events GROUP BY 1, 2",
)
def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs, each over a third of the events, of which the later ones read new rows and states only."""
    root = fresh_path(spark, "gold-states")
    events = table(spark, sf_dir, "events")
    for part in range(3):
        events.where(F.col("event_id") % 3 == part).write.mode("append").parquet(f"{root}/landing")
        run_gold(spark, stream_table(spark, f"{root}/landing", events.schema), GOLD, f"{root}/states")
    return read_gold(spark, events.schema, GOLD, f"{root}/states")


@query("unique_incremental", "SELECT o_custkey, o_orderpriority, count(*) AS \"rows\" FROM orders GROUP BY 1, 2 HAVING count(*) > 1")
def unique_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that occur again, from three runs that each check only their own rows against the index."""
    root = fresh_path(spark, "key-index")
    orders = table(spark, sf_dir, "orders")
    for part in range(3):
        orders.where(F.col("o_orderkey") % 3 == part).write.mode("append").parquet(f"{root}/landing")
        index = run_unique(spark, stream_table(spark, f"{root}/landing", orders.schema), ["o_custkey", "o_orderpriority"], root)
    return index.repeated()
