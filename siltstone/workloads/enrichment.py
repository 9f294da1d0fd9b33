"""Messages, enrichment and the gold tables over enriched rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.means import stable_mean
from siltstone.operators.aggregates import (
    daily,
    device_summary,
    group_summary,
    metric_histogram,
    region_metric,
    totals,
)
from siltstone.operators.asof import enrich_as_of
from siltstone.operators.cdc import END, START, scd2
from siltstone.operators.joins import enrich, known, readings_by, unknown
from siltstone.operators.ordering import deep_page, page, top_k
from siltstone.operators.skew import skew_left_join
from siltstone.plans import telemetry
from siltstone.sources.readers import message_columns
from siltstone.workloads.registry import mean_sql, query, table

# Events dressed as device messages, some of them broken by rule:
# event_type 'signup' becomes an unknown metric, tiny values lose their device or value.
METRIC_OF = {"view": "temperature", "click": "humidity", "purchase": "co2", "error": "vibration", "signup": "pressure"}
_METRIC_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in METRIC_OF.items()) + " END"

MESSAGES_SQL = (
    "(SELECT CASE WHEN value < 2 THEN NULL ELSE 'SN-' || CAST(user_id AS VARCHAR) END AS device_id, "
    f"{_METRIC_SQL} AS metric, CASE WHEN value BETWEEN 2 AND 3 THEN NULL ELSE value END AS value, "
    "CAST(floor(value / 3) AS INTEGER) - 2 AS battery_pct, -CAST(floor(value) AS INTEGER) AS rssi, "
    "event_id AS seq, user_id, ts, event_type AS kind FROM events) m"
)
PASS_SQL = (
    "device_id IS NOT NULL AND value IS NOT NULL AND ((metric = 'temperature' AND value BETWEEN -50 AND 100) "
    "OR (metric = 'humidity' AND value BETWEEN 0 AND 100) OR (metric = 'co2' AND value BETWEEN 300 AND 5000) "
    "OR (metric = 'vibration' AND value BETWEEN 0 AND 100)) AND battery_pct >= 0"
)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a message log: binary JSON value, partition, offset, timestamp."""
    body = F.struct(
        F.when(F.col("value") >= 2, F.concat(F.lit("SN-"), F.col("user_id").cast("string"))).alias("device_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("event_ts"),
        F.expr(_METRIC_SQL.replace("VARCHAR", "STRING")).alias("metric"),
        F.when(~F.col("value").between(2, 3), F.col("value")).alias("value"),
        F.lit("C").alias("unit"),
        (F.floor(F.col("value") / 3) - 2).cast("int").alias("battery_pct"),
        (-F.floor("value")).cast("int").alias("rssi"),
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("_inject_kind"),
    )
    return table(spark, sf_dir, "events").select(
        F.to_json(body).cast("binary").alias("value"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
    )


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return message_columns(messages(spark, sf_dir))


def users(spark: SparkSession, sf_dir: str, segment: str | None = None) -> DataFrame:
    """Customers with nation and region, keyed like the events; the two lookups are tiny."""
    customer = table(spark, sf_dir, "customer")
    if segment is not None:
        customer = customer.where(F.col("c_mktsegment") == segment)
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            F.col("c_custkey").alias("user_id"),
            F.col("c_mktsegment").alias("model"),
            F.col("n_name").alias("nation"),
            F.col("r_name").alias("region"),
            F.when(F.col("c_acctbal") < 0, "overdrawn").otherwise("active").alias("status"),
        )
    )


USERS_SQL = (
    "(SELECT c_custkey AS user_id, c_mktsegment AS model, n_name AS nation, r_name AS region, "
    "CASE WHEN c_acctbal < 0 THEN 'overdrawn' ELSE 'active' END AS status FROM customer "
    "JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) u"
)


@query(
    "event_parse",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, user_id FROM events",
)
def event_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumnRenamed("props", "raw_json")
    return telemetry.open_messages(events, "k bigint", keep=("event_id", "user_id"))


@query(
    "telemetry_silver",
    "SELECT device_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_ts, metric, value, 'C' AS unit, battery_pct, rssi, "
    f"seq, CAST(user_id % 4 AS INTEGER) AS log_partition, seq AS log_offset, strftime(ts, '%Y-%m-%d %H:%M:%S') AS enqueued_ts FROM {MESSAGES_SQL} WHERE {PASS_SQL}",
)
def telemetry_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("event_ts", "enqueued_ts")}
    return telemetry.silver(raw_messages(spark, sf_dir)).withColumns(times)


#: Text of a message, as it is sent: NULL fields are left out.
_RAW_SQL = (
    "'{' || CASE WHEN device_id IS NULL THEN '' ELSE '\"device_id\":\"' || device_id || '\",' END || "
    "'\"event_ts\":\"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '\",\"metric\":\"' || metric || '\",' || "
    "CASE WHEN value IS NULL THEN '' ELSE '\"value\":' || CAST(value AS VARCHAR) || ',' END || '\"unit\":\"C\",\"battery_pct\":' || battery_pct || "
    "',\"rssi\":' || rssi || ',\"seq\":' || seq || ',\"_inject_kind\":\"' || kind || '\"}'"
)
QUARANTINE_SQL = (
    "SELECT device_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS event_ts, metric, value, 'C' AS unit, battery_pct, rssi, seq, kind AS _inject_kind, "
    f"{_RAW_SQL} AS raw_json, CAST(user_id % 4 AS INTEGER) AS log_partition, seq AS log_offset, "
    "CASE WHEN device_id IS NULL THEN 'null_device_id' "
    f"WHEN NOT ({PASS_SQL.split(' AND ', 1)[1].rsplit(' AND ', 1)[0]}) THEN 'value_out_of_range' "
    "WHEN battery_pct < 0 THEN 'negative_battery' ELSE 'null_rule_input' END AS quarantine_reason "
    f"FROM {MESSAGES_SQL} WHERE NOT coalesce({PASS_SQL}, false)"
)


@query("telemetry_quarantine", QUARANTINE_SQL)
def telemetry_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.quarantined(raw_messages(spark, sf_dir))


def enriched(spark: SparkSession, sf_dir: str, segment: str | None = None) -> DataFrame:
    facts = table(spark, sf_dir, "events").withColumn("battery_pct", F.floor(F.col("value") / 4).cast("int"))
    dims = users(spark, sf_dir, segment)
    return enrich(
        facts.select("event_id", "user_id", "event_type", "value", "battery_pct", "ts"),
        dims,
        ["user_id"],
        ["model", "nation", "region", "status"],
        {"status": "device_status"},
    )


ENRICHED_SQL = (
    "(SELECT event_id, e.user_id, event_type, value, CAST(floor(value / 4) AS INTEGER) AS battery_pct, ts, model, "
    f"nation, region, status AS device_status FROM events e LEFT JOIN {USERS_SQL} ON e.user_id = u.user_id) x"
)


@query(
    "enriched_same_names",
    "SELECT event_id, e.user_id, e.event_type AS status, e.value AS model, u.status AS device_status, u.model AS device_model "
    f"FROM events e LEFT JOIN {USERS_SQL} ON e.user_id = u.user_id",
)
def enriched_same_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts and reference have columns of the same names."""
    facts = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("event_type").alias("status"), F.col("value").alias("model"))
    return enrich(facts, users(spark, sf_dir), ["user_id"], ["status", "model"], {"status": "device_status", "model": "device_model"})


@query(
    "enriched_events",
    "SELECT event_id, e.user_id, event_type, value, model, nation, region, status AS device_status FROM events e "
    f"LEFT JOIN (SELECT * FROM {USERS_SQL} WHERE model = 'BUILDING') b ON e.user_id = b.user_id",
)
def enriched_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only one segment is in the reference, so most events stay without dimensions."""
    return enriched(spark, sf_dir, "BUILDING").select(
        "event_id", "user_id", "event_type", "value", "model", "nation", "region", "device_status"
    )


@query(
    "enriched_orders_spread",
    "SELECT o_orderkey, o_custkey, o_totalprice, c_name, c_mktsegment FROM orders "
    "LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) c ON o_custkey = c_custkey",
)
def enriched_orders_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way a reference too large to broadcast is joined: hot keys spread over tasks."""
    customer = table(spark, sf_dir, "customer").where("c_acctbal >= 0")
    return skew_left_join(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"),
        customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment"),
        ["o_custkey"],
    )


@query(
    "gold_region_metric",
    f"SELECT nation, event_type, count(*) AS readings, {mean_sql('value', 2)} AS avg_value, "
    f"min(value) AS min_value, max(value) AS max_value, {mean_sql('battery_pct', 1)} AS avg_battery, "
    f"count(DISTINCT user_id) AS active_devices FROM {ENRICHED_SQL} GROUP BY 1, 2",
)
def gold_region_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return region_metric(
        enriched(spark, sf_dir), "nation", "event_type", device="user_id", mean=stable_mean
    )


SUMMARY_SQL = (
    f"SELECT user_id, model, region, device_status, count(*) AS readings, {mean_sql('battery_pct', 1)} AS avg_battery, "
    f"strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_event_ts FROM {ENRICHED_SQL} GROUP BY 1, 2, 3, 4"
)


@query("gold_user_summary", SUMMARY_SQL)
def gold_user_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = device_summary(
        enriched(spark, sf_dir), ["user_id", "model", "region", "device_status"], ts="ts", mean=stable_mean
    )
    return summary.withColumn("last_event_ts", F.date_format("last_event_ts", "yyyy-MM-dd HH:mm:ss"))


@query("top_user_summary", f"SELECT * FROM ({SUMMARY_SQL}) ORDER BY readings DESC, user_id LIMIT 5")
def top_user_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(gold_user_summary(spark, sf_dir), [F.desc("readings")], 5, ["user_id"])


@query(
    "top_region_metric",
    f"SELECT nation, event_type, count(*) AS readings, {mean_sql('value', 2)} AS avg_value FROM {ENRICHED_SQL} "
    "GROUP BY 1, 2 ORDER BY readings DESC, nation, event_type LIMIT 8",
)
def top_region_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = gold_region_metric(spark, sf_dir).select("nation", "event_type", "readings", "avg_value")
    return top_k(gold, [F.desc("readings")], 8, ["nation", "event_type"])


@query("customer_head", "SELECT c_custkey, c_name, c_mktsegment FROM customer ORDER BY c_custkey LIMIT 3")
def customer_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"), ["c_custkey"], 3)


@query("order_page", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 10")
def order_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return page(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], 10, 20)


@query(
    "region_summary",
    f"SELECT region, count(*) AS readings, count(DISTINCT user_id) AS devices FROM {ENRICHED_SQL} GROUP BY 1",
)
def region_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_summary(enriched(spark, sf_dir), "region", "user_id")


@query(
    "event_type_histogram",
    f"SELECT event_type, count(*) AS n, {mean_sql('value', 2)} AS avg_value FROM events GROUP BY 1 ORDER BY n DESC",
)
def event_type_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_histogram(table(spark, sf_dir, "events"), "event_type", mean=stable_mean).orderBy(
        F.desc("n"), "event_type"
    )


@query(
    "region_readings",
    "SELECT region, CAST(count(*) AS BIGINT) AS readings, CAST(round(CAST(CAST(sum(CAST(round(value * 100) AS BIGINT)) "
    "AS DOUBLE) / count(value) AS DECIMAL(18,6)), 2) AS DOUBLE) AS avg_value, count(DISTINCT e.user_id) AS devices "
    f"FROM events e JOIN {USERS_SQL} ON e.user_id = u.user_id GROUP BY 1",
)
def region_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values as whole cents, so that their sum is exact on every engine."""
    cents = table(spark, sf_dir, "events").select("user_id", F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    gold = readings_by(cents, users(spark, sf_dir), "user_id", "region", "cents", digits=10)
    return gold.withColumn("avg_value", F.round(F.col("avg_value").cast("decimal(18,6)"), 2).cast("double"))


@query(
    "daily_events",
    f"SELECT user_id, strftime(ts, '%Y-%m-%d') AS d, {mean_sql('value', 1)} AS avg_value, max(value) AS max_value "
    "FROM events GROUP BY 1, 2",
)
def daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = {"avg_value": stable_mean("value", 1), "max_value": F.max("value")}
    return daily(table(spark, sf_dir, "events"), ["user_id"], "ts", measures).withColumn("d", F.col("d").cast("string"))


@query(
    "event_totals",
    "SELECT count(*) AS rows, count(DISTINCT user_id) AS distinct_user_id, "
    "count(DISTINCT event_type) AS distinct_event_type FROM events",
)
def event_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals(table(spark, sf_dir, "events"), ["user_id", "event_type"])


@query("orders_known", "SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)")
def orders_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    solvent = table(spark, sf_dir, "customer").where("c_acctbal >= 0").withColumnRenamed("c_custkey", "o_custkey")
    return known(table(spark, sf_dir, "orders"), solvent, ["o_custkey"])


@query(
    "orders_unknown",
    "SELECT * FROM orders o WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_acctbal >= 0 AND c_custkey = o.o_custkey)",
)
def orders_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    solvent = table(spark, sf_dir, "customer").where("c_acctbal >= 0").withColumnRenamed("c_custkey", "o_custkey")
    return unknown(table(spark, sf_dir, "orders"), solvent, ["o_custkey"])


@query(
    "enriched_as_of",
    "SELECT f.*, CASE WHEN v.nxt IS NULL OR f.event_id < v.nxt THEN v.value END AS user_value, "
    "CASE WHEN v.nxt IS NULL OR f.event_id < v.nxt THEN v.event_id END AS user_since FROM (SELECT * FROM events WHERE event_id % 3 <> 0) f "
    "ASOF LEFT JOIN (SELECT * FROM (SELECT *, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS nxt FROM events "
    "WHERE event_id % 3 = 0) WHERE event_type <> 'error') v ON f.user_id = v.user_id AND f.event_id >= v.event_id",
)
def enriched_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the version of their user that was valid then; every third event is a change of its user, errors are deletes."""
    events = table(spark, sf_dir, "events")
    history = scd2(events.where("event_id % 3 = 0"), ["user_id"], "event_id", "event_type = 'error'", ["event_type", "event_id"])
    rename = {"value": "user_value", START: "user_since"}
    return enrich_as_of(events.where("event_id % 3 <> 0"), history, ["user_id"], "event_id", START, ["value", START], rename, valid_to=END)


@query(
    "order_page_deep",
    "SELECT * FROM orders ORDER BY o_orderdate, o_totalprice DESC, o_orderkey LIMIT 500 OFFSET (SELECT count(*) * 3 // 5 FROM orders)",
)
def order_page_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page behind three fifths of all orders, of which only its neighbourhood is sorted."""
    orders = table(spark, sf_dir, "orders")
    return deep_page(orders, ["o_orderdate", "-o_totalprice", "o_orderkey"], orders.count() * 3 // 5, 500, few=2000)
