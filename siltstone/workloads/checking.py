"""Checks on stored tables and scan reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.checks import ERRORS, WARNINGS, apply_checks, split_checks, validate_checks, verdict_counts
from siltstone.operators.scan import NON_NULL, RANGE, REGEX, SET, scan_report, scan_verdict
from siltstone.plans import telemetry
from siltstone.session import fresh_path
from siltstone.sources.writers import read_split, write_split, write_table
from siltstone.workloads.enrichment import MESSAGES_SQL, raw_messages, users
from siltstone.workloads.registry import query, table

LINE_CHECKS = [
    {
        "name": "price_present",
        "criticality": "error",
        "check": {"function": "is_not_null", "arguments": {"column": "l_extendedprice"}},
    },
    {
        "name": "returned_small",
        "criticality": "error",
        "check": {
            "function": "sql_expression",
            "arguments": {"expression": "NOT (l_returnflag = 'R' AND l_quantity > 48)", "msg": "large return"},
        },
    },
    {
        "name": "discount_range",
        "criticality": "warn",
        "check": {"function": "is_in_range", "arguments": {"column": "l_discount", "min_limit": 0.0, "max_limit": 0.09}},
    },
    {
        "name": "quantity_floor",
        "criticality": "warn",
        "check": {"function": "is_not_less_than", "arguments": {"column": "l_quantity", "limit": 3}},
    },
    {
        "name": "ship_not_future",
        "criticality": "warn",
        "check": {"function": "is_not_in_future", "arguments": {"column": "l_shipdate", "offset": 86400}},
    },
    {
        "name": "line_unique",
        "criticality": "error",
        "check": {"function": "is_unique", "arguments": {"columns": ["l_orderkey", "l_linenumber"]}},
    },
    {
        "name": "order_known",
        "criticality": "error",
        "check": {
            "function": "foreign_key",
            "arguments": {"columns": ["l_orderkey"], "ref_columns": ["o_orderkey"], "ref_table": "open_orders"},
        },
    },
    {
        "name": "volume_guard",
        "criticality": "error",
        "check": {
            "function": "is_aggr_not_greater_than",
            "arguments": {"column": "l_quantity", "aggr_type": "max", "limit": 50},
        },
    },
]
AS_OF = "2001-01-01 00:00:00"

# Names of what failed, sorted and joined, per row of lineitem.
_FLAGS_SQL = (
    "(SELECT l.*, "
    "(l_extendedprice IS NULL) AS e1, coalesce(l_returnflag = 'R' AND l_quantity > 48, false) AS e2, "
    "(count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1) AS e3, (o_orderkey IS NULL) AS e4, "
    "((SELECT max(l_quantity) FROM lineitem) > 50) AS e5, "
    "NOT coalesce(l_discount BETWEEN 0.0 AND 0.09, true) AS w1, NOT coalesce(l_quantity >= 3, true) AS w2, "
    f"NOT coalesce(l_shipdate <= TIMESTAMP '{AS_OF}' + INTERVAL 86400 SECOND, true) AS w3 "
    "FROM lineitem l LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F') o ON l_orderkey = o_orderkey) f"
)
_ERR_SQL = (
    "concat_ws(',', CASE WHEN e3 THEN 'line_unique' END, CASE WHEN e4 THEN 'order_known' END, "
    "CASE WHEN e1 THEN 'price_present' END, CASE WHEN e2 THEN 'returned_small' END, CASE WHEN e5 THEN 'volume_guard' END)"
)
_WARN_SQL = (
    "concat_ws(',', CASE WHEN w1 THEN 'discount_range' END, CASE WHEN w2 THEN 'quantity_floor' END, "
    "CASE WHEN w3 THEN 'ship_not_future' END)"
)
_ANY_ERR = "(e1 OR e2 OR e3 OR e4 OR e5)"
_ANY_WARN = "(w1 OR w2 OR w3)"
_LINE_SQL = (
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, "
    "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate, "
    f"{_ERR_SQL} AS errors, {_WARN_SQL} AS warnings FROM {_FLAGS_SQL}"
)


def annotated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where("o_orderstatus <> 'F'")
    return apply_checks(table(spark, sf_dir, "lineitem"), LINE_CHECKS, {"open_orders": orders}, AS_OF)


def _names(column: str) -> Column:
    names = F.transform(F.coalesce(F.col(column), F.array()), lambda d: d["name"])
    return F.concat_ws(",", F.sort_array(names))


def _readable(df: DataFrame) -> DataFrame:
    """All columns of the rows; verdicts as names, times as text."""
    shown = df.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))
    return shown.withColumns({"errors": _names(ERRORS), "warnings": _names(WARNINGS)}).drop(ERRORS, WARNINGS)


@query("checks_annotated", _LINE_SQL)
def checks_annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _readable(annotated_lines(spark, sf_dir))


@query("checks_valid", f"{_LINE_SQL} WHERE NOT {_ANY_ERR}")
def checks_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _readable(split_checks(annotated_lines(spark, sf_dir))[0])


@query("checks_quarantine", f"{_LINE_SQL} WHERE {_ANY_ERR}")
def checks_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _readable(split_checks(annotated_lines(spark, sf_dir))[1])


@query("checks_stored_split", f"{_LINE_SQL} WHERE {_ANY_ERR}")
def checks_stored_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotated once, stored by verdict, one verdict read back."""
    path = write_split(annotated_lines(spark, sf_dir), fresh_path(spark, "checked-lines"))
    return _readable(read_split(spark, path, "quarantine"))


@query(
    "checks_verdict_counts",
    f"SELECT count(*) AS total, count(*) FILTER (WHERE NOT {_ANY_ERR}) AS valid, "
    f"count(*) FILTER (WHERE {_ANY_ERR}) AS quarantine, count(*) FILTER (WHERE {_ANY_WARN} AND NOT {_ANY_ERR}) "
    f"AS warned_valid FROM {_FLAGS_SQL}",
)
def checks_verdict_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdict_counts(annotated_lines(spark, sf_dir))


_DEVICES_SQL = "(SELECT 'SN-' || CAST(c_custkey AS VARCHAR) AS device_id FROM customer WHERE c_mktsegment <> 'MACHINERY')"


_CHECKED_SQL = (
    "WITH f AS (SELECT m.device_id, strftime(m.ts, '%Y-%m-%d %H:%M:%S') AS event_ts, m.metric, m.value, 'C' AS unit, m.battery_pct, m.rssi, m.seq, "
    "CAST(m.user_id % 4 AS INTEGER) AS log_partition, m.seq AS log_offset, m.device_id IS NULL AS e1, NOT coalesce((metric = 'temperature' AND value BETWEEN -50 AND 100) "
    "OR (metric = 'humidity' AND value BETWEEN 0 AND 100) OR (metric = 'co2' AND value BETWEEN 300 AND 5000) "
    "OR (metric = 'vibration' AND value BETWEEN 0 AND 100), true) AS e2, "
    "(m.device_id IS NOT NULL AND d.device_id IS NULL) AS e3, ((SELECT count(*) FROM events) > (SELECT count(*) FROM events) - {below}) AS e4, "
    "NOT (battery_pct BETWEEN 0 AND 100) AS w1, NOT (rssi >= -100) AS w2 "
    f"FROM {MESSAGES_SQL} LEFT JOIN {_DEVICES_SQL} d ON m.device_id = d.device_id) " 
    "SELECT device_id, event_ts, metric, value, unit, battery_pct, rssi, seq, log_partition, log_offset, concat_ws(',', CASE WHEN e3 THEN 'device_in_reference' END, CASE WHEN e1 THEN 'device_id_not_null' END, "
    "CASE WHEN e4 THEN 'rowcount_guard' END, CASE WHEN e2 THEN 'value_in_metric_range' END) AS errors, "
    "concat_ws(',', CASE WHEN w1 THEN 'battery_healthy' END, CASE WHEN w2 THEN 'signal_ok' END) AS warnings FROM f"
)


@query("telemetry_checked", _CHECKED_SQL.format(below=0))
def telemetry_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full telemetry check list, over messages parsed and stored once; the table is just as large as it may be."""
    return _checked(spark, sf_dir, below=0)


@query("volume_guard_trips", _CHECKED_SQL.format(below=1))
def volume_guard_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with one row too many, which puts every row in error."""
    return _checked(spark, sf_dir, below=1)


def _checked(spark: SparkSession, sf_dir: str, below: int) -> DataFrame:
    devices = users(spark, sf_dir).where("model <> 'MACHINERY'").select(
        F.concat(F.lit("SN-"), F.col("user_id").cast("string")).alias("device_id")
    )
    messages = telemetry.parse_messages(raw_messages(spark, sf_dir))
    parsed = spark.read.schema(messages.schema).parquet(write_table(messages, fresh_path(spark, "parsed-messages")))
    checks = telemetry.stored_checks(row_limit=table(spark, sf_dir, "events").count() - below)
    refs = {"device_reference": devices}
    problems = validate_checks(spark, checks, parsed.schema, refs)
    if problems:
        raise ValueError("; ".join(problems))
    checked = apply_checks(parsed, checks, refs)
    shown = checked.withColumn("event_ts", F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss")).drop("enqueued_ts")  # equal to event_ts here
    return shown.withColumns({"errors": _names(ERRORS), "warnings": _names(WARNINGS)}).drop(ERRORS, WARNINGS)


SCAN_RULES = [
    {"column": "c_custkey", "dimension": "COMPLETENESS", "type": NON_NULL},
    {"column": "c_acctbal", "dimension": "VALIDITY", "type": RANGE, "min": "0", "max": "10000"},
    {"column": "c_nationkey", "dimension": "VALIDITY", "type": RANGE, "min": "0", "max": "24"},
    {"column": "c_mktsegment", "dimension": "VALIDITY", "type": SET, "values": ["BUILDING", "MACHINERY"]},
    {"column": "c_name", "dimension": "VALIDITY", "type": REGEX, "regex": "^Customer#[0-9]+$"},
]
_SCAN_CONDITIONS = {
    "c_custkey": "c_custkey IS NOT NULL",
    "c_acctbal": "c_acctbal BETWEEN 0 AND 10000",
    "c_nationkey": "c_nationkey BETWEEN 0 AND 24",
    "c_mktsegment": "c_mktsegment IN ('BUILDING', 'MACHINERY')",
    "c_name": "regexp_matches(c_name, '^Customer#[0-9]+$')",
}
_SCAN_SQL = " UNION ALL ".join(
    f"SELECT '{r['column']}' AS \"column\", '{r['dimension']}' AS dimension, '{r['type']}' AS type, "
    f"count(*) = count(*) FILTER (WHERE {_SCAN_CONDITIONS[r['column']]}) AS passed, "
    f"round(CAST(count(*) FILTER (WHERE {_SCAN_CONDITIONS[r['column']]}) AS DOUBLE) / count(*), 2) AS pass_ratio FROM customer"
    for r in SCAN_RULES
)


@query("scan_report", _SCAN_SQL)
def customer_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_report(table(spark, sf_dir, "customer"), SCAN_RULES)


@query(
    "scan_verdict",
    f"SELECT bool_and(passed) AS passed, (SELECT count(*) FROM customer) AS row_count, "
    f"string_agg(\"column\" || '=' || CAST(passed AS VARCHAR), ',' ORDER BY \"column\") AS rules, min(pass_ratio) AS lowest_ratio FROM ({_SCAN_SQL})",
)
def customer_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdict = scan_verdict(table(spark, sf_dir, "customer"), SCAN_RULES)
    shown = F.transform("rules", lambda r: F.concat(r["column"], F.lit("="), r["passed"].cast("string")))
    lowest = F.array_min(F.transform("rules", lambda r: r["pass_ratio"]))
    return verdict.withColumn("lowest_ratio", lowest).withColumn("rules", F.concat_ws(",", F.sort_array(shown)))
