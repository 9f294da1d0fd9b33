"""Copies between systems, their typed reload and their reconciliation."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.means import stable_mean, stable_sum
from siltstone.operators.reconcile import (
    reconcile_aggregates,
    reconcile_counts,
    reconcile_rows,
    reconcile_sets,
    reconciliation_passes,
)
from siltstone.session import fresh_path
from siltstone.sources.clustered import read_clustered, write_clustered
from siltstone.sources.readers import export, load_documents, load_ndjson, remote_table
from siltstone.sources.writers import described, export_ndjson, publish, save_table, write_table
from siltstone.workloads.registry import mean_sql, query, sum_sql, table

HISTORY = "device_id bigint, event_ts timestamp, metric string, value double, ingest_date date"


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the layout of a day-partitioned warehouse fact."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("device_id"),
        F.col("ts").alias("event_ts"),
        F.col("event_type").alias("metric"),
        "value",
        F.to_date("ts").alias("ingest_date"),
    )


@query("warehouse_projection", "SELECT user_id AS device_id, event_type AS metric, value FROM events")
def warehouse_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export(history(spark, sf_dir), ["device_id", "metric", "value"])


@query(
    "ndjson_reload",
    "SELECT user_id AS device_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_ts, event_type AS metric, value, "
    "strftime(ts, '%Y-%m-%d') AS ingest_date FROM events",
)
def ndjson_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exported as JSON lines, loaded again with types."""
    path = export_ndjson(history(spark, sf_dir), fresh_path(spark, "landing"))
    loaded = load_ndjson(spark, path, HISTORY)
    return loaded.withColumns(
        {"event_ts": F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss"), "ingest_date": F.col("ingest_date").cast("string")}
    )


@query(
    "partitioned_history",
    f"SELECT event_type AS metric, count(*) AS n, {sum_sql('value')} AS total FROM events "
    "WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' GROUP BY 1",
)
def partitioned_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written by day, three days read: the other folders are not opened."""
    path = write_table(history(spark, sf_dir), fresh_path(spark, "history"), ["ingest_date"], rebalance=True)
    days = spark.read.parquet(path).where("ingest_date BETWEEN DATE'2024-01-10' AND DATE'2024-01-12'")
    return days.groupBy("metric").agg(F.count(F.lit(1)).alias("n"), stable_sum("value").alias("total"))


@query(
    "ndjson_unreadable_lines",
    "SELECT CASE WHEN event_id % 50 <> 3 THEN event_id END AS event_id, CASE WHEN event_id % 50 NOT IN (3, 4) THEN value END AS value, "
    "CASE WHEN event_id % 50 = 3 THEN 'event ' || event_id || ' {' END AS unreadable FROM events",
)
def ndjson_unreadable_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are no JSON keep their text; wrong values cost their field alone."""
    key = F.col("event_id")
    value = F.when(key % 50 == 4, F.lit("much")).otherwise(F.col("value").cast("string"))
    good = F.to_json(F.struct("event_id", value.alias("value")))
    lines = table(spark, sf_dir, "events").select(F.when(key % 50 == 3, F.concat(F.lit("event "), key.cast("string"), F.lit(" {"))).otherwise(good))
    path = fresh_path(spark, "lines")
    lines.write.text(path)
    return load_ndjson(spark, path, "event_id bigint, value double", unreadable="unreadable")


@query(
    "table_described",
    "SELECT 'comment' AS kind, 'table' AS name, 'customers of ' || count(DISTINCT c_nationkey) || ' nations' AS value FROM customer "
    "UNION ALL SELECT 'property', 'segment ' || c_mktsegment, CAST(count(*) AS VARCHAR) FROM customer GROUP BY c_mktsegment "
    "UNION ALL SELECT 'column', 'c_acctbal', 'from ' || CAST(CAST(floor(min(c_acctbal)) AS BIGINT) AS VARCHAR) FROM customer",
)
def table_described(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table is written with comment, properties and a column comment; all are read back from the catalog."""
    customer, name = table(spark, sf_dir, "customer"), f"siltstone_customer_{uuid.uuid4().hex}"
    nations, low = customer.agg(F.count_distinct("c_nationkey"), F.floor(F.min("c_acctbal"))).first()
    segments = {f"segment {r[0]}": str(r[1]) for r in customer.groupBy("c_mktsegment").count().collect()}
    rows = customer.withMetadata("c_acctbal", {"comment": f"from {low}"})
    save_table(rows, name, f"customers of {nations} nations", segments)
    found = described(spark, name).where("kind <> 'property' OR name LIKE 'segment %'")
    kept = spark.createDataFrame(found.collect(), found.schema)  # as many rows as columns and properties
    spark.sql(f"DROP TABLE {name}")
    return kept


#: Fields of a document beside its identity.
_DOCUMENT_SQL = (
    "SELECT 'SN-' || c_custkey AS device_id, c_mktsegment AS model, 'v' || (c_custkey % 7) AS firmware, n_name AS region, 'site ' || c_nationkey AS site, "
    "CASE WHEN c_acctbal < 0 THEN 'overdrawn' ELSE 'active' END AS status, '2024-01-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') AS registered_at, "
    "CASE WHEN c_custkey % 9 <> 0 THEN c_name END AS last_seen, CAST(floor(abs(c_acctbal)) AS INTEGER) % 101 AS battery_pct "
    "FROM customer JOIN nation ON c_nationkey = n_nationkey"
)


@query("document_snapshot", _DOCUMENT_SQL)
def document_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with more fields than the nine that the reference table wants."""
    key, nation = F.col("c_custkey"), table(spark, sf_dir, "nation")
    documents = table(spark, sf_dir, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")).select(
        key.alias("id"),
        F.concat(F.lit("SN-"), key.cast("string")).alias("device_id"),
        F.col("c_mktsegment").alias("model"),
        F.concat(F.lit("v"), (key % 7).cast("string")).alias("firmware"),
        F.col("n_name").alias("region"),
        F.concat(F.lit("site "), F.col("c_nationkey").cast("string")).alias("site"),
        F.concat(F.lit("2024-01-"), F.lpad((key % 28 + 1).cast("string"), 2, "0")).alias("registered_at"),
        F.when(F.col("c_acctbal") < 0, "overdrawn").otherwise("active").alias("status"),
        F.when(key % 9 != 0, F.col("c_name")).alias("last_seen"),
        (F.floor(F.abs("c_acctbal")) % 101).cast("int").alias("battery_pct"),
        F.lit("device_state").alias("_doc_type"),
    )
    path = export_ndjson(documents, fresh_path(spark, "documents"))
    return load_documents(spark, path)


@query("remote_orders", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 300000")
def remote_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    remote = remote_table(spark, "parquet", {"path": f"{sf_dir}/orders.parquet"})
    return remote.where(F.col("o_totalprice") > 300000).select("o_orderkey", "o_totalprice")


@query("published_snapshot", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def published_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots published under one name; readers get the second."""
    orders = table(spark, sf_dir, "orders")
    name = f"siltstone_orders_{uuid.uuid4().hex}"
    for rows in (orders.where("o_totalprice < 50000"), orders):
        publish(spark, name, write_table(rows, fresh_path(spark, "snapshot")))
    return spark.table(name).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


def _partial_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where("o_totalprice <= 400000")


@query(
    "reconcile_counts",
    "SELECT 'customer' AS \"table\", count(*) AS source_rows, count(*) AS target_rows, true AS matches FROM customer "
    "UNION ALL SELECT 'orders', count(*), count(*) FILTER (WHERE o_totalprice <= 400000), "
    "count(*) = count(*) FILTER (WHERE o_totalprice <= 400000) FROM orders",
)
def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return reconcile_counts(
        {"customer": (customer, customer), "orders": (table(spark, sf_dir, "orders"), _partial_copy(spark, sf_dir))}
    )


_ORDER_GROUPS = (
    f"SELECT o_custkey, count(*) AS n, {mean_sql('o_totalprice', 2)} AS avg_price FROM orders {{where}} GROUP BY 1"
)


@query(
    "reconcile_aggregates",
    "SELECT coalesce(s.o_custkey, t.o_custkey) AS o_custkey, s.n AS source_n, t.n AS target_n, "
    "s.avg_price AS source_avg_price, t.avg_price AS target_avg_price, "
    "(s.n IS NOT DISTINCT FROM t.n AND s.avg_price IS NOT DISTINCT FROM t.avg_price) AS matches "
    f"FROM ({_ORDER_GROUPS.format(where='')}) s FULL JOIN "
    f"({_ORDER_GROUPS.format(where='WHERE o_totalprice <= 400000')}) t ON s.o_custkey = t.o_custkey",
)
def aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = {"n": F.count(F.lit(1)), "avg_price": stable_mean("o_totalprice", 2)}
    return reconcile_aggregates(table(spark, sf_dir, "orders"), _partial_copy(spark, sf_dir), ["o_custkey"], measures)


@query(
    "reconcile_sets",
    "SELECT o_custkey, status FROM (SELECT DISTINCT o_custkey, 'missing' AS status FROM orders WHERE o_custkey NOT IN "
    "(SELECT c_custkey FROM customer WHERE c_acctbal >= 0) UNION ALL SELECT c_custkey, 'unexpected' FROM customer "
    "WHERE c_acctbal >= 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders))",
)
def sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    solvent = table(spark, sf_dir, "customer").where("c_acctbal >= 0").select(F.col("c_custkey").alias("o_custkey"))
    return reconcile_sets(table(spark, sf_dir, "orders"), solvent, ["o_custkey"])


@query(
    "reconcile_verdict",
    "SELECT m AS missing, u AS unexpected, m = 0 AS passed FROM (SELECT (SELECT count(DISTINCT o_custkey) FROM orders "
    "WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)) AS m, (SELECT count(*) FROM customer "
    "WHERE c_acctbal >= 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders)) AS u)",
)
def verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    solvent = table(spark, sf_dir, "customer").where("c_acctbal >= 0").select(F.col("c_custkey").alias("o_custkey"))
    return reconciliation_passes(table(spark, sf_dir, "orders"), solvent, ["o_custkey"])


_CHANGED_COPY = (
    "(SELECT o_orderkey + CASE WHEN o_orderkey % 1001 = 5 THEN 100000000 ELSE 0 END AS o_orderkey, o_custkey, o_orderstatus, "
    "o_totalprice + CASE WHEN o_orderkey % 997 = 3 THEN 1 ELSE 0 END AS o_totalprice, o_orderdate, "
    "CASE WHEN o_orderkey % 1994 = 3 THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders WHERE o_orderkey % 991 <> 2)"
)


@query(
    "reconcile_rows",
    "SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey, "
    "CASE WHEN t.o_orderkey IS NULL THEN 'missing' WHEN s.o_orderkey IS NULL THEN 'unexpected' ELSE 'changed' END AS status, "
    "CAST(s.o_orderkey IS NOT NULL AS BIGINT) AS source_rows, CAST(t.o_orderkey IS NOT NULL AS BIGINT) AS target_rows, "
    "CASE WHEN s.o_orderkey IS NOT NULL AND t.o_orderkey IS NOT NULL THEN concat_ws(',', "
    "CASE WHEN s.o_totalprice IS DISTINCT FROM t.o_totalprice THEN 'o_totalprice' END, "
    "CASE WHEN s.o_orderpriority IS DISTINCT FROM t.o_orderpriority THEN 'o_orderpriority' END) END AS changed_columns "
    f"FROM orders s FULL JOIN {_CHANGED_COPY} t ON s.o_orderkey = t.o_orderkey "
    "WHERE (s.o_orderkey, s.o_custkey, s.o_orderstatus, s.o_totalprice, s.o_orderdate, s.o_orderpriority) IS DISTINCT FROM "
    "(t.o_orderkey, t.o_custkey, t.o_orderstatus, t.o_totalprice, t.o_orderdate, t.o_orderpriority)",
)
def reconcile_all_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against a copy in which some are missing, changed or new."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    copy = orders.where(key % 991 != 2).withColumns(
        {
            "o_totalprice": F.col("o_totalprice") + F.when(key % 997 == 3, 1).otherwise(0),
            "o_orderpriority": F.when(key % 1994 != 3, F.col("o_orderpriority")),
            "o_orderkey": key + F.when(key % 1001 == 5, 100000000).otherwise(0),
        }
    )
    found = reconcile_rows(orders, copy, ["o_orderkey"], leaf_rows=500)
    return found.withColumn("changed_columns", F.array_join("changed_columns", ","))


@query(
    "clustered_history",
    "SELECT user_id AS device_id, ts AS event_ts, event_type AS metric, value, CAST(ts AS DATE) AS ingest_date FROM events "
    "WHERE user_id BETWEEN 20 AND 39 AND value BETWEEN 50.0 AND 80.0",
)
def clustered_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History laid out by device and value; a filter on both opens few of the files."""
    whole, columns = history(spark, sf_dir), ["device_id", "value"]
    path = write_clustered(whole, fresh_path(spark, "clustered"), columns, files=24)
    return read_clustered(spark, path, columns, {"device_id": (20, 39), "value": (50.0, 80.0)}, whole.schema)
