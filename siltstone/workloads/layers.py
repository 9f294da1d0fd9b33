"""Layered datasets: bronze, silver, quarantine, gold."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.means import stable_mean
from siltstone.operators.aggregates import by_dimension, histogram
from siltstone.operators.quality import (
    at_least,
    expectation_metrics,
    forced_fault,
    observed,
    observed_metrics,
    quarantine,
    validated_table,
    with_reason,
)
from siltstone.plans import medallion
from siltstone.plans.config import Config, load_config
from siltstone.session import fresh_path
from siltstone.sources.readers import read_table
from siltstone.sources.writers import write_table
from siltstone.workloads.registry import mean_sql, query, table

EVENT_RULES = {
    "value_above_floor": "value > 1",
    "value_below_ceiling": "value <= 300",
    "user_present": "user_id IS NOT NULL",
}
EVENT_REASONS = (
    ("user_id IS NULL", "null_user_id"),
    ("NOT (value <= 300)", "value_too_high"),
    ("NOT (value > 1)", "value_too_low"),
)
ALL_EVENT_RULES = "value > 1 AND value <= 300 AND user_id IS NOT NULL"
BROKEN_EVENT = f"NOT coalesce({ALL_EVENT_RULES}, false)"
REASON_SQL = (
    "CASE WHEN user_id IS NULL THEN 'null_user_id' WHEN NOT (value <= 300) THEN 'value_too_high' "
    "WHEN NOT (value > 1) THEN 'value_too_low' ELSE 'null_rule_input' END"
)
LINE_RULES = {
    "quantity_positive": "l_quantity > 0",
    "discount_sane": "l_discount BETWEEN 0 AND 0.08",
    "part_present": "l_partkey IS NOT NULL",
}
DIMENSIONS = {
    "gold_by_returnflag": "l_returnflag",
    "gold_by_linestatus": "l_linestatus",
    "gold_by_quantity_band": (
        "CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 30 THEN 'medium' ELSE 'large' END"
    ),
    "gold_by_price_band": (
        "CASE WHEN l_extendedprice < 10000 THEN '01_<10k' WHEN l_extendedprice < 50000 THEN '02_10k-50k' "
        "ELSE '03_50k+' END"
    ),
    "gold_by_supplier": "l_suppkey",
}
LINE_FILTER = " AND ".join(f"({rule})" for rule in LINE_RULES.values())


def line_config(sf_dir: str) -> Config:
    return load_config(
        {
            "source": f"{sf_dir}/lineitem.parquet",
            "bronze_table": "bronze_lines",
            "silver_table": "silver_lines",
            "expectations": LINE_RULES,
            "gold_tables": [{"name": n, "dimension": d} for n, d in DIMENSIONS.items()],
        }
    )


def line_measures() -> dict:
    return {
        "lines": F.count(F.lit(1)),
        "avg_price": stable_mean("l_extendedprice", 2),
        "avg_quantity": stable_mean("l_quantity", 2),
    }


GOLD_COLUMNS = (
    f"count(*) AS lines, {mean_sql('l_extendedprice', 2)} AS avg_price, "
    f"{mean_sql('l_quantity', 2)} AS avg_quantity"
)


@query("bronze_orders", "SELECT * FROM orders")
def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/orders.parquet")


@query("silver_events", f"SELECT * FROM events WHERE {ALL_EVENT_RULES}")
def silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = load_config(
        {
            "source": f"{sf_dir}/events.parquet",
            "bronze_table": "bronze_events",
            "silver_table": "silver_events",
            "expectations": EVENT_RULES,
            "gold_tables": [],
        }
    )
    return medallion.silver(medallion.bronze(spark, config), config)


@query("quarantine_events", f"SELECT * FROM events WHERE {BROKEN_EVENT}")
def quarantine_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine(table(spark, sf_dir, "events"), EVENT_RULES)


@query(
    "quarantine_with_reason",
    f"SELECT *, {REASON_SQL} AS quarantine_reason FROM events WHERE {BROKEN_EVENT}",
)
def quarantine_with_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_reason(quarantine_events(spark, sf_dir), EVENT_REASONS)


@query(
    "quarantine_reasons",
    f"SELECT {REASON_SQL} AS quarantine_reason, count(*) AS n FROM events WHERE {BROKEN_EVENT} "
    "GROUP BY 1 ORDER BY n DESC, quarantine_reason",
)
def quarantine_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = histogram(quarantine_with_reason(spark, sf_dir), "quarantine_reason")
    return counted.orderBy(F.desc("n"), "quarantine_reason")


METRICS_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS name, CAST(count(*) FILTER (WHERE {rule}) AS BIGINT) AS passed_records, "
    f"CAST(count(*) - count(*) FILTER (WHERE {rule}) AS BIGINT) AS failed_records FROM events"
    for name, rule in EVENT_RULES.items()
)


@query("rule_metrics", METRICS_SQL)
def rule_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expectation_metrics(table(spark, sf_dir, "events"), EVENT_RULES)


@query("rule_metrics_on_write", METRICS_SQL)
def rule_metrics_on_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same numbers, gathered while the bronze copy is written."""
    df, observation = observed(table(spark, sf_dir, "events"), EVENT_RULES)
    df.write.parquet(fresh_path(spark, "bronze-events"))
    return spark.createDataFrame(
        [tuple(m.values()) for m in observed_metrics(observation, EVENT_RULES)],
        "name string, passed_records long, failed_records long",
    )


@query(
    "lossless_split",
    "SELECT count(*) AS source_rows, "
    f"count(*) FILTER (WHERE {ALL_EVENT_RULES}) AS silver_rows, "
    f"count(*) FILTER (WHERE {BROKEN_EVENT}) AS quarantine_rows, true AS lossless FROM events",
)
def lossless_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver and quarantine put together again, against the source."""
    events = table(spark, sf_dir, "events")
    sides = {"source": events, "silver": silver_events(spark, sf_dir), "quarantine": quarantine(events, EVENT_RULES)}
    counted = None
    for side, df in sides.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(side).alias("side"), "n")
        counted = one if counted is None else counted.unionByName(one)
    return counted.agg(
        *(F.sum(F.when(F.col("side") == s, F.col("n")).otherwise(0)).alias(f"{s}_rows") for s in sides)
    ).withColumn("lossless", F.col("source_rows") == F.col("silver_rows") + F.col("quarantine_rows"))


def _gold(name: str, dimension: str) -> None:
    @query(
        name,
        f"SELECT {dimension} AS dimension_value, {GOLD_COLUMNS} FROM lineitem WHERE {LINE_FILTER} GROUP BY 1",
    )
    def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
        config = line_config(sf_dir)
        silver = medallion.silver(medallion.bronze(spark, config), config)
        return medallion.gold_tables(silver, config, line_measures())[name]


for _name, _dimension in DIMENSIONS.items():
    _gold(_name, _dimension)


@query(
    "gold_in_one_scan",
    " UNION ALL ".join(
        f"SELECT '{name}' AS gold, CAST({text} AS VARCHAR) AS dimension_value, {GOLD_COLUMNS} "
        f"FROM lineitem WHERE {LINE_FILTER} GROUP BY 2"
        for name, text in DIMENSIONS.items()
    ),
)
def gold_in_one_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = line_config(sf_dir)
    silver = medallion.silver(medallion.bronze(spark, config), config)
    return medallion.gold_in_one_scan(silver, config, line_measures())


@query("gold_high_value", "SELECT * FROM orders WHERE o_totalprice >= 400000")
def gold_high_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return at_least(table(spark, sf_dir, "orders"), "o_totalprice", 400000)


@query("gold_high_value_sql", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice >= 400000 GROUP BY 1")
def gold_high_value_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dataset read by name in SQL, the limit bound as a parameter."""
    medallion.register({"siltstone_silver_orders": table(spark, sf_dir, "orders")})
    return spark.sql(
        "SELECT o_orderstatus, count(*) AS n FROM siltstone_silver_orders WHERE o_totalprice >= :minimum GROUP BY 1",
        args={"minimum": 400000},
    )


@query("orders_validated", "SELECT * FROM orders WHERE o_totalprice >= 0")
def orders_validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {"amount_non_negative": "o_totalprice >= 0"}
    return validated_table(spark, table(spark, sf_dir, "orders"), rules, fresh_path(spark, "orders-validated"))


@query("branch_recovered", "SELECT o_orderkey, 'recovered' AS status FROM orders")
def branch_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forced_fault(
        table(spark, sf_dir, "orders"), "o_orderkey", "o_totalprice < 0", "forced runtime fault", inject=False
    )


@query(
    "medallion_stored",
    " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, CAST({dimension} AS VARCHAR) AS dimension_value, count(*) AS lines, "
        f"CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem WHERE {rows} GROUP BY 2"
        for name, dimension, rows in (
            ("bronze_lines", "'all'", "true"),
            ("silver_lines", "'all'", LINE_FILTER),
            ("quarantine", "'all'", f"NOT coalesce({LINE_FILTER}, false)"),
            ("gold_by_flag", "l_returnflag", LINE_FILTER),
            ("gold_by_line", "l_linenumber", LINE_FILTER),
        )
    ),
)
def medallion_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All layers written and read back from one configuration."""
    config = load_config(
        {
            "source": f"{sf_dir}/lineitem.parquet",
            "bronze_table": "bronze_lines",
            "silver_table": "silver_lines",
            "expectations": LINE_RULES,
            "gold_tables": [{"name": "gold_by_flag", "dimension": "l_returnflag"}, {"name": "gold_by_line", "dimension": "l_linenumber"}],
            "measures": {"lines": "count(*)", "quantity": "sum(CAST(l_quantity AS BIGINT))"},
        }
    )
    tables = medallion.materialize(spark, config, fresh_path(spark, "medallion"))
    whole = [by_dimension(tables[name], "'all'", medallion.measures_of(config)).withColumn("dataset", F.lit(name)) for name in ("bronze_lines", "silver_lines", "quarantine")]
    gold = [tables[name].withColumn("dataset", F.lit(name)) for name in ("gold_by_flag", "gold_by_line")]
    shown = [t.withColumn("dimension_value", F.col("dimension_value").cast("string")) for t in (*whole, *gold)]
    return reduce(DataFrame.unionByName, shown)


UPDATE_SQL = (
    f"SELECT 'silver_lines' AS dataset, count(*) AS n FROM lineitem WHERE {LINE_FILTER} "
    f"UNION ALL SELECT 'quarantine', count(*) FROM lineitem WHERE NOT coalesce({LINE_FILTER}, false) "
    f"UNION ALL SELECT 'gold_high_value', count(*) FROM lineitem WHERE {LINE_FILTER} AND l_extendedprice >= 50000 "
    "UNION ALL SELECT 'streamed', count(*) FROM events "
    "UNION ALL SELECT 'scd1', count(*) FROM (SELECT arg_max(event_type, event_id) AS last FROM events GROUP BY user_id) "
    "WHERE last <> 'error' "
    "UNION ALL SELECT 'scd2', count(*) FROM events WHERE event_type <> 'error' "
    "UNION ALL SELECT 'validated', count(*) FROM orders"
)


@query("update_row_counts", UPDATE_SQL)
def update_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run of a whole configuration: layers, landing, change feed and validated orders."""
    root = fresh_path(spark, "update")
    events = write_table(table(spark, sf_dir, "events"), f"{root}/landing")
    return _updated(spark, sf_dir, root, events, f"{sf_dir}/lineitem.parquet", f"{sf_dir}/orders.parquet")


@query("update_from_catalog", UPDATE_SQL)
def update_from_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same run, every source being the name of a catalog table."""
    root, names = fresh_path(spark, "update-catalog"), []
    for source in ("events", "lineitem", "orders"):
        names.append(f"siltstone_{source}_{uuid.uuid4().hex}")
        table(spark, sf_dir, source).write.option("path", f"{root}/{source}").saveAsTable(names[-1])
    return _updated(spark, sf_dir, root, *names)


def _updated(spark: SparkSession, sf_dir: str, root: str, events: str, lines: str, orders: str) -> DataFrame:
    config = load_config(
        {
            "source": lines,
            "bronze_table": "bronze_lines",
            "silver_table": "silver_lines",
            "expectations": LINE_RULES,
            "gold_tables": [],
            "minimum_column": "l_extendedprice",
            "landing_table": events,
            "cdc_source": events,
            "cdc": {"keys": ["user_id"], "sequence_by": "event_id", "deletes": "event_type = 'error'"},
            "orders_source": orders,
            "order_rules": {"amount_non_negative": "o_totalprice >= 0"},
        }
    )
    tables = medallion.update(spark, config, f"{root}/run", minimum=50000)
    counted = [
        tables[name].agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("dataset"), "n")
        for name in ("silver_lines", "quarantine", "gold_high_value", "streamed", "scd1", "scd2", "validated")
    ]
    return reduce(DataFrame.unionByName, counted)
