"""Metadata inventories and event logs, here derived from the business tables.

Every part plays a described table, every supplier an entry with an aspect.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.text import open_json
from siltstone.operators import governance as gov
from siltstone.operators.eventlog import critical_path, expectation_entries, expectation_log, flow_history
from siltstone.operators.lineage import closure
from siltstone.operators.reconcile import reconcile_sets
from siltstone.operators.rules import NOT_ABOVE, rule_conflicts
from siltstone.operators.scan import NON_NULL, RANGE, SET, measured_rules
from siltstone.operators.sketches import merge, profile_of, sketch
from siltstone.session import fresh_path
from siltstone.sources.readers import load_event_log, load_inventory
from siltstone.workloads.registry import query, table


def _text_map(**entries: Column) -> Column:
    return F.create_map(*(part for name, value in entries.items() for part in (F.lit(name), value)))


def inventory_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON inventory per part."""
    name = F.concat(F.lit("part_"), F.col("p_partkey").cast("string"))
    described = F.struct(
        F.when(F.col("p_size") > 10, F.col("p_name")).alias("description"),
        _text_map(brand=F.col("p_brand"), layer=F.when(F.col("p_size") > 25, "gold").otherwise("bronze")).alias("labels"),
        _text_map(
            size=F.when(F.col("p_size") > 30, F.concat(F.col("p_type"), F.lit(" (PHI)"))).otherwise(F.col("p_type")),
            price=F.lit(None).cast("string"),
        ).alias("columns"),
    )
    aspect = F.struct(
        F.concat(F.lit("tenant.zone."), F.when(F.col("p_size") > 20, "data-classification").otherwise("owner-ship")).alias(
            "aspect_type"
        ),
        _text_map(steward=F.col("p_brand"), sensitivity=F.col("p_type")).alias("data"),
    )
    bound = F.col("p_size").cast("string")
    no_bound = F.lit(None).cast("string")
    rules = F.array(
        _rule("part_id", "COMPLETENESS", NON_NULL, no_bound, no_bound),
        _rule("size", "VALIDITY", RANGE, F.lit("0"), bound),
        _rule("brand", "VALIDITY", "regex_expectation", no_bound, no_bound),
    )
    lineage = F.array(F.struct(F.concat(F.lit("brand."), F.col("p_brand")).alias("source"), name.alias("target")))
    document = F.struct(
        F.create_map(name, described).alias("metadata"),
        F.create_map(name, aspect).alias("aspects"),
        F.struct(name.alias("target"), rules.alias("rules")).alias("data_quality"),
        lineage.alias("lineage"),
    )
    return table(spark, sf_dir, "part").select(F.to_json(document).alias("value"))


def _rule(column: str, dimension: str, kind: str, low: Column, high: Column) -> Column:
    return F.struct(
        F.lit(column).alias("column"),
        F.lit(dimension).alias("dimension"),
        F.lit(kind).alias("type"),
        low.alias("min"),
        high.alias("max"),
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_json(inventory_documents(spark, sf_dir), "value", gov.INVENTORY)


_NAME = "'part_' || CAST(p_partkey AS VARCHAR)"
_LAYER = "CASE WHEN p_size > 25 THEN 'gold' ELSE 'bronze' END"
_SIZE_TEXT = "CASE WHEN p_size > 30 THEN p_type || ' (PHI)' ELSE p_type END"
_ASPECT = "CASE WHEN p_size > 20 THEN 'data_classification' ELSE 'owner_ship' END"
_TAGS_SQL = (
    f"SELECT {_NAME} AS table_name, 'brand' AS tag_name, p_brand AS tag_value FROM part "
    f"UNION ALL SELECT {_NAME}, 'layer', {_LAYER} FROM part"
)


@query(
    "inventory_comments",
    f"SELECT {_NAME} AS table_name, 0 AS position, NULL AS column_name, p_name AS comment FROM part WHERE p_size > 10 "
    f"UNION ALL SELECT {_NAME}, 1, 'size', {_SIZE_TEXT} FROM part",
)
def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gov.inventory_comments(gov.tables(inventory(spark, sf_dir)))


@query("inventory_tags", _TAGS_SQL)
def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gov.inventory_tags(gov.tables(inventory(spark, sf_dir)))


@query("inventory_tags_from_files", _TAGS_SQL)
def tags_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inventories written as one document per line and scanned from there."""
    path = fresh_path(spark, "inventory")
    inventory_documents(spark, sf_dir).write.text(path)
    return gov.inventory_tags(gov.tables(load_inventory(spark, path, one_per_line=True)))


@query(
    "classified_columns",
    f"SELECT {_NAME} AS table_name, 'size' AS column_name, 'classification' AS tag_name, 'PHI' AS tag_value "
    "FROM part WHERE p_size > 30",
)
def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gov.classify_columns(gov.tables(inventory(spark, sf_dir)))


@query(
    "aspect_tags",
    f"SELECT {_NAME} AS table_name, {_ASPECT} || '_steward' AS tag_name, p_brand AS tag_value FROM part "
    f"UNION ALL SELECT {_NAME}, {_ASPECT} || '_sensitivity', p_type FROM part",
)
def aspect_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gov.flatten_aspects(gov.aspects(inventory(spark, sf_dir)))


@query(
    "rules_to_checks",
    f"SELECT {_NAME} AS table_name, NULL AS constraint_name, 'part_id' AS column_name, 'part_id IS NOT NULL' AS clause "
    f"FROM part UNION ALL SELECT {_NAME}, 'chk_size', 'size', 'size BETWEEN 0 AND ' || CAST(p_size AS VARCHAR) FROM part",
)
def checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gov.rules_to_checks(gov.rules(inventory(spark, sf_dir)))


@query(
    "lineage_sources",
    "SELECT DISTINCT c_mktsegment AS source, n_name AS target FROM customer JOIN nation ON c_nationkey = n_nationkey "
    "WHERE n_name = 'NATION_3'",
)
def lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    edges = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_mktsegment").alias("source"), F.col("n_name").alias("target")
    )
    return gov.lineage_of(edges, "NATION_3")


@query("lineage_edges", f"SELECT 'brand.' || p_brand AS source, {_NAME} AS target FROM part")
def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gov.lineage_edges(inventory(spark, sf_dir))


@query(
    "listed_comments",
    f"SELECT {_NAME} AS table_name, 1 AS position, 'size' AS column_name, {_SIZE_TEXT} AS comment FROM part ORDER BY 1, 2",
)
def listed_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gov.list_comments(comments(spark, sf_dir))


@query("listed_tags", f"SELECT * FROM ({_TAGS_SQL}) ORDER BY 1, 2")
def listed_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gov.list_tags(tags(spark, sf_dir))


@query(
    "listed_column_tags",
    f"SELECT {_NAME} AS table_name, 'size' AS column_name, 'classification' AS tag_name, 'PHI' AS tag_value "
    "FROM part WHERE p_size > 30 ORDER BY 1",
)
def listed_column_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gov.list_column_tags(classified(spark, sf_dir))


@query(
    "listed_checks",
    "SELECT 'chk_size' AS constraint_name, 'size BETWEEN 0 AND ' || CAST(p_size AS VARCHAR) AS clause FROM part",
)
def listed_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gov.list_checks(checks(spark, sf_dir))


@query("listed_required", f"SELECT {_NAME} AS table_name, 'part_id' AS column_name FROM part ORDER BY 1")
def listed_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gov.list_required(checks(spark, sf_dir))


@query(
    "reconcile_tags",
    f"SELECT {_NAME} AS table_name, 'layer' AS tag_name, 'gold' AS tag_value, 'missing' AS status FROM part WHERE p_size > 25",
)
def reconcile_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags of the inventory against a target that lost its gold layer."""
    expected = tags(spark, sf_dir)
    return reconcile_sets(expected, expected.where("tag_value <> 'gold'"), ["table_name", "tag_name", "tag_value"])


@query(
    "masked_customers",
    "SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name ELSE sha256(c_name) END AS c_name, c_mktsegment "
    "FROM customer",
)
def masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return gov.mask(customer, ["c_name"], F.col("c_mktsegment") == "BUILDING")


@query("filtered_customers", "SELECT * FROM customer WHERE c_nationkey < 10")
def filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gov.row_filter(table(spark, sf_dir, "customer"), {"west": "c_nationkey < 10"}, "west")


_PROFILED = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def _profile_sql(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS "
        f"distinct_values, CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM {source}"
        for c in _PROFILED
    )


@query("column_profile", _profile_sql("customer"))
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gov.profile(table(spark, sf_dir, "customer"), _PROFILED, exact=True)


@query(
    "profile_drift",
    "SELECT b.column_name, c.rows - b.rows AS row_change, CAST(0 AS DOUBLE) AS null_ratio_change, "
    "c.distinct_values - b.distinct_values AS distinct_change "
    f"FROM ({_profile_sql('customer')}) b JOIN ({_profile_sql('(SELECT * FROM customer WHERE c_acctbal >= 0)')}) c "
    "ON b.column_name = c.column_name",
)
def profile_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    solvent = customer.where("c_acctbal >= 0")
    return gov.drift(gov.profile(customer, _PROFILED, exact=True), gov.profile(solvent, _PROFILED, exact=True))


_SKETCHED = ["user_id", "event_type", "value"]


@query(
    "profile_sketched",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS \"rows\", count(*) - count({c}) AS nulls, {low} AS min_value, {high} AS max_value, {text} AS min_text, "
        f"CASE WHEN count(DISTINCT {c}) <= 1000 THEN count(DISTINCT {c}) END AS distinct_values FROM events WHERE day(ts) % 2 = 0"
        for c, low, high, text in (
            ("user_id", "CAST(min(user_id) AS DOUBLE)", "CAST(max(user_id) AS DOUBLE)", "NULL"),
            ("event_type", "CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)", "min(event_type)"),
            ("value", "min(value)", "max(value)", "NULL"),
        )
    ),
)
def profile_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second day of the events, from stored sketches of single days; few distinct values are exact, others estimates."""
    path = fresh_path(spark, "sketches")
    sketch(table(spark, sf_dir, "events"), "to_date(ts)", _SKETCHED).write.parquet(path)
    days = spark.read.parquet(path).where("day(to_date(part)) % 2 = 0")
    few = F.when(F.col("distinct_values") <= 1000, F.col("distinct_values")).alias("distinct_values")
    return profile_of(merge(days)).select("column_name", "rows", "nulls", "min_value", "max_value", "min_text", few)


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run event per event type and day, with the rule results of that day."""
    passed_low, passed_high = F.count_if(F.col("value") > 1), F.count_if(F.col("value") <= 300)
    runs = (
        table(spark, sf_dir, "events")
        .groupBy("event_type", F.to_date("ts").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"), passed_low.alias("low"), passed_high.alias("high"))
    )
    entries = F.array(*(_entry(rule, F.col(rule)) for rule in ("low", "high")))
    details = F.struct(F.struct(F.struct(entries.alias("expectations")).alias("data_quality")).alias("flow_progress"))
    return runs.select(
        F.col("day").cast("timestamp").alias("timestamp"),
        F.col("event_type").alias("flow"),
        F.when(F.col("low") < F.col("n"), "FAILED").otherwise("COMPLETED").alias("status"),
        F.col("n").alias("output_rows"),
        F.to_json(details).alias("details"),
    )


def _entry(rule: str, passed: Column) -> Column:
    return F.struct(
        F.lit(rule).alias("name"),
        F.concat(F.lit("silver_"), F.col("event_type")).alias("dataset"),
        passed.alias("passed_records"),
        (F.col("n") - passed).alias("failed_records"),
    )


_RUNS_SQL = (
    "(SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n, count(*) FILTER (WHERE value > 1) AS low, "
    "count(*) FILTER (WHERE value <= 300) AS high FROM events GROUP BY 1, 2) r"
)
_ENTRIES_SQL = (
    f"(SELECT 'silver_' || event_type AS dataset, 'low' AS name, low AS passed_records, n - low AS failed_records, day "
    f"FROM {_RUNS_SQL} UNION ALL SELECT 'silver_' || event_type, 'high', high, n - high, day FROM {_RUNS_SQL}) e"
)


@query(
    "expectation_log",
    f"SELECT dataset, name, passed_records, failed_records FROM {_ENTRIES_SQL} "
    "QUALIFY row_number() OVER (PARTITION BY dataset, name ORDER BY day DESC) = 1",
)
def expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expectation_log(event_log(spark, sf_dir))


@query(
    "expectation_entries_from_files",
    f"SELECT dataset, name, passed_records, failed_records, strftime(day, '%Y-%m-%d') AS day FROM {_ENTRIES_SQL}",
)
def expectations_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log written as JSON lines and scanned from there."""
    path = fresh_path(spark, "event-log")
    event_log(spark, sf_dir).write.json(path)
    entries = expectation_entries(load_event_log(spark, path), keep=["timestamp"])
    return entries.select(
        "dataset", "name", "passed_records", "failed_records", F.date_format("timestamp", "yyyy-MM-dd").alias("day")
    )


_STATUS = "CASE WHEN low < n THEN 'FAILED' ELSE 'COMPLETED' END"


@query(
    "flow_history",
    "SELECT event_type AS flow, count(*) AS events, CAST(sum(n) AS BIGINT) AS output_rows, "
    "count(*) FILTER (WHERE low < n) AS failures, "
    f"arg_max({_STATUS}, day) AS last_status FROM {_RUNS_SQL} GROUP BY 1",
)
def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flow_history(event_log(spark, sf_dir))


_FEEDS_SQL = (
    "SELECT DISTINCT p_brand AS source, p_type AS target FROM part UNION SELECT p_type, 'size ' || p_size FROM part "
    "UNION SELECT 'size ' || (s_suppkey % 50 + 1), 'size ' || (s_suppkey * 7 % 50 + 1) FROM supplier "
    "UNION SELECT 'size ' || (s_nationkey + 1), 'nation ' || s_nationkey FROM supplier"
)


@query(
    "lineage_closure",
    f"WITH RECURSIVE feeds AS ({_FEEDS_SQL}), reach AS (SELECT source AS start, target AS node, 1 AS hops FROM feeds "
    "UNION SELECT r.start, f.target, r.hops + 1 FROM reach r JOIN feeds f ON f.source = r.node WHERE r.hops < 60) "
    "SELECT start, node, min(hops) AS hops FROM reach GROUP BY 1, 2",
)
def lineage_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands feed types, types sizes, sizes each other, also in circles, and some of them nations."""
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    size = lambda number: F.concat(F.lit("size "), number.cast("string"))
    nation = F.concat(F.lit("nation "), F.col("s_nationkey").cast("string"))
    pairs = [
        part.select(F.col("p_brand").alias("source"), F.col("p_type").alias("target")),
        part.select("p_type", size(F.col("p_size"))),
        supplier.select(size(F.col("s_suppkey") % 50 + 1), size(F.col("s_suppkey") * 7 % 50 + 1)),
        supplier.select(size(F.col("s_nationkey") + 1), nation),
    ]
    feeds = pairs[0].union(pairs[1]).union(pairs[2]).union(pairs[3])
    return closure(feeds)


_PART_RULES_SQL = (
    "SELECT p_brand || '.' || (p_partkey % 20) AS table_name, 'r' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS name, "
    "CASE WHEN p_partkey % 7 = 6 THEN 'kind' WHEN p_partkey % 13 = 5 THEN 'weight' ELSE 'size' END AS column_name, "
    "CASE WHEN p_partkey % 7 = 6 THEN 'set' WHEN p_partkey % 13 = 5 THEN 'range' WHEN p_partkey % 5 = 3 THEN 'null' "
    "WHEN p_partkey % 17 = 4 THEN 'order' ELSE 'range' END AS kind, "
    "CAST(p_size - 18 AS DOUBLE) AS lo, CAST(p_size + 22 AS DOUBLE) AS hi, p_type AS v, p_partkey % 2 = 0 AS ignore_null FROM part"
)


@query(
    "rule_conflicts",
    f"WITH r AS (SELECT table_name, name, column_name, kind, CASE WHEN kind = 'range' THEN lo ELSE '-infinity'::DOUBLE END AS low, "
    "CASE WHEN kind = 'range' THEN hi ELSE 'infinity'::DOUBLE END AS high, CASE WHEN kind = 'set' THEN v END AS v, "
    f"ignore_null AND kind <> 'null' AS null_passes FROM ({_PART_RULES_SQL})), "
    "own AS (SELECT table_name, column_name, max(low) AS low, min(high) AS high, count(DISTINCT v) AS sets, bool_and(null_passes) AS null_passes FROM r GROUP BY 1, 2), "
    "ordered AS (SELECT DISTINCT table_name FROM r WHERE kind = 'order'), "
    "lim AS (SELECT o.table_name, o.column_name, o.sets, o.null_passes, "
    "CASE WHEN o.column_name = 'weight' AND d.table_name IS NOT NULL THEN greatest(o.low, coalesce(s.low, o.low)) ELSE o.low END AS low, "
    "CASE WHEN o.column_name = 'size' AND d.table_name IS NOT NULL THEN least(o.high, coalesce(w.high, o.high)) ELSE o.high END AS high "
    "FROM own o LEFT JOIN ordered d ON d.table_name = o.table_name "
    "LEFT JOIN own s ON s.table_name = o.table_name AND s.column_name = 'size' LEFT JOIN own w ON w.table_name = o.table_name AND w.column_name = 'weight'), "
    "judged AS (SELECT r.*, (low > '-infinity'::DOUBLE AND row_number() OVER (PARTITION BY table_name, column_name ORDER BY low DESC, name) = 1) OR "
    "(high < 'infinity'::DOUBLE AND row_number() OVER (PARTITION BY table_name, column_name ORDER BY high, name) = 1) OR "
    "(v IS NOT NULL AND row_number() OVER (PARTITION BY table_name, column_name, v ORDER BY name) = 1) OR kind = 'order' AS wanted FROM r), "
    "named AS (SELECT *, wanted OR (NOT null_passes AND row_number() OVER (PARTITION BY table_name, column_name ORDER BY null_passes, wanted DESC, name) = 1) AS needed FROM judged) "
    "SELECT n.table_name, n.name, n.column_name, CASE WHEN (lim.low > lim.high OR lim.sets > 1) AND NOT lim.null_passes THEN 'contradicted' "
    "WHEN needed THEN 'needed' ELSE 'redundant' END AS verdict FROM named n JOIN lim ON lim.table_name = n.table_name AND lim.column_name = n.column_name",
)
def conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part is a rule of one of the tables of its brand: on a size, on a kind, or that a size is not above a weight."""
    part, key = table(spark, sf_dir, "part"), F.col("p_partkey")
    column = F.when(key % 7 == 6, "kind").when(key % 13 == 5, "weight").otherwise("size")
    kind = F.when(key % 7 == 6, SET).when(key % 13 == 5, RANGE).when(key % 5 == 3, NON_NULL).when(key % 17 == 4, NOT_ABOVE).otherwise(RANGE)
    rules = part.select(
        F.concat("p_brand", F.lit("."), (key % 20).cast("string")).alias("table_name"),
        F.concat(F.lit("r"), F.lpad(key.cast("string"), 9, "0")).alias("name"),
        column.alias("column"),
        kind.alias("type"),
        (F.col("p_size") - 18).cast("string").alias("min"),
        (F.col("p_size") + 22).cast("string").alias("max"),
        F.array("p_type").alias("values"),
        F.lit("weight").alias("other"),
        (key % 2 == 0).alias("ignore_null"),
    )
    return rule_conflicts(rules)


@query(
    "inventory_rules_measured",
    f"SELECT {_NAME} AS table_name, 'part_id' AS \"column\", 'non_null_expectation' AS type, NULL AS min, NULL AS max, "
    "count(l_partkey) AS row_count, count(l_partkey) AS passed_rows, CAST(1 AS DOUBLE) AS pass_ratio, true AS passed "
    "FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY p_partkey UNION ALL "
    f"SELECT {_NAME}, 'size', 'range_expectation', '0', CAST(p_size AS VARCHAR), count(l_partkey), count(*) FILTER (l_quantity BETWEEN 0 AND p_size), "
    "CASE WHEN count(l_partkey) = 0 THEN 1.0 ELSE count(*) FILTER (l_quantity BETWEEN 0 AND p_size)::DOUBLE / count(l_partkey) END, "
    "count(*) FILTER (l_quantity BETWEEN 0 AND p_size) = count(l_partkey) "
    "FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY p_partkey, p_size",
)
def inventory_rules_measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules of all inventories, each executed on the table it names: the order lines of that part."""
    lines = table(spark, sf_dir, "lineitem")
    name = F.concat(F.lit("part_"), F.col("l_partkey").cast("string")).alias("table_name")
    rows = lines.select(name, F.col("l_partkey").alias("part_id"), F.col("l_quantity").alias("size"))
    return measured_rules(gov.rules(inventory(spark, sf_dir)), rows, ["part_id", "size"])


_STEPS_SQL = (
    "SELECT CAST(ts AS DATE) AS run, 'user ' || (user_id % 40) AS flow, sum(CAST(round(value * 100) AS BIGINT)) AS seconds FROM events GROUP BY 1, 2"
)
_WAITS_SQL = "SELECT DISTINCT 'user ' || (s_suppkey % 40) AS source, 'user ' || ((s_suppkey % 40) * 2 + 1 + s_nationkey % 2) AS flow FROM supplier"


@query(
    "flow_critical_path",
    f"WITH RECURSIVE steps AS ({_STEPS_SQL}), waits AS ({_WAITS_SQL}), "
    "chains AS (SELECT run, flow, seconds AS ends, [flow] AS way FROM steps UNION ALL "
    "SELECT s.run, s.flow, c.ends + s.seconds, list_append(c.way, s.flow) FROM chains c JOIN waits w ON w.source = c.flow JOIN steps s ON s.run = c.run AND s.flow = w.flow), "
    "best AS (SELECT run, arg_max(way, ends) AS way FROM chains GROUP BY run) "
    "SELECT b.run, p.position, s.flow, s.seconds, sum(s.seconds) OVER (PARTITION BY b.run ORDER BY p.position)::BIGINT AS finished_after "
    "FROM best b, unnest(range(1, len(way) + 1)) AS p(position) JOIN steps s ON s.run = b.run AND s.flow = b.way[p.position]",
)
def flow_critical_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day is a run, users are its flows, and who waits for whom comes from suppliers."""
    events, supplier = table(spark, sf_dir, "events"), table(spark, sf_dir, "supplier")
    user = lambda number: F.concat(F.lit("user "), number.cast("string"))
    cents = F.round(F.col("value") * 100).cast("bigint")
    steps = events.select(F.to_date("ts").alias("run"), user(F.col("user_id") % 40).alias("flow"), cents.alias("seconds"))
    key = F.col("s_suppkey") % 40
    return critical_path(steps, supplier.select(user(key).alias("source"), user(key * 2 + 1 + F.col("s_nationkey") % 2).alias("target")))
