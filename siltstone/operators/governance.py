"""A metadata inventory turned into rows: comments, tags, checks, lineage.

The inventory is read with :data:`INVENTORY` as its schema.  ``tables``,
``aspects`` and ``rules`` open it up into one row per described thing; the
other operators work on those rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.casts import tag_key
from siltstone.operators.scan import NON_NULL, RANGE

# Fixed value: layout of the inventory document.
INVENTORY = """
    metadata map<string, struct<
        description: string, labels: map<string,string>, columns: map<string,string>>>,
    aspects map<string, struct<aspect_type: string, data: map<string,string>>>,
    data_quality struct<
        target: string,
        rules: array<struct<`column`: string, dimension: string, type: string, min: string, max: string>>,
        latest_result: struct<
            passed: boolean, row_count: bigint,
            rules: array<struct<`column`: string, passed: boolean, pass_ratio: double>>>>,
    lineage array<struct<source: string, target: string>>
"""

# Word that marks protected columns, and the tag they get.
PROTECTED_WORD = "PHI"
PROTECTED_TAG = "classification"


def tables(inventory: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """``table_name, description, labels, columns``, derived tables left out by name."""
    opened = inventory.select(F.explode("metadata").alias("table_name", "m")).select("table_name", "m.*")
    return opened.where(~F.col("table_name").isin(list(exclude))) if exclude else opened


def aspects(inventory: DataFrame) -> DataFrame:
    return inventory.select(F.explode("aspects").alias("table_name", "a")).select("table_name", "a.*")


def rules(inventory: DataFrame) -> DataFrame:
    return inventory.select(
        F.col("data_quality.target").alias("table_name"), F.explode("data_quality.rules").alias("r")
    ).select("table_name", "r.*")


def lineage_edges(inventory: DataFrame) -> DataFrame:
    return inventory.select(F.inline("lineage"))


def inventory_comments(described: DataFrame) -> DataFrame:
    """Comments of tables (``column_name`` NULL, position 0) and columns; absent ones give no row."""
    own = F.struct(
        F.lit(0).alias("position"), F.lit(None).cast("string").alias("column_name"), F.col("description").alias("comment")
    )
    inner = F.transform(
        F.map_entries(F.coalesce("columns", F.create_map().cast("map<string,string>"))),
        lambda e, i: F.struct((i + 1).alias("position"), e["key"].alias("column_name"), e["value"].alias("comment")),
    )
    return described.select("table_name", F.inline(F.concat(F.array(own), inner))).where(
        F.col("comment").isNotNull() & (F.col("comment") != "")
    )


def inventory_tags(described: DataFrame) -> DataFrame:
    """Labels as tags: ``table_name, tag_name, tag_value``."""
    return described.select("table_name", F.explode("labels").alias("tag_name", "tag_value"))


def classify_columns(described: DataFrame, word: str = PROTECTED_WORD, tag: str = PROTECTED_TAG) -> DataFrame:
    """Columns whose description contains the word, tagged with it."""
    return (
        described.select("table_name", F.explode("columns").alias("column_name", "description"))
        .where(F.col("description").contains(word))
        .select("table_name", "column_name", F.lit(tag).alias("tag_name"), F.lit(word).alias("tag_value"))
    )


def flatten_aspects(aspect_rows: DataFrame) -> DataFrame:
    """Aspect fields as tags named ``<aspect type>_<field>``."""
    return aspect_rows.select(
        "table_name", tag_key("aspect_type").alias("prefix"), F.explode("data").alias("field", "tag_value")
    ).select("table_name", F.concat_ws("_", "prefix", "field").alias("tag_name"), "tag_value")


def rules_to_checks(rule_rows: DataFrame) -> DataFrame:
    """Constraints: ``table_name, constraint_name, column_name, clause``; other rule types and ranges without bounds are skipped."""
    column, kind = F.col("`column`"), F.col("type")
    bounded = (kind != RANGE) | F.col("min").isNotNull() | F.col("max").isNotNull()
    return rule_rows.where(kind.isin(NON_NULL, RANGE) & bounded).select(
        "table_name",
        F.when(kind == RANGE, F.concat(F.lit("chk_"), column)).alias("constraint_name"),
        column.alias("column_name"),
        F.when(kind == NON_NULL, F.concat(column, F.lit(" IS NOT NULL")))
        .when(F.col("max").isNull(), F.concat(column, F.lit(" >= "), F.col("min")))
        .when(F.col("min").isNull(), F.concat(column, F.lit(" <= "), F.col("max")))
        .otherwise(F.concat(column, F.lit(" BETWEEN "), F.col("min"), F.lit(" AND "), F.col("max")))
        .alias("clause"),
    )


def invalid_rules(rule_rows: DataFrame) -> DataFrame:
    """Rules that cannot be checked, with ``problem``: range rules without any bound, rules without a column."""
    unbounded = (F.col("type") == RANGE) & F.col("min").isNull() & F.col("max").isNull()
    problem = F.when(F.col("`column`").isNull(), "no column").when(unbounded, "no bound")
    return rule_rows.withColumn("problem", problem).where(F.col("problem").isNotNull())


def scan_rules(rule_rows: DataFrame, target: str, most: int | None = None) -> list[dict[str, str]]:
    """The rules of one table in the form :func:`siltstone.operators.scan.scan_report` takes.

    The rules of one table are configuration and are brought to the driver; with ``most``
    a table that has more of them is refused.  Types without their values and range rules
    without bounds are skipped, see :func:`invalid_rules`.
    """
    bounded = (F.col("type") != RANGE) | F.col("min").isNotNull() | F.col("max").isNotNull()
    of_table = (F.col("table_name") == target) & F.col("type").isin(NON_NULL, RANGE)
    wanted = rule_rows.where(of_table & bounded).drop("table_name")
    found = wanted.collect() if most is None else wanted.take(most + 1)
    if most is not None and len(found) > most:
        raise ValueError(f"more than {most} rules for {target}")
    return [{name: value for name, value in row.asDict().items() if value is not None} for row in found]


def lineage_of(edges: DataFrame, target: str | Column) -> DataFrame:
    """Distinct direct sources of a target."""
    wanted = F.lit(target) if isinstance(target, str) else target
    return edges.where((F.col("target") == wanted) & F.col("source").isNotNull()).select("source", "target").distinct()


def list_comments(comments: DataFrame) -> DataFrame:
    """Described columns in the order of their tables."""
    described = comments.where(F.col("column_name").isNotNull() & F.col("comment").isNotNull())
    return described.select("table_name", "position", "column_name", "comment").orderBy("table_name", "position")


def list_tags(tags: DataFrame) -> DataFrame:
    return tags.select("table_name", "tag_name", "tag_value").orderBy("table_name", "tag_name")


def list_column_tags(tags: DataFrame) -> DataFrame:
    return tags.select("table_name", "column_name", "tag_name", "tag_value").orderBy("table_name", "column_name")


def list_checks(checks: DataFrame) -> DataFrame:
    return checks.where(F.col("constraint_name").isNotNull()).select("constraint_name", "clause").orderBy("constraint_name")


def list_required(checks: DataFrame) -> DataFrame:
    """Columns that must not be NULL."""
    return checks.where(F.col("constraint_name").isNull()).select("table_name", "column_name").orderBy("table_name")


def mask(df: DataFrame, columns: Sequence[str], reveal: Column) -> DataFrame:
    """Hash the named columns on rows where ``reveal`` is not true."""
    hidden = {c: F.when(reveal, F.col(c).cast("string")).otherwise(F.sha2(F.col(c).cast("string"), 256)) for c in columns}
    return df.withColumns(hidden)


def row_filter(df: DataFrame, policy: Mapping[str, str], role: str) -> DataFrame:
    """Rows the role may see; a role without a policy sees none."""
    return df.filter(F.expr(policy[role])) if role in policy else df.filter(F.lit(False))


def profile(df: DataFrame, columns: Sequence[str], exact: bool = False) -> DataFrame:
    """Per column: rows, NULLs, distinct values, smallest and largest, in one scan.

    Distinct values are estimated (one sketch per column); ``exact`` counts
    them, in a scan of each column alone.  Counted together, each value takes
    a row as wide as all columns and their results, and a task holds those of all
    columns at once.
    """
    measured = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *(
            F.struct(
                F.count(F.col(c)).alias("filled"),
                *([] if exact else [F.approx_count_distinct(F.col(c)).alias("distinct_values")]),
                F.min(c).cast("string").alias("min_value"),
                F.max(c).cast("string").alias("max_value"),
            ).alias(c)
            for c in columns
        ),
    )
    entries = F.array(
        *(
            F.struct(
                F.lit(c).alias("column_name"),
                F.col("rows"),
                (F.col("rows") - F.col(f"`{c}`.filled")).alias("nulls"),
                (_distinct(df, c) if exact else F.col(f"`{c}`.distinct_values")).alias("distinct_values"),
                F.col(f"`{c}`.min_value").alias("min_value"),
                F.col(f"`{c}`.max_value").alias("max_value"),
            )
            for c in columns
        )
    )
    return measured.select(F.inline(entries))


def _distinct(df: DataFrame, column: str) -> Column:
    return F.coalesce(df.select(F.col(column)).distinct().agg(F.count(F.col(column))).scalar(), F.lit(0))


def drift(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """Change of two profiles, column by column; both hold one row per column."""
    b, c = baseline.alias("b"), current.alias("c")
    ratio = lambda side: F.col(f"{side}.nulls") / F.greatest(F.col(f"{side}.rows"), F.lit(1))
    return b.join(c, F.col("b.column_name").eqNullSafe(F.col("c.column_name")), "full_outer").select(
        F.coalesce("b.column_name", "c.column_name").alias("column_name"),
        (F.col("c.rows") - F.col("b.rows")).alias("row_change"),
        F.round(ratio("c") - ratio("b"), 6).alias("null_ratio_change"),
        (F.col("c.distinct_values") - F.col("b.distinct_values")).alias("distinct_change"),
    )
