"""Scan reports: column rules measured over a stored table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rule types of a metadata inventory.
NON_NULL = "non_null_expectation"
RANGE = "range_expectation"
SET = "set_expectation"
REGEX = "regex_expectation"


def rule_holds(df: DataFrame, rule: Mapping[str, Any]) -> Column:
    """Truth of one rule on a row.  NULL fails unless the rule says ``ignore_null``."""
    column, kind = F.col(rule["column"]), rule["type"]
    if kind == NON_NULL:
        return column.isNotNull()
    if kind == RANGE:
        # bounds arrive as text and are compared in the column's own type
        of_column = df.schema[rule["column"]].dataType
        limits = [
            compare(F.lit(rule[end]).cast(of_column))
            for end, compare in (("min", column.__ge__), ("max", column.__le__))
            if rule.get(end) is not None
        ]
        if not limits:
            raise ValueError(f"range rule on {rule['column']} has neither min nor max")
        ok = limits[0] & limits[1] if len(limits) == 2 else limits[0]
    elif kind == SET:
        ok = column.isin(list(rule["values"]))
    elif kind == REGEX:
        ok = column.rlike(rule["regex"])
    else:
        raise ValueError(f"unknown rule type {kind!r}")
    return F.coalesce(ok, F.lit(bool(rule.get("ignore_null", False))))


def _measured(df: DataFrame, rules: Sequence[Mapping[str, Any]]) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *(F.count_if(rule_holds(df, rule)).alias(f"ok_{i}") for i, rule in enumerate(rules)),
    )


def _entries(rules: Sequence[Mapping[str, Any]]) -> Column:
    entries = []
    for i, rule in enumerate(rules):
        ratio = F.when(F.col("row_count") > 0, F.col(f"ok_{i}") / F.col("row_count")).otherwise(F.lit(1.0))
        entries.append(
            F.struct(
                F.lit(rule["column"]).alias("column"),
                F.lit(rule.get("dimension")).cast("string").alias("dimension"),
                F.lit(rule["type"]).alias("type"),
                (ratio >= F.lit(float(rule.get("threshold", 1.0)))).alias("passed"),
                F.round(ratio, 2).alias("pass_ratio"),
            )
        )
    return F.array(*entries)


def scan_report(df: DataFrame, rules: Sequence[Mapping[str, Any]]) -> DataFrame:
    """One row per rule; all rules are measured in one scan."""
    return _measured(df, rules).select(F.inline(_entries(rules)))


def scan_verdict(df: DataFrame, rules: Sequence[Mapping[str, Any]]) -> DataFrame:
    """One row: overall verdict, rows seen and the per-rule results."""
    return _measured(df, rules).select("row_count", _entries(rules).alias("rules")).select(
        F.forall("rules", lambda r: r["passed"]).alias("passed"), "row_count", "rules"
    )


def measured_rules(rule_rows: DataFrame, rows: DataFrame, columns: Sequence[str], table: str = "table_name") -> DataFrame:
    """Rules of many tables executed on the rows of the tables they name, in one pass.

    ``rows`` holds the rows of all tables, told apart by ``table``; ``rule_rows`` has table_name, column, type, min and max,
    as an inventory gives them.  One row per rule: table_name, column, type, min, max, row_count, passed_rows, pass_ratio
    and passed.  Only rules on ``columns`` are measured, and types without their values are not.  NULL breaks a rule; a rule
    on a table without rows passes.  Values are counted per table and column before they meet their rules, so a table
    with most of all rows is no hot key.
    """
    wanted = rule_rows.where(F.col("`column`").isin(list(columns)) & F.col("type").isin(NON_NULL, RANGE))
    wanted = wanted.select("table_name", "column", "type", "min", "max")
    each = F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns)))
    values = rows.select(F.col(table).alias("table_name"), each).groupBy("table_name", "column", "value").agg(F.count(F.lit(1)).alias("n"))
    limit = lambda end, none: F.coalesce(F.col(end).cast("double"), F.lit(none))
    ok = F.col("value").isNotNull()
    ok = ok & ((F.col("type") == NON_NULL) | F.col("value").between(limit("min", float("-inf")), limit("max", float("inf"))))
    met = wanted.join(values, ["table_name", "column"], "left").groupBy("table_name", "column", "type", "min", "max")
    counted = met.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.coalesce(F.sum(F.when(ok, F.col("n")).otherwise(0)), F.lit(0)).alias("passed_rows"))
    ratio = F.when(F.col("row_count") > 0, F.col("passed_rows") / F.col("row_count")).otherwise(1.0)
    return counted.withColumn("pass_ratio", ratio).withColumn("passed", F.col("passed_rows") == F.col("row_count"))
