"""Rules applied to rows in flight: drop, quarantine, fail, measure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.names import VERDICT, refuse_reserved
from siltstone.functions.rules import NULL_RULE_INPUT, Rules, conjunction, first_reason, holds, passes
from siltstone.sources.writers import write_table

PASSED = "silver"
BROKEN = "quarantine"


def expect_or_drop(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows that satisfy every rule.

    The plain conjunction is enough, since a filter drops NULL too, and unlike
    a coalesced one it reaches the parquet scan.
    """
    return df.filter(conjunction(rules)) if rules else df


def quarantine(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows that break at least one rule, all columns kept; exact complement of the above."""
    return df.filter(~passes(rules))


def with_reason(
    df: DataFrame,
    reasons: Sequence[tuple[str | Column, str]],
    default: str = NULL_RULE_INPUT,
    column: str = "quarantine_reason",
) -> DataFrame:
    """Label each row with the first condition it meets."""
    return df.withColumn(column, first_reason(reasons, default))


def with_verdict(df: DataFrame, rules: Rules) -> DataFrame:
    """Both outcomes in one frame, so a partitioned write splits in a single pass."""
    return refuse_reserved(df).withColumn(VERDICT, F.when(passes(rules), F.lit(PASSED)).otherwise(F.lit(BROKEN)))


def assert_rows(df: DataFrame, condition: str | Column, message: str, enabled: bool = True) -> DataFrame:
    """Raise at run time on the first row where the condition is not true.

    The assertion sits in a filter: as a column it would vanish as soon as
    nobody selects it.
    """
    if not enabled:
        return df
    return df.filter(F.assert_true(holds(condition), message).isNull())


def expect_or_fail(df: DataFrame, rules: Rules) -> DataFrame:
    """Raise, naming the rule, on the first row that breaks one.

    Filters added behind this may be pushed below it and hide a violation.
    Use :func:`validated_table` wherever the result has readers.
    """
    if not rules:
        return df
    verdict = None
    for name, rule in rules.items():
        fault = F.raise_error(F.lit(f"rule {name} broken: {rule}")).cast("boolean")
        arm = ~holds(rule)
        verdict = F.when(arm, fault) if verdict is None else verdict.when(arm, fault)
    return df.filter(verdict.otherwise(F.lit(True)))


def validated_table(spark: SparkSession, df: DataFrame, rules: Rules, path: str) -> DataFrame:
    """Write the checked rows to a new folder and read them back.

    The write evaluates every row; if it fails, ``path`` has no finished table
    and whatever was published before is untouched.
    """
    return spark.read.schema(df.schema).parquet(write_table(expect_or_fail(df, rules), path, mode="error"))


def forced_fault(df: DataFrame, key: str, condition: str, message: str, inject: bool) -> DataFrame:
    """A branch that fails on its first row while ``inject`` is set, and recovers after."""
    if inject:
        return assert_rows(df, condition, message).select(key)
    return df.select(key, F.lit("recovered").alias("status"))


def expectation_counts(rules: Rules) -> list[Column]:
    """Aggregates: rows, and rows passed per rule, to be used in one pass."""
    passed = [F.count_if(holds(rule)).alias(f"passed_{i}") for i, rule in enumerate(rules.values())]
    return [F.count(F.lit(1)).alias("rows"), *passed]


def expectation_metrics(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per rule: ``name, passed_records, failed_records``; one scan for all rules."""
    entries = [
        F.struct(
            F.lit(name).alias("name"),
            F.col(f"passed_{i}").alias("passed_records"),
            (F.col("rows") - F.col(f"passed_{i}")).alias("failed_records"),
        )
        for i, name in enumerate(rules)
    ]
    if not entries:
        return df.sparkSession.createDataFrame([], "name string, passed_records long, failed_records long")
    return df.agg(*expectation_counts(rules)).select(F.inline(F.array(*entries)))


def observed(df: DataFrame, rules: Rules, name: str = "expectations") -> tuple[DataFrame, Observation]:
    """Collect the same counts while the frame is being written, at no extra scan."""
    observation = Observation(name)
    return df.observe(observation, *expectation_counts(rules)), observation


def observed_metrics(observation: Observation, rules: Rules) -> list[dict]:
    """The rows of :func:`expectation_metrics` from a finished observation."""
    got = observation.get
    return [
        {"name": name, "passed_records": got[f"passed_{i}"], "failed_records": got["rows"] - got[f"passed_{i}"]}
        for i, name in enumerate(rules)
    ]


def at_least(df: DataFrame, column: str, minimum: float) -> DataFrame:
    """Rows whose value reaches a run parameter."""
    return df.filter(F.col(column) >= F.lit(minimum))

