"""Named rules (SQL booleans) compiled to columns.

A row passes a rule only when the rule is true.  A rule that comes out NULL
counts as broken: that is what keeps *passed + broken = input* without loss.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Rules = Mapping[str, str]

# Reason texts of quarantined telemetry.
NULL_RULE_INPUT = "null_rule_input"


def rule_column(rule: str | Column) -> Column:
    return F.expr(rule) if isinstance(rule, str) else rule


def conjunction(rules: Rules) -> Column:
    """All rules ANDed, NULL left as it is: the form the scan can push down."""
    combined = F.lit(True)
    for position, rule in enumerate(rules.values()):
        combined = rule_column(rule) if position == 0 else combined & rule_column(rule)
    return combined


def holds(rule: str | Column) -> Column:
    """True or false, never NULL."""
    return F.coalesce(rule_column(rule), F.lit(False))


def passes(rules: Rules) -> Column:
    """True where every rule holds; never NULL.  No rules: always true."""
    return holds(conjunction(rules)) if rules else F.lit(True)


def first_reason(reasons: Sequence[tuple[str | Column, str]], default: str = NULL_RULE_INPUT) -> Column:
    """The label of the first condition that is true."""
    chain = None
    for condition, label in reasons:
        arm = rule_column(condition)
        chain = F.when(arm, F.lit(label)) if chain is None else chain.when(arm, F.lit(label))
    return F.lit(default) if chain is None else chain.otherwise(F.lit(default))


def range_arms(category: str, value: str, bounds: Mapping[str, tuple[float, float]]) -> str:
    """Rule text: the value lies in the range its category allows.

    Bounds come from configuration, so names are quoted as SQL literals and
    limits go through ``float``; an unknown category never passes.
    """
    arms = []
    for name, (low, high) in bounds.items():
        literal = name.replace("\\", "\\\\").replace("'", "\\'")
        arms.append(f"(`{category}` = '{literal}' AND `{value}` BETWEEN {_number(low)} AND {_number(high)})")
    return " OR ".join(arms) or "false"


def range_rule(category: str, value: str, bounds: Mapping[str, tuple[float, float]]) -> str:
    """The same, with a NULL value ruled out."""
    return f"`{value}` IS NOT NULL AND ({range_arms(category, value, bounds)})"


def _number(limit: float) -> str:
    limit = float(limit)
    return str(int(limit)) if limit.is_integer() else f"{limit!r}D"
