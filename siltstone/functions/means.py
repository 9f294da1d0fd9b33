"""Rounded means."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded_mean(column: str, digits: int) -> Column:
    return F.round(F.avg(column), digits)


def stable_mean(column: str, digits: int, scale: int = 2) -> Column:
    """Rounded mean that does not depend on the order of summation.

    Values are taken as whole units of ``10**-scale`` and summed as longs, so
    partial sums are exact whatever the partitioning or a retried task does.
    Only for columns that carry at most ``scale`` decimals.
    """
    unit = 10**scale
    total = F.sum(F.round(F.col(column) * unit).cast("bigint"))
    mean = total.cast("double") / F.count(column) / F.lit(float(unit))
    return F.round(mean.cast("decimal(18,6)"), digits).cast("double")


def stable_sum(column: str, scale: int = 2) -> Column:
    """Sum with the same guarantee as :func:`stable_mean`."""
    unit = 10**scale
    return F.sum(F.round(F.col(column) * unit).cast("bigint")).cast("double") / F.lit(float(unit))
