"""Ordered heads and pages.  Nothing here sorts more than it returns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.operators.ranges import PLACE, bounds_of, has_quantiles, range_of, within

#: Ranges that a column is divided into at a time, and rows that are few enough to be sorted.
RANGES, FEW = 256, 100_000


def top_k(df: DataFrame, order: Sequence[str | Column], k: int, tie_break: Sequence[str | Column] = ()) -> DataFrame:
    """First ``k`` rows; the tie-break makes the choice repeatable."""
    return df.orderBy(*order, *tie_break).limit(k)


def page(df: DataFrame, order: Sequence[str | Column], offset: int, limit: int) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(limit)


def deep_page(df: DataFrame, order: Sequence[str], offset: int, limit: int, ranges: int = RANGES, few: int = FEW) -> DataFrame:
    """The page that begins behind ``offset`` rows, however many these are, in the order of Spark's ``orderBy``.

    ``order`` names columns; a minus in front means from the greatest down.  The column is divided into ranges
    of about as many rows, their rows are counted, and only ranges that the page touches are looked at again,
    until they are few.  Rows that tie there are divided by the next column.  Only what is left is sorted:
    with an order without ties that is about the page, and no task gets the rows before it.

    Columns without quantiles, as texts, are ordered by sorting what the columns before them leave.
    """
    sort = [F.col(n[1:]).desc() if n.startswith("-") else F.col(n).asc() for n in order]
    rest = df
    for name in order:
        column, down = F.col(name.removeprefix("-")), name.startswith("-")
        if not has_quantiles(df.schema[name.removeprefix("-")].dataType):
            break
        before = None
        while True:
            bounds = bounds_of(rest.select(column.alias(PLACE)), ranges)
            counted = rest.groupBy(range_of(column, bounds).alias("r")).agg(F.count(F.lit(1)).alias("n")).collect()
            total = sum(r["n"] for r in counted)
            if total <= few or total == before or offset >= total:
                break
            touched, passed, skipped = [], 0, 0
            for row in sorted(counted, key=lambda r: r["r"], reverse=down):
                if passed + row["n"] <= offset:
                    skipped = passed + row["n"]
                elif passed < offset + limit:
                    touched.append(row["r"])
                passed += row["n"]
            if not touched:
                return df.limit(0)
            rest, offset, before = rest.where(within(column, bounds, touched)), offset - skipped, total
        if total <= few or offset >= total:
            break
        # the next column tells rows apart only where all of them tie in this one
        ends = rest.agg(F.min(column).alias("low"), F.max(column).alias("high"), F.count(column).alias("filled")).first()
        if ends["low"] != ends["high"] or ends["filled"] not in (0, total):
            break
    return rest.orderBy(*sort).offset(offset).limit(limit)
