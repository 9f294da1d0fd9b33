"""Ranges of a column with about as many rows each."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DatetimeType, NumericType

PLACE = "__place"


def has_quantiles(kind: DataType) -> bool:
    return isinstance(kind, (NumericType, DatetimeType))


def bounds_of(places: DataFrame, fan: int) -> list:
    """Places that divide the rows into about ``fan`` even parts: NULL is a part of its own."""
    parts = [i / fan for i in range(1, fan)]
    found = places.agg(F.percentile_approx(PLACE, parts, 10 * fan)).first()[0]
    return sorted(set(found or []))


def range_of(place: Column, bounds: list) -> Column:
    """Number of the range: how many bounds are not above the place; -1 for NULL."""
    if not bounds:
        return F.when(place.isNull(), -1).otherwise(0)
    below = F.size(F.filter(F.array(*(F.lit(b) for b in bounds)), lambda b: b <= place))
    return F.when(place.isNull(), -1).otherwise(below)


def within(place: Column, bounds: list, ranges: Sequence[int]) -> Column:
    """Whether a place is in one of the ranges, neighbouring ones joined: comparisons that a scan can use."""
    runs: list[list[int]] = []
    for number in sorted(r for r in ranges if r >= 0):
        if runs and runs[-1][1] == number - 1:
            runs[-1][1] = number
        else:
            runs.append([number, number])
    wanted = [place.isNull()] if -1 in ranges else []
    for first, last in runs:
        low = place >= F.lit(bounds[first - 1]) if first else place.isNotNull()
        wanted.append(low & (place < F.lit(bounds[last])) if last < len(bounds) else low)
    return reduce(lambda a, b: a | b, wanted)
