"""Enrichment from reference tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.operators.skew import BROADCAST_ROWS, fits_broadcast, skew_left_join


def enrich(
    facts: DataFrame,
    ref: DataFrame,
    on: Sequence[str],
    select: Sequence[str],
    rename: Mapping[str, str] | None = None,
    max_broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Left join of a batch or a stream with a reference table; unmatched rows stay.

    The reference is broadcast once a bounded count has shown that it is small.
    A larger one is joined by shuffle, hot keys of a batch being spread out; for
    a stream with such a reference :func:`siltstone.streaming.enrich.run_enriched`
    does that batch by batch.  A column that both sides have needs a new name.
    """
    rename = rename or {}
    added = [rename.get(c, c) for c in select]
    taken = {c.lower() for c in facts.columns}
    if clash := [c for c in added if c.lower() in taken]:
        raise ValueError(f"both sides have {', '.join(clash)}: rename the columns of the reference")
    dims = ref.select(*on, *(F.col(c).alias(rename.get(c, c)) for c in select))
    if fits_broadcast(dims, max_broadcast_rows):
        joined = facts.join(F.broadcast(dims), list(on), "left")
    elif facts.isStreaming:
        joined = facts.join(dims, list(on), "left")
    else:
        return skew_left_join(facts, dims, on)
    return joined.select(*facts.columns, *added)


def readings_by(
    facts: DataFrame,
    dim: DataFrame,
    on: str,
    by: str,
    value: str,
    digits: int = 2,
    devices: str | None = "devices",
) -> DataFrame:
    """Readings, mean value and distinct keys per dimension attribute.

    Facts are summed per key before the join, so the join sees one row per key
    however unevenly the facts are spread.
    """
    per_key = facts.where(F.col(on).isNotNull()).groupBy(on).agg(
        F.count(F.lit(1)).alias("__n"), F.count(value).alias("__values"), F.sum(value).alias("__sum")
    )
    measures: list[Column] = [
        F.sum("__n").alias("readings"),
        F.round(F.sum("__sum") / F.sum("__values"), digits).alias("avg_value"),
    ]
    if devices:
        measures.append(F.count_distinct(F.col(on)).alias(devices))
    return per_key.join(dim.select(on, by), on).groupBy(by).agg(*measures)


def known(
    facts: DataFrame, ref: DataFrame, on: Sequence[str], max_broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Rows whose key occurs in the reference."""
    return _by_membership(facts, ref.select(*on), list(on), True, max_broadcast_rows)


def unknown(
    facts: DataFrame, ref: DataFrame, on: Sequence[str], max_broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Rows whose key does not, those with a NULL in it included."""
    return _by_membership(facts, ref.select(*on), list(on), False, max_broadcast_rows)


def _by_membership(facts: DataFrame, keys: DataFrame, on: list[str], member: bool, max_rows: int) -> DataFrame:
    if fits_broadcast(keys, max_rows):
        return facts.join(F.broadcast(keys), on, "left_semi" if member else "left_anti").select(*facts.columns)
    marked = skew_left_join(facts, keys.distinct().withColumn("__member", F.lit(True)), on)
    found = F.col("__member").isNotNull()
    return marked.where(found if member else ~found).drop("__member")
