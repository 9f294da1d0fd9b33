"""Joins with the version that was valid at the time of a fact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.operators.chunks import CHUNK, SEQ, cuts_of, with_chunk
from siltstone.operators.skew import SHARES, any_null

_VERSION = "__version"
_FACT = "__fact"
_CARRY = "__carry"


def enrich_as_of(
    facts: DataFrame,
    versions: DataFrame,
    on: Sequence[str],
    at: str,
    valid_from: str,
    select: Sequence[str],
    rename: Mapping[str, str] | None = None,
    valid_to: str | None = None,
    shares: int = SHARES,
) -> DataFrame:
    """All facts with the ``select``-ed columns of the version of their key that was valid at their ``at``.

    That is the version with the greatest ``valid_from`` not after it, unless its ``valid_to``, if
    there is such a column, is not after it either.  Of versions with the same key and beginning the one with
    the greatest values counts.  Facts without a valid version, with a NULL key or time, get NULLs.

    Facts and versions are put in one order by key and time, and the last version is carried along: one shuffle,
    no matter how many versions a key has.  The sequence of a hot key is cut by time into chunks
    that are sorted by different tasks; what a chunk begins with is handed over from the chunks before it.
    """
    on, rename = list(on), rename or {}
    added = [rename.get(c, c) for c in select]
    if clash := sorted({c.lower() for c in facts.columns} & {c.lower() for c in added}):
        raise ValueError(f"both sides have {', '.join(clash)}: rename the columns of the versions")
    value = F.struct(*(F.col(c).alias(rename.get(c, c)) for c in select), *([F.col(valid_to).alias("__until")] if valid_to else []))
    known = versions.select(*on, F.col(valid_from).alias(SEQ), value.alias(_VERSION)).where(~any_null([*on, SEQ]))
    known = known.groupBy(*on, SEQ).agg(F.max(_VERSION).alias(_VERSION))
    whole = F.struct(*(F.col(f"`{c}`") for c in facts.columns)).alias(_FACT)
    told = facts.select(*(F.col(c) for c in on), F.col(at).alias(SEQ), whole)
    timed, untimed = told.where(~any_null([*on, SEQ])), told.where(any_null([*on, SEQ]))
    both = known.unionByName(timed, allowMissingColumns=True)
    cuts = cuts_of(both.select(*on, SEQ), on, shares)
    chunked = with_chunk(both, on, cuts).repartition(*on, CHUNK)
    # a version comes before the facts of its moment
    line = Window.partitionBy(*on, CHUNK).orderBy(SEQ, F.col(_FACT).isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = chunked.withColumn(_VERSION, F.last(_VERSION, ignorenulls=True).over(line)).where(F.col(_FACT).isNotNull())
    carried = _with_carry(carried, _carries(known, on, cuts), on)
    found = carried.select(_FACT, F.coalesce(_VERSION, _CARRY).alias(_VERSION), SEQ)
    found = found.unionByName(untimed.select(_FACT, F.lit(None).cast(found.schema[_VERSION].dataType).alias(_VERSION), SEQ))
    valid: Column = F.lit(True)
    if valid_to:
        valid = F.col(f"{_VERSION}.__until").isNull() | (F.col(SEQ) < F.col(f"{_VERSION}.__until"))
    return found.select(f"{_FACT}.*", *(F.when(valid, F.col(f"{_VERSION}.`{c}`")).alias(c) for c in added))


def _carries(known: DataFrame, on: list[str], cuts: DataFrame) -> DataFrame:
    """For every chunk but the first of a hot key, the last version before it: few rows, as chunks are."""
    last = with_chunk(known, on, cuts).join(F.broadcast(cuts.select(*on)), on, "left_semi")
    last = last.groupBy(*on, CHUNK).agg(F.max_by(_VERSION, SEQ).alias(_VERSION))
    every = cuts.select(*on, F.explode(F.sequence(F.lit(0), F.size("__cuts"))).alias(CHUNK))
    before = Window.partitionBy(*on).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    return every.join(last, [*on, CHUNK], "left").select(*on, CHUNK, F.last(_VERSION, ignorenulls=True).over(before).alias(_CARRY))


def _with_carry(rows: DataFrame, carries: DataFrame, on: list[str]) -> DataFrame:
    """Chunks are fewer than the shares that keys are split by, so what is handed over can be sent to all tasks."""
    return rows.join(F.broadcast(carries.where(F.col(_CARRY).isNotNull())), [*on, CHUNK], "left")
