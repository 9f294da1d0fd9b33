"""Long sequences of hot keys, cut into chunks that single tasks can sort."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.operators.skew import ROWS, hot_keys

SEQ = "__seq"
CHUNK = "__chunk"
NEXT = "__next_chunk"
_SAMPLES_PER_CHUNK = 32
_BLOCK = 64


def cuts_of(positions: DataFrame, keys: list[str], shares: int) -> DataFrame:
    """Per hot key a sorted array of sequences at which its history is cut.

    A sample picked by hash, sorted: the same cuts come out however often and
    in whatever order they are computed.  With fewer than ``shares`` hot keys
    and a fixed number of samples per chunk, the result is small by design.
    """
    counts = positions.groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS))
    total = counts.agg(F.sum(ROWS)).scalar()
    step = F.greatest(F.floor(total / F.lit(shares * _SAMPLES_PER_CHUNK)), F.lit(1)).cast("bigint")
    hot = hot_keys(counts, shares).select(*_renamed(keys))
    sampled = (
        positions.join(F.broadcast(hot), _same(keys), "left_semi")
        .where(F.pmod(F.xxhash64(SEQ), step) == 0)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_set(SEQ)).alias("__sample"))
    )
    return sampled.select(*keys, _every("__sample", _SAMPLES_PER_CHUNK).alias("__cuts"))


def with_chunk(rows: DataFrame, keys: list[str], cuts: DataFrame) -> DataFrame:
    """Number of the chunk a row belongs to, and the first sequence of the next one.

    Cuts are sequences that occur, so a chunk starts exactly at its cut.  The
    number is found in two short steps, first among every ``_BLOCK``-th cut.
    """
    lookup = cuts.select(*_renamed(keys), "__cuts", _every("__cuts", _BLOCK).alias("__heads"))
    found = rows.join(F.broadcast(lookup), _same(keys), "left")
    skipped = _not_above("__heads") * _BLOCK
    rest = F.slice("__cuts", skipped + 1, F.lit(_BLOCK - 1))
    chunk = F.when(F.col("__cuts").isNull(), F.lit(0)).otherwise(skipped + _not_above(rest))
    return found.withColumn(CHUNK, chunk).select(
        *rows.columns, CHUNK, F.get("__cuts", F.col(CHUNK)).alias(NEXT)
    )


def _every(array: str, n: int) -> Column:
    """Each ``n``-th element, beginning with number ``n``."""
    return F.filter(array, lambda _, i: (i + 1) % n == 0)


def _not_above(array: str | Column) -> Column:
    return F.size(F.filter(array, lambda cut: cut <= F.col(SEQ)))


def _renamed(keys: list[str]) -> list[Column]:
    return [F.col(k).alias(f"__cut_{i}") for i, k in enumerate(keys)]


def _same(keys: list[str]) -> Column:
    """Equal keys, NULL included."""
    return reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__cut_{i}")) for i, k in enumerate(keys)))
