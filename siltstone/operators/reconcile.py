"""Comparing a copied table with its source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from siltstone.operators.ranges import PLACE, bounds_of, has_quantiles, range_of, within


def reconcile_counts(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Row counts of source and target per table name."""
    counted = [
        side.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("table"),
            (F.col("n") if i == 0 else F.lit(0)).alias("source_n"),
            (F.col("n") if i == 1 else F.lit(0)).alias("target_n"),
        )
        for name, pair in pairs.items()
        for i, side in enumerate(pair)
    ]
    return (
        reduce(DataFrame.unionByName, counted)
        .groupBy("table")
        .agg(F.sum("source_n").alias("source_rows"), F.sum("target_n").alias("target_rows"))
        .withColumn("matches", F.col("source_rows") == F.col("target_rows"))
    )


def reconcile_aggregates(
    source: DataFrame, target: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]
) -> DataFrame:
    """Both sides' aggregates next to each other, groups missing on one side included.

    Each side is reduced to its groups first; the sides then meet in a second
    small aggregate, where NULL keys match each other.
    """
    names = list(measures)

    def side(df: DataFrame, label: str) -> DataFrame:
        grouped = df.groupBy(*keys).agg(F.struct(*(c.alias(n) for n, c in measures.items())).alias("m"))
        return grouped.select(*keys, F.lit(label).alias("side"), "m")

    both = side(source, "source").unionByName(side(target, "target")).groupBy(*keys)
    wide = both.agg(
        F.max(F.when(F.col("side") == "source", F.col("m"))).alias("s"),
        F.max(F.when(F.col("side") == "target", F.col("m"))).alias("t"),
    )
    return wide.select(
        *keys,
        *(F.col(f"{side}.{n}").alias(f"{label}_{n}") for n in names for side, label in (("s", "source"), ("t", "target"))),
        F.col("s").eqNullSafe(F.col("t")).alias("matches"),
    )


def reconcile_sets(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Entries found on one side only, with ``status`` *missing* or *unexpected*."""
    marked = expected.select(*keys, F.lit(1).alias("e"), F.lit(0).alias("a")).unionByName(
        actual.select(*keys, F.lit(0).alias("e"), F.lit(1).alias("a"))
    )
    return (
        marked.groupBy(*keys)
        .agg(F.max("e").alias("e"), F.max("a").alias("a"))
        .where(F.col("e") != F.col("a"))
        .select(*keys, F.when(F.col("e") == 1, "missing").otherwise("unexpected").alias("status"))
    )


def reconciliation_passes(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many entries are missing or unexpected, and whether none is missing."""
    return reconcile_sets(expected, actual, keys).agg(
        F.count_if(F.col("status") == "missing").alias("missing"),
        F.count_if(F.col("status") == "unexpected").alias("unexpected"),
    ).withColumn("passed", F.col("missing") == 0)


#: Into how many ranges of keys a range is divided, and how many rows a range may have that is compared row by row.
FAN, LEAF_ROWS = 64, 200_000
_RANGE, _SIDE, _SURPLUS = "__range", "__side", "__surplus"


def reconcile_rows(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    fan: int = FAN,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """Keys whose rows differ: ``keys``, status (*missing*, *changed* or *unexpected* in ``target``), source_rows, target_rows, changed_columns.

    Both tables are first reduced to a fingerprint of each range of the leading key, which does not depend on the
    order of rows.  Only ranges that differ are divided and looked at again, until they are small; of these alone rows
    are shuffled.  On tables laid out by that key, files of equal ranges are not opened again.

    Rows are compared in ``columns``, all that both have unless given.  Equal rows cancel each other one by one;
    source_rows and target_rows say how many are left of a key, which may occur on several rows or be NULL.
    changed_columns names the columns that differ where one row is left on either side.
    """
    keys = list(keys)
    shared = [c for c in (columns or source.columns) if c in source.columns and c in target.columns and c not in keys]
    source, target = source.select(*keys, *shared), target.select(*keys, *shared)
    return _surplus(*differing_rows(source, target, keys, fan, leaf_rows), keys, shared)


def differing_rows(
    source: DataFrame, target: DataFrame, keys: Sequence[str], fan: int = FAN, leaf_rows: int = LEAF_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Both tables without those ranges of the leading key in which they have the same rows."""
    lead = F.col(keys[0])
    ordered = has_quantiles(source.schema[keys[0]].dataType)
    # a key that has no quantiles is ordered by its hash, which spreads rows but lets no file be left out
    place = lead if ordered else F.xxhash64(lead)
    wanted = F.lit(True)
    while True:
        left, right = source.where(wanted), target.where(wanted)
        bounds = bounds_of(left.unionByName(right).select(place.alias(PLACE)), fan)
        found = _differing(left, right, range_of(place, bounds))
        if not found:
            return source.where(F.lit(False)), target.where(F.lit(False))
        narrowed = wanted & within(place, bounds, [r[_RANGE] for r in found])
        rows = sum(r["rows"] for r in found)
        before = sum(r["all_rows"] for r in found[:1])
        # small enough, or too widely spread for another look to spare anything
        if rows <= leaf_rows or rows > before / 2:
            return source.where(narrowed), target.where(narrowed)
        wanted = narrowed


def _differing(left: DataFrame, right: DataFrame, number: Column) -> list[Row]:
    """Ranges whose rows differ, with their rows on both sides and those of all ranges: ``fan`` at most."""

    def side(df: DataFrame, sign: int) -> DataFrame:
        whole = [F.xxhash64(F.lit(seed), *df.columns) for seed in (1, 2)]
        sums = [F.sum(h.cast("decimal(38,0)")).alias(f"h{i}") for i, h in enumerate(whole)]
        counted = df.groupBy(number.alias(_RANGE)).agg(F.count(F.lit(1)).alias("n"), *sums)
        return counted.select(_RANGE, "n", *((F.col(c) * sign).alias(c) for c in ("h0", "h1")), (F.col("n") * sign).alias("more"))

    # equal sides add up to nothing
    both = side(left, 1).unionByName(side(right, -1)).groupBy(_RANGE)
    both = both.agg(F.sum("n").alias("rows"), *(F.sum(c).alias(c) for c in ("h0", "h1", "more")))
    found = both.collect()
    every = sum(r["rows"] for r in found)
    return [Row(**{_RANGE: r[_RANGE], "rows": r["rows"], "all_rows": every}) for r in found if r["h0"] or r["h1"] or r["more"]]


def _surplus(source: DataFrame, target: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    marked = source.withColumn(_SIDE, F.lit(1)).unionByName(target.withColumn(_SIDE, F.lit(-1)))
    left = marked.groupBy(*keys, *columns).agg(F.sum(_SIDE).alias(_SURPLUS)).where(F.col(_SURPLUS) != 0)
    one = F.col(_SURPLUS) > 0
    values = F.struct(*columns) if columns else F.struct(F.lit(1).alias("__none"))
    per_key = left.groupBy(*keys).agg(
        F.sum(F.when(one, F.col(_SURPLUS)).otherwise(0)).alias("source_rows"),
        F.sum(F.when(one, 0).otherwise(-F.col(_SURPLUS))).alias("target_rows"),
        F.max(F.when(one, values)).alias("__s"),
        F.max(F.when(~one, values)).alias("__t"),
    )
    differs = [F.when(~F.col(f"__s.`{c}`").eqNullSafe(F.col(f"__t.`{c}`")), F.lit(c)) for c in columns]
    changed = F.array_compact(F.array(*differs)) if differs else F.array().cast("array<string>")
    single = (F.col("source_rows") == 1) & (F.col("target_rows") == 1)
    status = F.when(F.col("target_rows") == 0, "missing").when(F.col("source_rows") == 0, "unexpected").otherwise("changed")
    return per_key.select(*keys, status.alias("status"), "source_rows", "target_rows", F.when(single, changed).alias("changed_columns"))
