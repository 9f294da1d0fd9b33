"""Profiles and drift from stored sketches: a table's partitions are each sketched once, and any of them can be put together.

For every partition and column a row holds counts and extremes, which are exact, a theta sketch of its distinct
values, a KLL sketch of its distribution if it is a number or a time, and else counts of its values by
hash.  All of these merge, so profiles of any partitions, and the drift between any two sets of them, follow
without reading the table again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DatetimeType, NumericType

#: Size of a KLL sketch (its ranks are off by about 2.3 / K), of a theta sketch as a power of two, and counters for values by hash.
KLL, THETA, COUNTERS = 800, 14, 256
_FIELDS = "part, column_name, rows, nulls, low, high, low_text, high_text, theta, kll, counters".split(", ")


def kll_error(k: int = KLL) -> float:
    """A bound for how far a rank may be off, at 99 % confidence."""
    return 2.296 / k**0.9021


def _number(df: DataFrame, column: str) -> Column | None:
    kind = df.schema[column].dataType
    if isinstance(kind, NumericType):
        return F.col(column).cast("double")
    if isinstance(kind, DatetimeType):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double") / 1e6
    return None


def sketch(df: DataFrame, part: str | Column, columns: Sequence[str]) -> DataFrame:
    """One row per partition (a value as text, NULL included) and column; ``df`` is read once, and once more for values by hash."""
    part = F.expr(part) if isinstance(part, str) else part
    parted = df.select(part.cast("string").alias("__part"), *columns)
    numbers = {c: _number(df, c) for c in columns}
    measured = []
    for c, number in numbers.items():
        fields = [F.count(F.col(c)).alias("filled"), F.min(F.col(c)).cast("string").alias("low_text"), F.max(F.col(c)).cast("string").alias("high_text")]
        fields.append(F.theta_sketch_agg(F.col(c) if number is None else number, F.lit(THETA)).alias("theta"))
        ends = [F.min(number), F.max(number), F.kll_sketch_agg_double(number, F.lit(KLL))] if number is not None else [F.lit(None)] * 3
        for name, kind, end in zip(("low", "high", "kll"), ("double", "double", "binary"), ends, strict=True):
            fields.append(end.cast(kind).alias(name))
        measured.append(F.struct(*fields).alias(c))
    wide = parted.groupBy("__part").agg(F.count(F.lit(1)).alias("rows"), *measured)
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            (F.col("rows") - F.col(f"`{c}`.filled")).alias("nulls"),
            *(F.col(f"`{c}`.{n}").alias(n) for n in ("low", "high", "low_text", "high_text", "theta", "kll")),
        )
        for c in columns
    ]
    long = wide.select(F.col("__part").alias("part"), "rows", F.inline(F.array(*entries)))
    texts = [c for c, number in numbers.items() if number is None]
    if not texts:
        return long.withColumn("counters", F.lit(None).cast("map<int,bigint>")).select(_FIELDS)
    place = [F.struct(F.lit(c).alias("name"), F.when(F.col(c).isNotNull(), F.pmod(F.xxhash64(F.col(c)), F.lit(COUNTERS)).cast("int")).alias("place")) for c in texts]
    counted = parted.select("__part", F.inline(F.array(*place))).where(F.col("place").isNotNull())
    counted = counted.groupBy("__part", "name", "place").agg(F.count(F.lit(1)).alias("n"))
    counted = counted.groupBy("__part", "name").agg(F.map_from_entries(F.collect_list(F.struct("place", "n"))).alias("counters"))
    same = F.col("part").eqNullSafe(F.col("__part")) & (F.col("column_name") == F.col("name"))
    return long.join(counted, same, "left").select(_FIELDS)


def merge(sketches: DataFrame) -> DataFrame:
    """All partitions of ``sketches`` together: one row per column."""
    plain = sketches.groupBy("column_name").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.min("low_text").alias("low_text"),
        F.max("high_text").alias("high_text"),
        F.theta_union_agg("theta", F.lit(THETA)).alias("theta"),
        F.kll_merge_agg_double("kll", F.lit(KLL)).alias("kll"),
        F.max(F.col("low").isNotNull()).alias("__ranked"),
    )
    places = sketches.select("column_name", F.explode("counters").alias("place", "n")).groupBy("column_name", "place").agg(F.sum("n").alias("n"))
    places = places.groupBy("column_name").agg(F.map_from_entries(F.collect_list(F.struct("place", "n"))).alias("counters"))
    joined = plain.join(places, "column_name", "left")
    return joined.withColumn("kll", F.when(F.col("__ranked"), F.col("kll"))).drop("__ranked")


def profile_of(merged: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Per column: rows, nulls, min_value and max_value (exact; numbers and times as numbers, else NULL), distinct_values and quantiles."""
    ranks = F.array(*(F.lit(float(q)) for q in quantiles))
    return merged.select(
        "column_name",
        "rows",
        "nulls",
        F.col("low").alias("min_value"),
        F.col("high").alias("max_value"),
        F.when(F.col("low").isNull(), F.col("low_text")).alias("min_text"),
        F.when(F.col("low").isNull(), F.col("high_text")).alias("max_text"),
        F.theta_sketch_estimate("theta").alias("distinct_values"),
        F.when(F.col("low").isNotNull(), F.kll_sketch_get_quantile_double("kll", ranks)).alias("quantiles"),
    )


def distribution_drift(baseline: DataFrame, current: DataFrame, bins: int = 10, points: int = 250, floor: float = 1e-4) -> DataFrame:
    """Per column how far two merged sketches are apart: psi, distance, distinct_shared.

    psi is the population stability index over ``bins`` of even shares in the baseline, for other values
    than numbers and times over counts by hash; shares below ``floor`` count as that.  distance is the largest
    difference of the two distributions (Kolmogorov-Smirnov) at ``points`` quantiles of each, NULL for
    other values.  distinct_shared estimates how many distinct values both have.
    Columns that one side lacks, or of which it has no value, have NULLs.
    """
    b, c = baseline.alias("b"), current.alias("c")
    both = b.join(c, "column_name", "full_outer")
    ranked = F.col("b.low").isNotNull() & F.col("c.low").isNotNull()
    # ranks of values that are not known beforehand are counted in the quantiles of a sketch
    middles = F.array(*(F.lit((i + 0.5) / points) for i in range(points)))
    for side in "bc":
        both = both.withColumn(f"__{side}", F.when(ranked, F.kll_sketch_get_quantile_double(f"{side}.kll", middles)))
    edges = F.array_sort(F.array_distinct(F.kll_sketch_get_quantile_double("b.kll", F.array(*(F.lit(i / bins) for i in range(1, bins))))))
    both = both.withColumn("__edges", F.when(ranked, edges)).withColumn("__marks", F.concat("__b", "__c"))

    def ranks(side: str, values: str) -> Column:
        return F.transform(values, lambda x: F.size(F.filter(f"__{side}", lambda q: q <= x)) / F.lit(float(points)))

    def shares(ranks: Column) -> Column:
        return F.zip_with(F.concat(ranks, F.array(F.lit(1.0))), F.concat(F.array(F.lit(0.0)), ranks), lambda x, y: F.greatest(x - y, F.lit(floor)))

    def index(left: Column, right: Column) -> Column:
        return F.aggregate(F.zip_with(left, right, lambda x, y: (y - x) * F.log(y / x)), F.lit(0.0), lambda total, x: total + x)

    places = F.array_distinct(F.concat(F.map_keys("b.counters"), F.map_keys("c.counters")))

    def part_of(side: str) -> Column:
        every = F.col(f"{side}.rows") - F.col(f"{side}.nulls")
        share = lambda p: F.coalesce(F.try_element_at(F.col(f"{side}.counters"), p), F.lit(0)) / every
        return F.transform(places, lambda p: F.greatest(share(p), F.lit(floor)))

    psi = F.when(ranked, index(shares(ranks("b", "__edges")), shares(ranks("c", "__edges"))))
    psi = psi.when(F.col("b.counters").isNotNull() & F.col("c.counters").isNotNull(), index(part_of("b"), part_of("c")))
    distance = F.array_max(F.zip_with(ranks("b", "__marks"), ranks("c", "__marks"), lambda x, y: F.abs(x - y)))
    shared = F.theta_sketch_estimate(F.theta_intersection("b.theta", "c.theta"))
    return both.select("column_name", psi.alias("psi"), distance.alias("distance"), shared.alias("distinct_shared"))
