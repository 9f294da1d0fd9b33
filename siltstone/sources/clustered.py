"""Tables laid out for filters on several columns.

Each column is divided into ranges of about as many rows, and rows are ordered along a curve through the grid
of ranges that keeps neighbours in all columns together.  The bounds of every file are stored beside the
table, so that a filter chooses files before anything is opened.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.names import RESERVED, refuse_reserved
from siltstone.operators.ranges import PLACE, bounds_of, has_quantiles, range_of

#: Ranges per column, as a power of two.
BITS = 7
_CURVE, _FILE = f"{RESERVED}curve", f"{RESERVED}file"


def curve(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """Place on the Z-order curve: the bits of all ranks in turn, highest first."""
    placed = [
        F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("bigint"), bit * len(ranks) + i)
        for bit in range(bits)
        for i, rank in enumerate(ranks)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), placed)


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int, bits: int = BITS) -> str:
    """Writes a new table of about ``files`` files, ordered by ``columns`` together; a NULL comes before all values.

    Columns that have no quantiles, as texts, are ranged by the order of their hashes: equal values come together.
    """
    refuse_reserved(df)
    ranks = []
    for name in columns:
        place = F.col(name) if has_quantiles(df.schema[name].dataType) else F.xxhash64(name)
        bounds = bounds_of(df.select(place.alias(PLACE)), 1 << bits)
        ranks.append(F.greatest(range_of(place, bounds), F.lit(0)))
    ordered = df.withColumn(_CURVE, curve(ranks, bits)).repartitionByRange(files, _CURVE).sortWithinPartitions(_CURVE)
    ordered.drop(_CURVE).write.mode("error").parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path).withColumn(_FILE, F.col("_metadata.file_path"))
    ends = [f(F.col(c)).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("low", F.min), ("high", F.max))]
    nulls = [F.count_if(F.col(c).isNull()).alias(f"nulls{i}") for i, c in enumerate(columns)]
    # a folder that readers of the table pass over
    stored.groupBy(_FILE).agg(F.count(F.lit(1)).alias("rows"), *ends, *nulls).coalesce(1).write.parquet(f"{path}/_bounds")
    return path


def files_for(spark: SparkSession, path: str, columns: Sequence[str], wanted: Mapping[str, tuple[Any, Any]]) -> list[str]:
    """Files that can hold rows within ``wanted`` (smallest and largest value of some of ``columns``, None for no bound)."""
    bounds = spark.read.parquet(f"{path}/_bounds")
    keep: Column = F.lit(True)
    for name, (low, high) in wanted.items():
        i = list(columns).index(name)
        if low is not None:
            keep = keep & (F.col(f"high{i}") >= F.lit(low))
        if high is not None:
            keep = keep & (F.col(f"low{i}") <= F.lit(high))
    return sorted(row[0] for row in bounds.where(keep).select(_FILE).collect())


def read_clustered(
    spark: SparkSession, path: str, columns: Sequence[str], wanted: Mapping[str, tuple[Any, Any]], schema=None
) -> DataFrame:
    """Rows within ``wanted``; files without any are not opened.  ``columns`` are those the table was written with."""
    schema = schema or spark.read.parquet(path).schema
    files = files_for(spark, path, columns, wanted)
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    for name, (low, high) in wanted.items():
        rows = rows.where(F.col(name).isNotNull())
        rows = rows.where(F.col(name) >= F.lit(low)) if low is not None else rows
        rows = rows.where(F.col(name) <= F.lit(high)) if high is not None else rows
    return rows
