"""Gold tables maintained from batches: each batch leaves partial states of its groups, which can be merged in any order.

What a run costs follows its new rows and the number of groups, never the rows that were summed before.  Counts,
sums and extremes are one row per group.  Exact numbers of distinct values are kept as sets that can be
united: whole numbers as bitmaps of 32,768 neighbours each, other values as they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, LongType, StructType

from siltstone.functions.names import BATCH, refuse_reserved
from siltstone.streaming.ingest import run_batches

#: Batches are folded into one once there are more.
MOST_BATCHES = 16
_ROWS = "__rows"
_PLAIN = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Gold:
    """Groups and measures of a gold table: a measure is (kind, column), of kind count, sum, mean, min, max or distinct.

    Columns and keys are SQL expressions; a key is named by its alias.  ``("count", "*")`` counts rows.  A mean is the
    sum by the count of values.  Groups with a NULL key count like others; NULL is no distinct value.
    """

    keys: Mapping[str, str]
    measures: Mapping[str, tuple[str, str]]

    def __post_init__(self) -> None:
        if unknown := {kind for kind, _ in self.measures.values()} - {*_PLAIN, "mean", "distinct"}:
            raise ValueError(f"unknown kinds of measure: {', '.join(sorted(unknown))}")

    @property
    def parts(self) -> dict[str, tuple[str, str]]:
        """What is summed for the measures but distinct ones: a mean needs two."""
        found = {n: m for n, m in self.measures.items() if m[0] in _PLAIN}
        for name, (kind, column) in self.measures.items():
            if kind == "mean":
                found |= {f"__{name}_sum": ("sum", column), f"__{name}_n": ("count", column)}
        return found

    @property
    def sets(self) -> dict[str, str]:
        return {name: column for name, (kind, column) in self.measures.items() if kind == "distinct"}


def _keyed(rows: DataFrame, gold: Gold) -> list[Column]:
    return [F.expr(text).alias(name) for name, text in gold.keys.items()]


def partial_sums(rows: DataFrame, gold: Gold) -> DataFrame:
    """One row per group of ``rows``: what can be added to the same of other rows."""
    sums = [_PLAIN[kind](F.lit(1) if column == "*" else F.expr(column)).alias(name) for name, (kind, column) in gold.parts.items()]
    return rows.groupBy(*_keyed(rows, gold)).agg(F.count(F.lit(1)).alias(_ROWS), *sums)


def partial_sets(rows: DataFrame, gold: Gold) -> DataFrame | None:
    """Distinct values per group and measure: bitmaps of neighbouring whole numbers (bucket, bits), other values as text.

    ``rows`` are read once for all of the former and once for all of the latter.
    """
    if not gold.sets:
        return None
    values = rows.select(*_keyed(rows, gold), *(F.expr(column).alias(f"__set_{name}") for name, column in gold.sets.items()))
    numbers = [n for n in gold.sets if isinstance(values.schema[f"__set_{n}"].dataType, IntegralType)]
    others = [n for n in gold.sets if n not in numbers]
    found = []
    if numbers:
        offered = F.explode(F.array(*(F.struct(F.lit(n).alias("__measure"), F.col(f"__set_{n}").cast("bigint").alias("__value")) for n in numbers)))
        each = values.select(*gold.keys, offered.alias("o")).select(*gold.keys, "o.*").where(F.col("__value").isNotNull())
        bucket = F.bitmap_bucket_number("__value").alias("__bucket")
        bits = F.bitmap_construct_agg(F.bitmap_bit_position("__value")).alias("__bits")
        found.append(each.groupBy(*gold.keys, "__measure", bucket).agg(bits).withColumn("__text", F.lit(None).cast("string")))
    if others:
        offered = F.explode(F.array(*(F.struct(F.lit(n).alias("__measure"), F.col(f"__set_{n}").cast("string").alias("__text")) for n in others)))
        each = values.select(*gold.keys, offered.alias("o")).select(*gold.keys, "o.*").where(F.col("__text").isNotNull()).distinct()
        none = F.lit(None).cast("bigint").alias("__bucket"), F.lit(None).cast("binary").alias("__bits")
        found.append(each.select(*gold.keys, "__measure", *none, "__text"))
    return reduce(DataFrame.unionByName, found)


def merged_sums(states: DataFrame, gold: Gold) -> DataFrame:
    sums = [_MERGE[kind](name).alias(name) for name, (kind, _) in gold.parts.items()]
    return states.groupBy(*gold.keys).agg(F.sum(_ROWS).alias(_ROWS), *sums)


def merged_sets(states: DataFrame, gold: Gold) -> DataFrame:
    numbers, texts = states.where(F.col("__bits").isNotNull()), states.where(F.col("__bits").isNull())
    united = numbers.groupBy(*gold.keys, "__measure", "__bucket").agg(F.bitmap_or_agg("__bits").alias("__bits"))
    return united.withColumn("__text", F.lit(None).cast("string")).unionByName(texts.distinct())


def finished(sums: DataFrame, sets: DataFrame | None, gold: Gold) -> DataFrame:
    """The gold table of merged states."""
    joined = sums
    if sets is not None:
        size = F.when(F.col("__text").isNull(), F.bitmap_count("__bits")).otherwise(1)
        counted = sets.groupBy(*gold.keys).agg(*(F.sum(F.when(F.col("__measure") == n, size)).alias(f"__set_{n}") for n in gold.sets))
        counted = counted.select(*(F.col(k).alias(f"__key_{i}") for i, k in enumerate(gold.keys)), *(f"__set_{n}" for n in gold.sets))
        same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__key_{i}")) for i, k in enumerate(gold.keys)), F.lit(True))
        joined = sums.join(counted, same, "left")
    out = []
    for name, (kind, _) in gold.measures.items():
        if kind == "mean":
            out.append((F.col(f"__{name}_sum") / F.col(f"__{name}_n")).alias(name))
        elif kind == "distinct":
            out.append(F.coalesce(F.col(f"__set_{name}"), F.lit(0)).cast("bigint").alias(name))
        else:
            out.append(F.col(name))
    return joined.select(*gold.keys, *out)


def run_gold(spark: SparkSession, stream: DataFrame, gold: Gold, root: str) -> int:
    """Takes in the rows of ``stream`` not seen before; returns how many.  Only they and, now and then, states are read.

    A batch that runs again replaces its own states.
    """
    refuse_reserved(stream)
    taken = 0

    def write(batch: DataFrame, batch_id: int) -> None:
        if (sets := partial_sets(batch, gold)) is not None:
            sets.write.mode("overwrite").parquet(f"{root}/sets/{BATCH}={batch_id}")
        path = f"{root}/sums/{BATCH}={batch_id}"
        partial_sums(batch, gold).write.mode("overwrite").parquet(path)
        # the stream's own count has the rows of a batch once for each time that they are read
        nonlocal taken
        taken += batch.sparkSession.read.schema(f"{_ROWS} bigint").parquet(path).agg(F.sum(_ROWS)).first()[0] or 0

    run_batches(stream, f"{root}/checkpoint", write)
    _fold(spark, stream.schema, gold, root)
    return taken


def _schemas(spark: SparkSession, schema: StructType, gold: Gold) -> tuple[StructType, StructType | None]:
    empty = spark.createDataFrame([], schema)
    sets = partial_sets(empty, gold)
    return partial_sums(empty, gold).schema, sets.schema if sets is not None else None


def _folded(spark: SparkSession, root: str) -> tuple[int, str | None]:
    """The last batch that is folded, and where."""
    try:
        found = spark.read.schema("upto bigint, folder string").parquet(f"{root}/folds").agg(F.max(F.struct("upto", "folder"))).first()[0]
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1, None
    return (found["upto"], found["folder"]) if found else (-1, None)


def _states(spark: SparkSession, kind: str, schema: StructType, root: str) -> DataFrame:
    upto, folder = _folded(spark, root)
    rows = spark.read.schema(StructType(list(schema.fields)).add(BATCH, LongType())).parquet(f"{root}/{kind}")
    rows = rows.where(F.col(BATCH) > upto).drop(BATCH)
    return rows if folder is None else rows.unionByName(spark.read.schema(schema).parquet(f"{root}/{folder}/{kind}"))


def _fold(spark: SparkSession, schema: StructType, gold: Gold, root: str) -> None:
    """Merges states of many batches into one folder, which counts once its name is written down."""
    sums, sets = _schemas(spark, schema, gold)
    upto, _ = _folded(spark, root)
    batches = spark.read.schema(f"{BATCH} bigint").parquet(f"{root}/sums").where(F.col(BATCH) > upto)
    newest = batches.agg(F.count_distinct(BATCH).alias("n"), F.max(BATCH).alias("last")).first()
    if newest["n"] <= MOST_BATCHES:
        return
    folder = f"folded-{uuid.uuid4().hex}"
    merged_sums(_states(spark, "sums", sums, root), gold).write.parquet(f"{root}/{folder}/sums")
    if sets is not None:
        merged_sets(_states(spark, "sets", sets, root), gold).write.parquet(f"{root}/{folder}/sets")
    spark.createDataFrame([(newest["last"], folder)], "upto bigint, folder string").coalesce(1).write.mode("append").parquet(f"{root}/folds")


def read_gold(spark: SparkSession, schema: StructType, gold: Gold, root: str) -> DataFrame:
    """The gold table as of the last run; ``schema`` is that of the rows it is made of."""
    sums, sets = _schemas(spark, schema, gold)
    united = None if sets is None else merged_sets(_states(spark, "sets", sets, root), gold)
    return finished(merged_sums(_states(spark, "sums", sums, root), gold), united, gold)
