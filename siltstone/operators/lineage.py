"""Lineage beyond direct sources: what can be reached, and over how few steps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.session import fresh_path


def closure(edges: DataFrame, starts: DataFrame | None = None, upstream: bool = False, most_hops: int | None = None) -> DataFrame:
    """start, node, hops: all that can be reached from ``starts`` over edges (source, target), with the least number of steps.

    Every node that has an edge is a start unless ``starts`` names some (its first column).  ``upstream`` follows edges
    backwards: to where something comes from.  A start is reached by itself only over a cycle.  NULLs and
    repeated edges do not count.

    Each round follows the edges of the nodes that were new in the round before, and keeps what has not been
    reached yet, so cycles end and no path is followed twice.  There are as many rounds as the
    longest of the shortest ways has steps, and ``most_hops`` at most.
    """
    spark = edges.sparkSession

    def stored(df: DataFrame) -> DataFrame:
        path = fresh_path(spark, "lineage")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    ends = ("target", "source") if upstream else ("source", "target")
    steps = edges.select(F.col(ends[0]).alias("at"), F.col(ends[1]).alias("next")).dropna().distinct()
    steps = stored(steps)
    if starts is None:
        wanted = steps.select(F.col("at").alias("start")).distinct()
    else:
        wanted = starts.select(F.col(starts.columns[0]).alias("start")).dropna().distinct()
    frontier = stored(wanted.join(steps, F.col("start") == F.col("at")).select("start", F.col("next").alias("node"), F.lit(1).alias("hops")))
    reached, hops = [frontier], 1
    while not frontier.isEmpty() and hops != most_hops:
        hops += 1
        further = frontier.join(steps, F.col("node") == F.col("at")).select("start", F.col("next").alias("node")).distinct()
        known = reduce(DataFrame.unionByName, reached).select("start", "node")
        frontier = stored(further.join(known, ["start", "node"], "left_anti").withColumn("hops", F.lit(hops)))
        reached.append(frontier)
        if len(reached) > 8:  # few folders, however long the way
            reached = [stored(reduce(DataFrame.unionByName, reached))]
    return reduce(DataFrame.unionByName, reached)
