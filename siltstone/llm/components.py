"""Connected components of a link table, by contraction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.stored import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every end of a link: the label is the smallest node it is connected with.

    In each round every node points to its smallest neighbour if that is smaller than itself,
    the pointers are followed to their ends, and each tree becomes one node.  A tree has two
    nodes at least, so the rounds are at most logarithmic in the number of nodes.  Links may
    repeat, point both ways or to their own node; those with a null end are left out.
    """
    ends = links.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("a"), F.col(b).alias("b"))
    edges = stored(_both_ways(ends), "links")
    steps = []
    while not edges.isEmpty():
        least = F.least(F.col("a"), F.min("b"))
        pointers = stored(edges.groupBy("a").agg(least.alias("to")).select(F.col("a").alias("node"), "to"), "pointers")
        while True:
            onward = pointers.select(F.col("node").alias("to"), F.col("to").alias("further"))
            further = pointers.join(onward, "to", "left").select("node", "to", F.coalesce("further", "to").alias("further"))
            further = stored(further, "pointers")
            pointers = further.select("node", F.col("further").alias("to"))
            if further.where(F.col("to") != F.col("further")).isEmpty():
                break
        steps.append(pointers)
        heads, tails = pointers.toDF("a", "head"), pointers.toDF("b", "tail")
        joined = edges.join(heads, "a").join(tails, "b").select(F.col("head").alias("a"), F.col("tail").alias("b"))
        edges = stored(_both_ways(joined), "links")
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))

    def onward(known: DataFrame, step: DataFrame) -> DataFrame:
        moved = known.join(step.toDF("label", "further"), "label", "left")
        return moved.select("node", F.coalesce("further", "label").alias("label"))

    named = reduce(onward, steps[1:], steps[0].toDF("node", "label"))
    alone = ends.where(F.col("a") == F.col("b")).select(F.col("a").alias("node"), F.col("a").alias("label")).distinct()
    return stored(named.unionByName(alone.join(named, "node", "left_anti")), "components")


def _both_ways(ends: DataFrame) -> DataFrame:
    apart = ends.where(F.col("a") != F.col("b"))
    return apart.unionByName(apart.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
