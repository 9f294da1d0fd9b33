"""Rules that cannot hold together, and rules that others make needless.

Rules of columns are brought into one normal form: an interval, a set of allowed values, and whether NULL passes.
Of the rules of a column the tightest bounds are found, then bounds travel over rules that compare two
columns until nothing changes.  A column whose interval or set is empty is contradicted, and a
rule that excludes nothing the others let pass is redundant.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.operators.scan import NON_NULL, RANGE, SET
from siltstone.session import fresh_path

#: ``column`` is not above ``other`` of the same row.
NOT_ABOVE = "not_above_expectation"
_LOW, _HIGH = float("-inf"), float("inf")


def normal_form(rules: DataFrame) -> DataFrame:
    """Rules (table_name, name, column, type, min, max, values, other, ignore_null) with low, high, allowed (NULL: any) and null_passes.

    Bounds are numbers; text that is none is no bound.  In three-valued logic a rule on NULL is unknown: it
    counts as broken, unless ``ignore_null``, and a rule against NULL only is broken by it for certain.
    """
    bound = lambda name, none: F.coalesce(F.expr(f"try_cast(`{name}` AS double)"), F.lit(none))
    of_range = F.col("type") == RANGE
    return rules.select(
        "table_name",
        "name",
        F.col("column").alias("column_name"),
        "type",
        F.when(of_range, bound("min", _LOW)).otherwise(F.lit(_LOW)).alias("low"),
        F.when(of_range, bound("max", _HIGH)).otherwise(F.lit(_HIGH)).alias("high"),
        F.when(F.col("type") == SET, F.array_sort(F.array_distinct("values"))).alias("allowed"),
        (F.coalesce("ignore_null", F.lit(False)) & (F.col("type") != NON_NULL)).alias("null_passes"),
        F.when(F.col("type") == NOT_ABOVE, F.col("other")).alias("other"),
    )


def column_limits(form: DataFrame) -> DataFrame:
    """What all rules of a column leave: table_name, column_name, low, high, allowed, null_passes, contradicted.

    A row for every column that a rule names.  Bounds travel along ``not above`` rules: what a column may not
    exceed, nothing below it may.  contradicted columns have no value that passes, NULL neither.
    """
    plain = form.groupBy("table_name", "column_name").agg(
        F.max("low").alias("low"),
        F.min("high").alias("high"),
        F.count("allowed").alias("__sets"),
        F.every("null_passes").alias("null_passes"),
    )
    # a value passes all sets if it is in as many of them as there are
    values = form.select("table_name", "column_name", F.explode("allowed").alias("value")).groupBy("table_name", "column_name", "value").count()
    common = values.join(plain.select("table_name", "column_name", "__sets"), ["table_name", "column_name"]).where(F.col("count") == F.col("__sets"))
    common = common.groupBy("table_name", "column_name").agg(F.array_sort(F.collect_list("value")).alias("allowed"))
    edges = form.where(F.col("other").isNotNull()).select("table_name", F.col("column_name").alias("below"), F.col("other").alias("above")).distinct()
    named = edges.select("table_name", F.col("above").alias("column_name")).join(plain, ["table_name", "column_name"], "left_anti").distinct()
    nothing = {"low": F.lit(_LOW), "high": F.lit(_HIGH), "__sets": F.lit(0).cast("bigint"), "null_passes": F.lit(True)}
    limits = plain.unionByName(named.select("table_name", "column_name", *(c.alias(n) for n, c in nothing.items())))
    limits = _propagated(limits, edges)
    joined = limits.join(common, ["table_name", "column_name"], "left")
    none = F.array().cast("array<string>")
    # allowed values that are no numbers are not compared with bounds
    inside = F.filter("allowed", lambda v: F.coalesce(v.try_cast("double").between(F.col("low"), F.col("high")), F.lit(True)))
    allowed = F.when(F.col("__sets") > 0, F.coalesce(inside, none))
    out = joined.select("table_name", "column_name", "low", "high", allowed.alias("allowed"), "null_passes")
    empty = (F.col("low") > F.col("high")) | (F.coalesce(F.size("allowed"), F.lit(1)) == 0)
    return out.withColumn("contradicted", empty & ~F.col("null_passes"))


def _propagated(limits: DataFrame, edges: DataFrame) -> DataFrame:
    """Bounds after they have travelled along all edges, a round for each step of the longest way they go.

    Around a cycle all columns come to have the same bounds, which ends it.
    """
    spark = limits.sparkSession

    def stored(df: DataFrame) -> DataFrame:
        path = fresh_path(spark, "limits")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    limits, edges = stored(limits), stored(edges)
    while not edges.isEmpty():
        ends = limits.select("table_name", "column_name", "low", "high")
        highs = edges.join(ends, (ends.table_name == edges.table_name) & (ends.column_name == edges.above))
        highs = highs.select(edges.table_name, F.col("below").alias("column_name"), F.lit(_LOW).alias("l"), F.col("high").alias("h"))
        lows = edges.join(ends, (ends.table_name == edges.table_name) & (ends.column_name == edges.below))
        lows = lows.select(edges.table_name, F.col("above").alias("column_name"), F.col("low").alias("l"), F.lit(_HIGH).alias("h"))
        brought = highs.unionByName(lows).groupBy("table_name", "column_name").agg(F.max("l").alias("l"), F.min("h").alias("h"))
        tighter = limits.join(brought, ["table_name", "column_name"], "left")
        moved = (F.coalesce("l", F.lit(_LOW)) > F.col("low")) | (F.coalesce("h", F.lit(_HIGH)) < F.col("high"))
        low, high = F.greatest("low", "l").alias("low"), F.least("high", "h").alias("high")
        new = stored(tighter.select("table_name", "column_name", low, high, "__sets", "null_passes", moved.alias("moved")))
        limits = new.drop("moved")
        if new.where("moved").isEmpty():
            break
    return limits


def rule_conflicts(rules: DataFrame) -> DataFrame:
    """Each rule with its verdict: table_name, name, column_name, verdict (*contradicted*, *redundant* or *needed*).

    All rules of a contradicted column are contradicted.  Of the others those are needed that hold the tightest
    bound of their column, first by name of such that say the same; each different set; rules that compare columns;
    and one rule that keeps NULL out, if any does, if possible one that is needed anyhow.  What is
    left lets the same values pass as all rules together.
    """
    form = normal_form(rules)
    limits = column_limits(form).select("table_name", "column_name", "contradicted")
    own = Window.partitionBy("table_name", "column_name")
    first = lambda window: F.row_number().over(window) == 1
    holds_low = (F.col("low") > _LOW) & first(own.orderBy(F.desc("low"), "name"))
    holds_high = (F.col("high") < _HIGH) & first(own.orderBy("high", "name"))
    new_set = F.col("allowed").isNotNull() & first(Window.partitionBy("table_name", "column_name", "allowed").orderBy("name"))
    wanted = form.withColumn("__wanted", holds_low | holds_high | new_set | F.col("other").isNotNull())
    keeps_null_out = ~F.col("null_passes") & first(own.orderBy("null_passes", F.desc("__wanted"), "name"))
    judged = wanted.withColumn("__needed", F.col("__wanted") | keeps_null_out).join(limits, ["table_name", "column_name"])
    verdict = F.when(F.col("contradicted"), "contradicted").when(F.col("__needed"), "needed").otherwise("redundant")
    return judged.select("table_name", "name", "column_name", verdict.alias("verdict"))
