"""Grouped summaries of the gold layer.

All of them combine before the shuffle.  ``mean`` builds the rounded mean of a
column; pass :func:`siltstone.functions.means.stable_mean` for results that do
not depend on summation order.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.means import rounded_mean

Mean = Callable[[str, int], Column]


def by_dimension(df: DataFrame, dimension: str, measures: Mapping[str, Column]) -> DataFrame:
    """Group by an SQL expression; a NULL dimension is a group of its own."""
    return df.groupBy(F.expr(dimension).alias("dimension_value")).agg(
        *(column.alias(name) for name, column in measures.items())
    )


def by_all_dimensions(
    df: DataFrame, dimensions: Mapping[str, str], measures: Mapping[str, Column]
) -> DataFrame:
    """Every named dimension from one scan of the input: ``gold, dimension_value, ...``.

    Each row is offered to all dimensions at once and summed before the
    shuffle, so the table is read once whatever the number of gold tables.
    Dimension values are text here, since one column has to hold them all.
    """
    offered = F.array(
        *(
            F.struct(F.lit(name).alias("gold"), F.expr(expression).cast("string").alias("dimension_value"))
            for name, expression in dimensions.items()
        )
    )
    return (
        df.withColumn("__offer", F.explode(offered))
        .groupBy(F.col("__offer.gold").alias("gold"), F.col("__offer.dimension_value").alias("dimension_value"))
        .agg(*(column.alias(name) for name, column in measures.items()))
    )


def region_metric(
    df: DataFrame,
    region: str = "region",
    metric: str = "metric",
    value: str = "value",
    battery: str = "battery_pct",
    device: str = "device_id",
    mean: Mean = rounded_mean,
) -> DataFrame:
    return df.groupBy(region, metric).agg(
        F.count(F.lit(1)).alias("readings"),
        mean(value, 2).alias("avg_value"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        mean(battery, 1).alias("avg_battery"),
        F.count_distinct(F.col(device)).alias("active_devices"),
    )


def device_summary(
    df: DataFrame,
    keys: Sequence[str] = ("device_id", "model", "region", "device_status"),
    battery: str = "battery_pct",
    ts: str = "event_ts",
    mean: Mean = rounded_mean,
) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("readings"),
        mean(battery, 1).alias("avg_battery"),
        F.max(ts).alias("last_event_ts"),
    )


def daily(df: DataFrame, keys: Sequence[str], ts: str, measures: Mapping[str, Column]) -> DataFrame:
    """Per key and calendar day."""
    return df.groupBy(*keys, F.to_date(ts).alias("d")).agg(*(c.alias(n) for n, c in measures.items()))


def histogram(df: DataFrame, by: str, name: str = "n") -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias(name))


def metric_histogram(
    df: DataFrame, metric: str = "metric", value: str = "value", mean: Mean = rounded_mean
) -> DataFrame:
    return df.groupBy(metric).agg(F.count(F.lit(1)).alias("n"), mean(value, 2).alias("avg_value"))


def group_summary(df: DataFrame, by: str, device: str) -> DataFrame:
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("readings"), F.count_distinct(F.col(device)).alias("devices")
    )


def totals(df: DataFrame, distinct: Sequence[str] = ()) -> DataFrame:
    """Row count and exact distinct counts of the whole table."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.count_distinct(F.col(c)).alias(f"distinct_{c}") for c in distinct),
    )
