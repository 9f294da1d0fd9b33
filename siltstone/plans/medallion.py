"""Bronze, silver and gold datasets derived from one configuration.

Datasets are functions of DataFrames; calling one with another's result is the
whole dependency order.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StructType

from siltstone.functions.means import rounded_mean
from siltstone.functions.names import VERDICT
from siltstone.operators.aggregates import by_all_dimensions, by_dimension
from siltstone.operators.quality import (
    BROKEN,
    PASSED,
    at_least,
    expect_or_drop,
    quarantine,
    validated_table,
    with_verdict,
)
from siltstone.plans.config import Config
from siltstone.sources.readers import read_table, stream_table
from siltstone.sources.writers import write_table
from siltstone.streaming.cdc import Feed, scd_stream
from siltstone.streaming.ingest import run_incremental
from siltstone.streaming.target import bring_up_to_date, read_target

_NOT_FROM_TEXT = (ArrayType, BinaryType, MapType, StructType)


def bronze(spark: SparkSession, config: Config) -> DataFrame:
    return read_table(spark, config.source)


def silver(bronze_df: DataFrame, config: Config) -> DataFrame:
    return expect_or_drop(bronze_df, config.expectations)


def quarantined(bronze_df: DataFrame, config: Config) -> DataFrame:
    return quarantine(bronze_df, config.expectations)


def trip_measures() -> dict[str, Column]:
    """Measures of the trip example, used where a configuration names none."""
    return {
        "trips": F.count(F.lit(1)),
        "avg_fare": rounded_mean("fare_amount", 2),
        "avg_distance": rounded_mean("trip_distance", 2),
    }


def measures_of(config: Config) -> dict[str, Column]:
    return {name: F.expr(text) for name, text in config.measures.items()} or trip_measures()


def gold_tables(
    silver_df: DataFrame, config: Config, measures: Mapping[str, Column] | None = None
) -> dict[str, DataFrame]:
    """One lazily built table per configured dimension."""
    measures = measures or measures_of(config)
    return {name: by_dimension(silver_df, text, measures) for name, text in config.dimensions.items()}


def gold_in_one_scan(
    silver_df: DataFrame, config: Config, measures: Mapping[str, Column] | None = None
) -> DataFrame:
    """All gold tables as one, told apart by ``gold``; silver is read once."""
    return by_all_dimensions(silver_df, config.dimensions, measures or measures_of(config))


def materialize(spark: SparkSession, config: Config, root: str) -> dict[str, DataFrame]:
    """Write every dataset below ``root``; returns readers of the stored tables by name.

    Rows are judged once and stored by verdict; silver and quarantine are two
    partitions of that one table.  The stored silver rows are read once for all
    gold tables, which are partitions of one table too, except those whose
    dimension cannot be kept as text.
    """

    def stored(name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        return spark.read.schema(df.schema).parquet(write_table(df, f"{root}/{name}", partition_by))

    tables = {config.bronze_table: stored(config.bronze_table, bronze(spark, config))}
    judged = stored(
        config.silver_table, with_verdict(tables[config.bronze_table], config.expectations), [VERDICT]
    )
    for name, verdict in ((config.silver_table, PASSED), ("quarantine", BROKEN)):
        tables[name] = judged.where(F.col(VERDICT) == verdict).drop(VERDICT)
    gold = gold_tables(tables[config.silver_table], config)
    kinds = {name: table.schema["dimension_value"].dataType for name, table in gold.items()}
    plain = {name: kind for name, kind in kinds.items() if not isinstance(kind, _NOT_FROM_TEXT)}
    if plain:
        wanted = replace(config, gold_tables=[spec for spec in config.gold_tables if spec["name"] in plain])
        together = stored("gold", gold_in_one_scan(tables[config.silver_table], wanted), ["gold"])
    for name, table in gold.items():
        if name in plain:
            one = together.where(F.col("gold") == name).drop("gold")
            tables[name] = one.withColumn("dimension_value", F.col("dimension_value").cast(plain[name]))
        else:
            tables[name] = stored(name, table)
    return tables


def update(spark: SparkSession, config: Config, root: str, minimum: float = 0.0) -> dict[str, DataFrame]:
    """One run of everything a configuration names; returns readers by dataset name.

    Layers are recomputed into new folders, so readers of an earlier run keep
    their tables.  Landing and change feed are taken in from where the
    last run below the same ``root`` stopped.  Orders come last, since a broken
    order stops the run and the other tables do not depend on it.
    """
    tables = materialize(spark, config, f"{root}/layers-{uuid.uuid4().hex}")
    tables["gold_high_value"] = at_least(tables[config.silver_table], config.minimum_column, minimum)
    if config.landing_table:
        schema = read_table(spark, config.landing_table).schema
        path = f"{root}/streamed/data"
        run_incremental(stream_table(spark, config.landing_table, schema), path, f"{root}/streamed/checkpoint")
        tables["streamed"] = spark.read.schema(schema).parquet(path)
    if config.cdc_source:
        feed, schema = Feed(**config.cdc), read_table(spark, config.cdc_source).schema
        # both tables take their changes from one log, so the feed is read once, and only what is new
        log = f"{root}/changes/log"
        scd_stream(stream_table(spark, config.cdc_source, schema), feed, 2, log, f"{root}/changes/checkpoint")
        for scd_type in (1, 2):
            bring_up_to_date(spark, feed, scd_type, f"{root}/changes/scd{scd_type}", log, schema)
            tables[f"scd{scd_type}"] = read_target(spark, feed, scd_type, f"{root}/changes/scd{scd_type}")
    if config.orders_source:
        orders = read_table(spark, config.orders_source)
        tables["validated"] = validated_table(
            spark, orders, config.order_rules, f"{root}/validated-{uuid.uuid4().hex}"
        )
    return tables


def register(tables: Mapping[str, DataFrame]) -> None:
    """Make datasets known to SQL under their names, for queries with bound parameters."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
