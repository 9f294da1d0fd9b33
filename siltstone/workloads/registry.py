"""Where queries and their SQL are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltstone.sources.readers import stream_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a stream, whether it is a folder or a single file.

    A stream's plain path has to be a folder, while a pattern may match either.
    """
    return stream_table(spark, f"{sf_dir}/{name}.parque[t]", table(spark, sf_dir, name).schema)


def mean_sql(column: str, digits: int) -> str:
    """SQL for :func:`siltstone.functions.means.stable_mean`."""
    exact = f"CAST(sum(CAST(round({column} * 100) AS BIGINT)) AS DOUBLE) / count({column}) / 100.0"
    return f"CAST(round(CAST({exact} AS DECIMAL(18,6)), {digits}) AS DOUBLE)"


def sum_sql(column: str) -> str:
    """SQL for :func:`siltstone.functions.means.stable_sum`."""
    return f"CAST(sum(CAST(round({column} * 100) AS BIGINT)) AS DOUBLE) / 100.0"
