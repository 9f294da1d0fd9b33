"""Casts for the ingest edge, where bad text must become NULL and not an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def struct_of(schema: str | StructType) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def iso_timestamp(column: str | Column) -> Column:
    """ISO-8601 text to timestamp; anything unreadable becomes NULL."""
    return F.try_to_timestamp(F.col(column) if isinstance(column, str) else column)


def typed(df: DataFrame, schema: str | StructType) -> DataFrame:
    """Select the columns of ``schema`` in its order, each through try_cast."""
    return df.select(
        *(F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in struct_of(schema).fields)
    )


def tag_key(column: str | Column) -> Column:
    """Last dotted segment of a type name, with ``-`` written as ``_``."""
    source = F.col(column) if isinstance(column, str) else column
    return F.translate(F.substring_index(source, ".", -1), "-", "_")
