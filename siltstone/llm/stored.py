"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from siltstone.session import fresh_path


def stored(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """``df`` written out and read again: lost executors don't undo it, and joins see its real size.

    With ``by``, rows of each value of that column are in files of their own, and only those asked for are read.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path, partitionBy=by)
    return df.sparkSession.read.schema(df.schema).parquet(path)
