"""Batch writers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.names import VERDICT, refuse_reserved
from siltstone.operators.checks import has_errors


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    columns: Mapping[str, str] | None = None,
    rebalance: bool = False,
) -> str:
    """Write a parquet folder and return its path; the schema is always the frame's own.

    ``columns`` gives column comments, kept in the file schema.  ``rebalance``
    gathers the rows of each of many partitions before writing, large ones
    being split again, so that the folders hold few files of even size.
    """
    if rebalance and partition_by:
        df = df.hint("rebalance", *partition_by)
    for name, comment in (columns or {}).items():
        df = df.withMetadata(name, {"comment": comment})
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def publish(spark: SparkSession, name: str, path: str) -> None:
    """Point readers of ``name`` at a finished folder.

    Write to a new folder, then publish: readers see the old or the new table,
    never a half-written one, and a failed write changes nothing.
    """
    quoted = path.replace("`", "``")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{quoted}`")


def describe(
    spark: SparkSession, table: str, comment: str | None = None, properties: Mapping[str, str] | None = None
) -> None:
    """Set the comment and labels of a catalog table."""
    if comment is not None:
        spark.sql(f"COMMENT ON TABLE {table} IS {_literal(comment)}")
    if properties:
        pairs = ", ".join(f"{_literal(k)} = {_literal(v)}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")


def described(spark: SparkSession, table: str) -> DataFrame:
    """What the catalog says about a table: kind (*comment*, *property* or *column*), name, value; columns without a comment are left out."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    names = spark.read.table(table).columns
    found = [("column", r["col_name"], r["comment"]) for r in rows[: len(names)] if r["comment"]]
    found += [("comment", "table", r["data_type"]) for r in rows[len(names) :] if r["col_name"] == "Comment"]
    found += [("property", r["key"], r["value"]) for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()]
    return spark.createDataFrame(found, "kind string, name string, value string")


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def save_table(
    df: DataFrame,
    table: str,
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Replace a catalog table and label it."""
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
    describe(df.sparkSession, table, comment, properties)


def export_ndjson(df: DataFrame, path: str) -> str:
    """One JSON object per line, dates and times as ISO text, written by all tasks."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


def write_split(annotated: DataFrame, path: str) -> str:
    """Store checked rows once, in one folder for each verdict; all columns are kept."""
    verdict = F.when(has_errors(), F.lit("quarantine")).otherwise(F.lit("valid"))
    return write_table(refuse_reserved(annotated).withColumn(VERDICT, verdict), path, partition_by=[VERDICT])


def read_split(spark: SparkSession, path: str, verdict: str | None = None) -> DataFrame:
    """All checked rows, or those with one verdict (only its folder is read)."""
    stored = spark.read.parquet(path)
    wanted = stored if verdict is None else stored.where(F.col(VERDICT) == verdict)
    return wanted.drop(VERDICT)
