"""Batch and stream readers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from siltstone.functions.casts import iso_timestamp, struct_of, typed
from siltstone.operators.governance import INVENTORY

# Fixed value: fields of a device document that form the reference table.
DEVICE_REFERENCE = (
    "device_id string, model string, firmware string, region string, site string, "
    "status string, registered_at string, last_seen string, battery_pct int"
)


def read_table(spark: SparkSession, source: str) -> DataFrame:
    """A catalog table by name, or a parquet folder by path."""
    return spark.read.parquet(source) if "/" in source else spark.read.table(source)


def stream_table(
    spark: SparkSession, source: str, schema: str | StructType | None = None, max_files: int | None = None
) -> DataFrame:
    """A catalog table by name, or a parquet folder by path, as a stream: each run sees the files it has not seen.

    A folder needs its schema; a table brings its own.  A single file is no folder; a pattern that matches it is.
    """
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if "/" not in source:
        return reader.table(source)
    if schema is None:
        raise ValueError(f"a stream of the folder {source} needs a schema")
    return reader.schema(struct_of(schema)).parquet(source)


def message_log_options(
    bootstrap: str, topic: str, login: str | None = None, max_per_trigger: int | None = None
) -> dict[str, str]:
    """Options of a message log read from its start, tolerant of expired data.

    ``max_per_trigger`` bounds the messages of a micro-batch; without it a run takes what there is in one.
    """
    options = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if login is not None:
        options |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": login,
        }
    return options


def message_columns(messages: DataFrame) -> DataFrame:
    """The raw layer of a message log: text, partition, offset, enqueued time."""
    return messages.select(
        F.col("value").cast("string").alias("raw_json"),
        F.col("partition").alias("log_partition"),
        F.col("offset").alias("log_offset"),
        F.col("timestamp").alias("enqueued_ts"),
    )


def telemetry_source(spark: SparkSession, options: Mapping[str, str], format: str = "kafka") -> DataFrame:
    """A message log as a stream of raw rows; needs the connector on the classpath."""
    return message_columns(spark.readStream.format(format).options(**options).load())


def load_ndjson(spark: SparkSession, path: str, schema: str | StructType, unreadable: str | None = None) -> DataFrame:
    """Newline-delimited JSON as typed columns; values that do not fit become NULL.

    Every field is read as text first, so that a wrong value costs its field
    and not its row.  A line that is no JSON is a row of NULLs; ``unreadable`` names
    a column that keeps its text, and is NULL for all others.
    """
    wanted = struct_of(schema)
    text = StructType([StructField(f.name, StringType()) for f in wanted.fields])
    if unreadable is None:
        return typed(spark.read.schema(text).json(path), wanted)
    if unreadable in wanted.names:
        raise ValueError(f"{unreadable} is a column of the rows")
    reader = spark.read.option("columnNameOfCorruptRecord", unreadable)
    return typed(reader.schema(text.add(unreadable, StringType())).json(path), StructType(list(wanted.fields)).add(unreadable, StringType()))


def load_documents(spark: SparkSession, path: str, schema: str | StructType = DEVICE_REFERENCE) -> DataFrame:
    """A document snapshot, the named fields only."""
    return spark.read.schema(struct_of(schema)).json(path)


def load_event_log(spark: SparkSession, path: str) -> DataFrame:
    """Run events; ``details`` stays JSON text whatever it contains."""
    text = "timestamp string, flow string, status string, output_rows string, details string"
    return spark.read.schema(text).json(path).select(
        iso_timestamp("timestamp").alias("timestamp"),
        "flow",
        "status",
        F.col("output_rows").try_cast("bigint").alias("output_rows"),
        "details",
    )


def load_inventory(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Governance inventories: one document per file, or one per line for large exports."""
    return spark.read.schema(INVENTORY).option("multiLine", not one_per_line).json(path)


def remote_table(spark: SparkSession, format: str, options: Mapping[str, str]) -> DataFrame:
    """A table left where it is; filters and column choice travel to it.

    For ``jdbc``, give partitionColumn, lowerBound, upperBound and
    numPartitions, or the whole table comes through one connection.
    """
    if format == "jdbc" and "partitionColumn" not in options:
        raise ValueError("a jdbc scan needs partitionColumn, lowerBound, upperBound, numPartitions")
    return spark.read.format(format).options(**options).load()


def export(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)
