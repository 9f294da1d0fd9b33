"""Incremental runs: each one reads what is new, writes it, and stops."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructType

from siltstone.functions.names import BATCH, VERDICT, refuse_reserved
from siltstone.functions.rules import Rules
from siltstone.operators.quality import BROKEN, PASSED, with_verdict
from siltstone.session import fresh_path
from siltstone.sources.writers import publish

#: Columns of a progress record.
PROGRESS = "run string, batch bigint, started_at string, input_rows bigint, written_rows bigint"
_WRITTEN = "siltstone_written"


def finish(query: StreamingQuery, record: str | None = None) -> int:
    """Wait for an available-now query; returns the rows it read.

    Spark keeps the progress of the last batches only, so it is added up while
    the query runs.  ``record`` names a folder to which each batch is added as a
    row, see :func:`siltstone.operators.eventlog.recorded_metrics`.
    """
    total, latest, counted, ended = 0, -1, 0, False
    while not ended:
        ended = query.awaitTermination(1)
        fresh = []
        for progress in query.recentProgress:
            # a batch without rows may be reported again, with or without its number
            if progress.batchId < latest or (progress.batchId == latest and progress.numInputRows <= counted):
                continue
            total += progress.numInputRows - (counted if progress.batchId == latest else 0)
            latest, counted = progress.batchId, progress.numInputRows
            seen = progress.observedMetrics.get(_WRITTEN)
            fresh.append((str(query.runId), progress.batchId, progress.timestamp, progress.numInputRows, seen["rows"] if seen else None))
        if record is not None and fresh:
            SparkSession.active().createDataFrame(fresh, PROGRESS).coalesce(1).write.mode("append").parquet(record)
    return total


def run_incremental(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    options: Mapping[str, str] | None = None,
    partition_by: Sequence[str] = (),
    record: str | None = None,
) -> int:
    """Append all rows not seen before to a parquet folder; returns how many were read.

    The file sink keeps its own log of finished batches, so a batch that runs
    again after a failure leaves each row exactly once.  ``record`` names a folder for
    the rows read and written by each batch.
    """
    if record is not None:
        stream = stream.observe(_WRITTEN, F.count(F.lit(1)).alias("rows"))
    writer = stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return finish(writer.option("checkpointLocation", checkpoint).options(**(options or {})).start(path), record)


def full_refresh(
    spark: SparkSession,
    stream: DataFrame,
    label: str,
    name: str | None = None,
    run: Callable[[DataFrame, str, str], int] = run_incremental,
) -> str:
    """Recompute from the start into a new folder with a new checkpoint.

    The old table stays as it is until the new one is complete; with ``name``
    its readers are then switched over.  ``run`` takes the stream, the folder
    and the checkpoint, and may be any of the incremental runs.
    """
    root = fresh_path(spark, label)
    run(stream, f"{root}/data", f"{root}/checkpoint")
    if name is not None:
        publish(spark, name, f"{root}/data")
    return f"{root}/data"


def run_batches(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None]) -> int:
    """Hand every micro-batch to ``write`` as an ordinary DataFrame."""
    started = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    return finish(started)


def write_batch(batch: DataFrame, batch_id: int, path: str) -> None:
    """Store a micro-batch in its own folder; the same batch again replaces itself."""
    refuse_reserved(batch).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def silver_and_quarantine(stream: DataFrame, rules: Rules, path: str, checkpoint: str) -> int:
    """Send passing and broken rows to separate folders in one pass over the stream.

    Source and JSON are read once for both outcomes.  A folder belongs to one
    checkpoint; to start over, use :func:`full_refresh`.
    """

    refuse_reserved(stream)

    def write(batch: DataFrame, batch_id: int) -> None:
        with_verdict(batch, rules).write.mode("overwrite").partitionBy(VERDICT).parquet(f"{path}/{BATCH}={batch_id}")

    return run_batches(stream, checkpoint, write)


def read_outcome(spark: SparkSession, path: str, verdict: str, schema: StructType | None = None) -> DataFrame:
    """Rows of one outcome; only its folders are read.

    ``schema`` is the stream's own; with it a table without any row can be read too.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(StructType(list(schema.fields)).add(VERDICT, StringType()).add(BATCH, LongType()))
    return reader.parquet(path).where(F.col(VERDICT) == verdict).drop(VERDICT, BATCH)


def read_silver(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    return read_outcome(spark, path, PASSED, schema)


def read_quarantine(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    return read_outcome(spark, path, BROKEN, schema)
