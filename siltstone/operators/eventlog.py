"""Reading the event log of pipeline runs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltstone.session import fresh_path

# Fixed value: layout of the expectation entries in an event's details.
EXPECTATIONS = "array<struct<name:string,dataset:string,passed_records:bigint,failed_records:bigint>>"


def expectation_entries(log: DataFrame, details: str = "details", keep: Sequence[str] = ()) -> DataFrame:
    """All rule results found in the details, one row each."""
    found = F.from_json(
        F.get_json_object(details, "$.flow_progress.data_quality.expectations"), EXPECTATIONS
    )
    return log.select(*keep, F.explode(found).alias("e")).select(*keep, "e.*")


def expectation_log(log: DataFrame, ts: str = "timestamp", details: str = "details") -> DataFrame:
    """The latest result per dataset and rule."""
    newest = F.max_by(
        F.struct("passed_records", "failed_records"), F.struct(F.col(ts), "passed_records", "failed_records")
    )
    return (
        expectation_entries(log, details, [ts])
        .groupBy("dataset", "name")
        .agg(newest.alias("r"))
        .select("dataset", "name", "r.passed_records", "r.failed_records")
    )


def flow_history(
    log: DataFrame, flow: str = "flow", status: str = "status", rows: str = "output_rows", ts: str = "timestamp"
) -> DataFrame:
    """Per flow: events, rows written, failures and the latest status."""
    return log.groupBy(flow).agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(rows).alias("output_rows"),
        F.count_if(F.col(status) == "FAILED").alias("failures"),
        F.max_by(status, F.struct(F.col(ts), F.col(status))).alias("last_status"),
    )


def run_metrics(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Rows read per micro-batch of a finished or running query, of which Spark keeps the last 100.

    :func:`recorded_metrics` has all of them.
    """
    progress = [(p.batchId, p.timestamp, p.numInputRows) for p in query.recentProgress]
    return spark.createDataFrame(progress, "batch_id long, started_at string, input_rows long")


def recorded_metrics(spark: SparkSession, record: str) -> DataFrame:
    """Per run of a stream with a progress record: batches, rows read, rows written and when it began, oldest first by ``started_at``."""
    progress = spark.read.schema("run string, batch bigint, started_at string, input_rows bigint, written_rows bigint").parquet(record)
    # a batch that ran again after a failure counts once, under the run that finished it
    last = progress.groupBy("batch").agg(F.max_by(F.struct("run", "started_at", "input_rows", "written_rows"), "started_at").alias("p"))
    return last.groupBy("p.run").agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("p.input_rows").alias("input_rows"),
        F.sum("p.written_rows").alias("written_rows"),
        F.min("p.started_at").alias("started_at"),
    )


def critical_path(
    steps: DataFrame, feeds: DataFrame, run: str = "run", flow: str = "flow", seconds: str = "seconds", source: str = "source", target: str = "target"
) -> DataFrame:
    """The chain of flows that takes longest in each run: run, position (from 1), flow, seconds, finished_after.

    ``steps`` has a row per run and flow, ``feeds`` which flow waits for which (in all runs).  A flow ends its own seconds
    after the last of those it waits for.  Ends are relaxed level by level: in each round flows whose sources
    have moved are looked at again, so there are as many rounds as the longest chain has flows.  Of chains
    that take the same time the one of the greatest names counts.  Feeds that go round in a circle are an error.
    """
    spark = steps.sparkSession

    def stored(df: DataFrame) -> DataFrame:
        path = fresh_path(spark, "critical-path")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    own = stored(steps.groupBy(F.col(run).alias("run"), F.col(flow).alias("flow")).agg(F.sum(seconds).alias("seconds")))
    waits = stored(feeds.select(F.col(source).alias("source"), F.col(target).alias("flow")).dropna().distinct())
    most = own.select("flow").distinct().count()
    ends = stored(own.withColumns({"ends": F.col("seconds"), "after": F.lit(None).cast("string")}))
    for _ in range(most + 1):
        before = ends.select("run", F.col("flow").alias("source"), F.col("ends").alias("begin"))
        last = before.join(waits, "source").groupBy("run", "flow").agg(F.max(F.struct("begin", "source")).alias("last"))
        new = own.join(last, ["run", "flow"], "left").select(
            "run", "flow", "seconds", (F.col("seconds") + F.coalesce("last.begin", F.lit(0))).alias("ends"), F.col("last.source").alias("after")
        )
        new = stored(new)
        moved = new.join(ends.select("run", "flow", F.col("ends").alias("old")), ["run", "flow"]).where(F.col("ends") != F.col("old"))
        ends = new
        if moved.isEmpty():
            break
    else:
        raise ValueError("flows wait for each other in a circle")
    # back from the last flow of each run, one flow at a time
    final = ends.groupBy("run").agg(F.max(F.struct("ends", "flow")).alias("last")).select("run", F.col("last.flow").alias("flow"))
    at, chain = stored(final.withColumn("back", F.lit(0))), []
    while not at.isEmpty():
        found = stored(at.join(ends, ["run", "flow"]))
        chain.append(found)
        at = found.where(F.col("after").isNotNull()).select("run", F.col("after").alias("flow"), (F.col("back") + 1).alias("back"))
    whole = reduce(DataFrame.unionByName, chain) if chain else ends.withColumn("back", F.lit(0)).limit(0)
    longest = whole.groupBy("run").agg(F.max("back").alias("most"))
    position = (F.col("most") - F.col("back") + 1).alias("position")
    return whole.join(longest, "run").select("run", position, "flow", "seconds", F.col("ends").alias("finished_after"))
