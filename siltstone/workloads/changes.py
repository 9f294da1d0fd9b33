"""Change feeds: events as changes of users, errors as deletes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.cdc import scd1, scd2
from siltstone.session import fresh_path
from siltstone.sources.readers import stream_table
from siltstone.streaming.cdc import Feed, compact, read_scd, refresh_target, scd_stream
from siltstone.workloads.registry import query, stream_of, table

FEED = Feed(["user_id"], "event_id", "event_type = 'error'", ["event_type", "event_id"])
COLUMNS = ["user_id", "event_id", "event_type", "value", "props"]

SCD1_SQL = (
    "SELECT user_id, value, props FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn "
    "FROM events) WHERE rn = 1 AND event_type <> 'error'"
)
SCD2_SQL = (
    'SELECT user_id, value, props, event_id AS "__START_AT", nxt AS "__END_AT" FROM (SELECT *, '
    "lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS nxt FROM events) WHERE event_type <> 'error'"
)


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(*COLUMNS)


@query("scd1_users", SCD1_SQL)
def scd1_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd1(changes(spark, sf_dir), FEED.keys, FEED.sequence_by, FEED.deletes, FEED.except_cols)


@query("scd2_users", SCD2_SQL)
def scd2_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2(changes(spark, sf_dir), FEED.keys, FEED.sequence_by, FEED.deletes, FEED.except_cols)


@query(
    "scd2_order_lines",
    'SELECT l_orderkey, l_quantity, l_linenumber AS "__START_AT", nxt AS "__END_AT" FROM (SELECT *, '
    "lead(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS nxt FROM ("
    "SELECT l_orderkey, l_linenumber, max(l_quantity) AS l_quantity FROM lineitem GROUP BY 1, 2))",
)
def scd2_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and sequences repeat with differing values here: the greatest value counts."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return scd2(lines, ["l_orderkey"], "l_linenumber", except_cols=["l_linenumber"])


def _streamed(spark: SparkSession, sf_dir: str, scd_type: int) -> str:
    root = fresh_path(spark, f"scd{scd_type}")
    feed = stream_of(spark, sf_dir, "events").select(*COLUMNS)
    scd_stream(feed, FEED, scd_type, f"{root}/log", f"{root}/checkpoint")
    return root


@query("scd1_streamed", SCD1_SQL)
def scd1_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_scd(spark, FEED, 1, f"{_streamed(spark, sf_dir, 1)}/log")


@query("scd2_streamed", SCD2_SQL)
def scd2_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_scd(spark, FEED, 2, f"{_streamed(spark, sf_dir, 2)}/log")


@query(
    "feed_keeps_columns",
    'SELECT user_id, value, batch_id, run_id, event_id AS "__START_AT", nxt AS "__END_AT" FROM (SELECT *, '
    "event_id % 7 AS batch_id, event_type AS run_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS nxt "
    "FROM events) WHERE event_type <> 'error'",
)
def feed_keeps_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed that has columns named like numbers of runs and batches."""
    root = fresh_path(spark, "feed-columns")
    added = {"batch_id": F.col("event_id") % 7, "run_id": F.col("event_type")}
    feed = stream_of(spark, sf_dir, "events").withColumns(added)
    scd_stream(feed.select("user_id", "event_id", "event_type", "value", *added), FEED, 2, f"{root}/log", f"{root}/checkpoint")
    return read_scd(spark, FEED, 2, f"{root}/log")


@query("scd1_published", SCD1_SQL)
def scd1_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = stream_of(spark, sf_dir, "events").select(*COLUMNS)
    name = f"siltstone_users_{uuid.uuid4().hex}"
    refresh_target(spark, feed, FEED, 1, fresh_path(spark, "users"), name)
    return spark.table(name)


def _in_slices(spark: SparkSession, sf_dir: str, scd_type: int) -> DataFrame:
    """Three runs of one target; each brings changes that are older than some already there."""
    root, name = fresh_path(spark, f"slices{scd_type}"), f"siltstone_slices_{uuid.uuid4().hex}"
    events = changes(spark, sf_dir)
    for part in range(3):
        events.where(F.col("event_id") % 3 == part).write.mode("append").parquet(f"{root}/landing")
        feed = stream_table(spark, f"{root}/landing", events.schema)
        refresh_target(spark, feed, FEED, scd_type, f"{root}/target", name)
    return spark.table(name)


@query("scd1_incremental", SCD1_SQL)
def scd1_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_slices(spark, sf_dir, 1)


@query("scd2_incremental", SCD2_SQL)
def scd2_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_slices(spark, sf_dir, 2)


@query("scd1_compacted", SCD1_SQL)
def scd1_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _streamed(spark, sf_dir, 1)
    return read_scd(spark, FEED, 1, compact(spark, FEED, 1, f"{root}/log", f"{root}/compacted"))


def _hot(events: DataFrame) -> DataFrame:
    """A third of all changes are of one user."""
    return events.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")))


_HOT_SQL = "(SELECT CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END AS user_id, event_id, event_type, value, props FROM events)"


def _split_buckets(spark: SparkSession, sf_dir: str, scd_type: int) -> DataFrame:
    """A load and two small runs, one of which brings changes older than what is there; buckets are kept tiny, so they are split."""
    root, name = fresh_path(spark, f"buckets{scd_type}"), f"siltstone_buckets_{uuid.uuid4().hex}"
    events = _hot(changes(spark, sf_dir))
    part = F.when(F.col("event_id") % 50 == 7, 1).when(F.col("event_id") % 50 == 8, 2).otherwise(0)
    for number in range(3):
        events.where(part == number).write.mode("append").parquet(f"{root}/landing")
        feed = stream_table(spark, f"{root}/landing", events.schema)
        refresh_target(spark, feed, FEED, scd_type, f"{root}/target", name, most_bytes=32 << 10)
    return spark.table(name)


@query("scd1_split_buckets", SCD1_SQL.replace("FROM events", f"FROM {_HOT_SQL}"))
def scd1_split_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split_buckets(spark, sf_dir, 1)


@query("scd2_split_buckets", SCD2_SQL.replace("FROM events", f"FROM {_HOT_SQL}"))
def scd2_split_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split_buckets(spark, sf_dir, 2)
