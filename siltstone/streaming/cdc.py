"""Change feeds as streams.

Each micro-batch is appended to a change log next to the target, in a folder
of its own; state and history are computed from the log when read.  So a batch
that runs again replaces itself, late and repeated changes need no special
case, a crash can leave no half-updated target, and a hot key never means one
bucket that has to be rewritten.  :func:`compact` keeps the log short.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from siltstone.functions.names import BATCH, RUN, refuse_reserved
from siltstone.operators.cdc import latest_changes, scd1, scd2, settled_changes, versions
from siltstone.streaming.ingest import run_batches, write_batch
from siltstone.streaming.target import MOST_BYTES, bring_up_to_date, publish_target


@dataclass(frozen=True)
class Feed:
    """How to read a change feed."""

    keys: Sequence[str]
    sequence_by: str
    deletes: str | Column | None = None
    except_cols: Sequence[str] = ()

    def latest(self, changes: DataFrame) -> DataFrame:
        return latest_changes(changes, self.keys, self.sequence_by, self.deletes, self.except_cols)

    def current(self, changes: DataFrame) -> DataFrame:
        return scd1(changes, self.keys, self.sequence_by, self.deletes, self.except_cols)

    def settled(self, changes: DataFrame) -> DataFrame:
        return settled_changes(changes, self.keys, self.sequence_by, self.deletes, self.except_cols)

    def versions(self, changes: DataFrame) -> DataFrame:
        return versions(changes, self.keys, self.sequence_by, self.deletes, self.except_cols)

    def history(self, changes: DataFrame) -> DataFrame:
        return scd2(changes, self.keys, self.sequence_by, self.deletes, self.except_cols)


def scd_stream(changes: DataFrame, feed: Feed, scd_type: int, target: str, checkpoint: str) -> int:
    """Take in all changes not seen before; returns how many rows were read.

    Type 1 keeps one change per key and batch, deletes included, since a later
    batch may bring an older change.  Type 2 keeps all of them and does not shuffle.
    """

    refuse_reserved(changes)
    # batch numbers start again with a new checkpoint, and must not meet older ones
    folder = f"{target}/{RUN}=r{hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}"

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(feed.latest(batch) if scd_type == 1 else batch, batch_id, folder)

    return run_batches(changes, checkpoint, write)


def read_log(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target).drop(RUN, BATCH)


def read_scd(spark: SparkSession, feed: Feed, scd_type: int, target: str) -> DataFrame:
    """The target table as of the last finished batch."""
    log = read_log(spark, target)
    return feed.current(log) if scd_type == 1 else feed.history(log)


def refresh_target(
    spark: SparkSession, changes: DataFrame, feed: Feed, scd_type: int, root: str, name: str, most_bytes: int = MOST_BYTES
) -> int:
    """One run of a target that readers know as ``name``; returns the rows taken in.

    New changes go to the log below ``root`` and beside the state they touch, and the table is published.
    What a run costs follows its new changes, not the log nor the table: see :mod:`siltstone.streaming.target`.
    """
    taken = scd_stream(changes, feed, scd_type, f"{root}/log", f"{root}/checkpoint")
    if bring_up_to_date(spark, feed, scd_type, root, schema=changes.schema, most_bytes=most_bytes):
        publish_target(spark, feed, scd_type, root, name)
    return taken


def compact(spark: SparkSession, feed: Feed, scd_type: int, target: str, new_target: str) -> str:
    """Rewrite the log into a new folder, superseded (type 1) or repeated (type 2) changes removed.

    Run it between incremental runs and pass ``new_target`` to the next one.
    """
    log = read_log(spark, target)
    kept = feed.latest(log) if scd_type == 1 else log.distinct()
    kept.write.mode("error").parquet(f"{new_target}/{RUN}=compacted/{BATCH}=-1")
    return new_target
