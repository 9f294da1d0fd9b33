"""Uniqueness and references over a growing table: an index of the keys seen, so that a run checks its new rows only.

Each batch leaves a run: its distinct keys with how many rows they have, sorted by hash in buckets of the hash, and a
Bloom filter in blocks of 32,768 bits.  Keys of a new batch are looked up in the blocks of older runs that
they fall into; only buckets in which a filter has hits are opened, and a hit counts once the key is found
there.  Runs are merged when they are many.  A key that is found again is noted with its rows.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from siltstone.functions.names import RESERVED, refuse_reserved
from siltstone.operators.skew import ROWS, any_null, key_counts
from siltstone.sources.writers import write_table
from siltstone.streaming.ingest import run_batches

#: Keys of a block of the filter, bits that each sets there, and keys of a bucket.
BLOCK_KEYS, PROBES, BUCKET_KEYS = 3200, 4, 1 << 20
#: Runs are merged into one when there are more.
MOST_RUNS = 12
_HASH, _BUCKET, _BLOCK, _BITS, _RUN, _OLD = (f"{RESERVED}{n}" for n in ("hash", "bucket", "block", "bits", "run", "old"))
_PLACES = 15
_RUNS = "upto bigint, folder string, buckets int, blocks bigint, batch bigint"


@dataclass(frozen=True)
class Run:
    """Keys of the batches up to ``upto``, below the root in ``folder``."""

    upto: int
    folder: str
    buckets: int
    blocks: int


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*(F.col(k) for k in keys))


def _probes(keys: Sequence[str]) -> list[Column]:
    """Places of a key in its block."""
    other = F.xxhash64(F.lit(7), *(F.col(k) for k in keys))
    return [F.shiftrightunsigned(other, _PLACES * i).bitwiseAND(F.lit((1 << _PLACES) - 1)) for i in range(PROBES)]


def _power(n: float) -> int:
    return 1 << max(math.ceil(math.log2(max(n, 1))), 0)


class KeyIndex:
    """The index of ``keys`` below ``root``; ``schema`` gives their types."""

    def __init__(self, spark: SparkSession, keys: Sequence[str], schema: StructType, root: str):
        self.spark, self.keys, self.root = spark, list(keys), root
        self.schema = StructType([schema[k] for k in keys]).add(ROWS, LongType())

    def runs(self, before: int | None = None) -> list[Run]:
        """Runs that make up the index, as far as batches before ``before`` are concerned."""
        try:
            rows = self.spark.read.schema(_RUNS).parquet(f"{self.root}/runs").collect()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        # merged runs stand for all batches up to theirs; of a batch that ran again the last row counts
        rows = [r for r in rows if before is None or r["upto"] < before]
        merged = max((r for r in rows if r["batch"] is None), key=lambda r: r["upto"], default=None)
        single = {r["batch"]: r for r in rows if r["batch"] is not None and (merged is None or r["batch"] > merged["upto"])}
        found = [*([merged] if merged else []), *(single[b] for b in sorted(single))]
        return [Run(r["upto"], r["folder"], r["buckets"], r["blocks"]) for r in found]

    def add(self, rows: DataFrame, batch: int) -> None:
        """Takes the keys of a batch in and notes those that are found again; the same batch again replaces itself."""
        folder = f"batch-{batch}-{uuid.uuid4().hex}"
        counted = self._write(key_counts(rows, self.keys), folder)
        older = self.found(counted, before=batch).withColumnRenamed(ROWS, _OLD)
        again = counted.join(older, self.keys, "left").where((F.col(ROWS) > 1) | F.col(_OLD).isNotNull())
        noted = self._noted(batch).select(*self.keys).distinct().withColumn("__known", F.lit(True))
        # what a key had before is added when it is noted for the first time
        total = F.col(ROWS) + F.when(F.col("__known").isNull(), F.coalesce(_OLD, F.lit(0))).otherwise(0)
        again = again.join(noted, self.keys, "left").select(*self.keys, total.alias(ROWS))
        again.write.mode("overwrite").parquet(f"{self.root}/noted/{_RUN}={batch}")
        self._record(counted, folder, batch, batch)
        if len(self.runs()) > MOST_RUNS:
            self._merge()

    def _write(self, counted: DataFrame, folder: str) -> DataFrame:
        counted.write.parquet(f"{self.root}/{folder}/counted")
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/{folder}/counted")

    def _record(self, counted: DataFrame, folder: str, upto: int, batch: int | None) -> None:
        """Stores sorted keys and filter of a run; it counts once its row is written."""
        n = counted.count()
        buckets, blocks = _power(n / BUCKET_KEYS), _power(n / BLOCK_KEYS)
        place = F.col(_HASH).bitwiseAND(F.lit(buckets - 1))
        keyed = counted.withColumn(_HASH, _hash(self.keys)).withColumn(_BUCKET, place).repartition(_BUCKET)
        write_table(keyed.sortWithinPartitions(_BUCKET, _HASH), f"{self.root}/{folder}/keys", [_BUCKET])
        block = _hash(self.keys).bitwiseAND(F.lit(blocks - 1)).alias(_BLOCK)
        bits = counted.select(block, F.explode(F.array(*_probes(self.keys))).alias("p")).groupBy(_BLOCK).agg(F.bitmap_construct_agg("p").alias(_BITS))
        bits.write.parquet(f"{self.root}/{folder}/filter")
        row = [(upto, folder, buckets, blocks, batch)]
        self.spark.createDataFrame(row, _RUNS).coalesce(1).write.mode("append").parquet(f"{self.root}/runs")

    def _merge(self) -> None:
        runs = self.runs()
        whole = reduce(DataFrame.unionByName, (self._keys_of(r).select(*self.keys, ROWS) for r in runs))
        folder = f"merged-{uuid.uuid4().hex}"
        merged = self._write(whole.groupBy(*self.keys).agg(F.sum(ROWS).alias(ROWS)), folder)
        self._record(merged, folder, runs[-1].upto, None)

    def _keys_of(self, run: Run) -> DataFrame:
        schema = StructType(list(self.schema.fields)).add(_HASH, LongType()).add(_BUCKET, LongType())
        return self.spark.read.schema(schema).parquet(f"{self.root}/{run.folder}/keys")

    def candidates(self, keys: DataFrame, run: Run) -> DataFrame:
        """Those of ``keys`` that the filter of a run does not exclude."""
        filters = self.spark.read.schema(f"{_BLOCK} bigint, {_BITS} binary").parquet(f"{self.root}/{run.folder}/filter")
        placed = keys.select(*self.keys, _hash(self.keys).bitwiseAND(F.lit(run.blocks - 1)).alias(_BLOCK))
        held = placed.join(filters, _BLOCK)
        byte = lambda p: F.conv(F.hex(F.substring(F.col(_BITS), (F.shiftright(p, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        every = [F.getbit(byte(p), p.bitwiseAND(F.lit(7)).cast("int")) == 1 for p in _probes(self.keys)]
        return held.where(reduce(lambda a, b: a & b, every)).select(*self.keys)

    def found(self, keys: DataFrame, before: int | None = None) -> DataFrame:
        """Those of ``keys`` (distinct) that batches before ``before`` have, with their rows there."""
        parts = []
        for run in self.runs(before):
            # few, unless most keys are found again
            likely = self.candidates(keys, run).withColumn(_BUCKET, _hash(self.keys).bitwiseAND(F.lit(run.buckets - 1)))
            path = f"{self.root}/likely-{uuid.uuid4().hex}"
            likely.write.parquet(path)
            likely = self.spark.read.schema(likely.schema).parquet(path)
            opened = [r[0] for r in likely.select(_BUCKET).distinct().limit(4096).collect()]
            if not opened:
                continue
            stored = self._keys_of(run)
            stored = stored.where(F.col(_BUCKET).isin(opened)) if len(opened) < 4096 else stored
            parts.append(stored.join(likely.drop(_BUCKET), self.keys).select(*self.keys, ROWS))
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return reduce(DataFrame.unionByName, parts).groupBy(*self.keys).agg(F.sum(ROWS).alias(ROWS))

    def missing(self, rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
        """Rows whose key, in ``columns``, no batch has; a key with a NULL in it is not missing."""
        columns = list(columns or self.keys)
        wanted = rows.where(~any_null(columns)).select(*(F.col(c).alias(k) for c, k in zip(columns, self.keys, strict=True))).distinct()
        known = self.found(wanted).select(*(F.col(k).alias(c) for c, k in zip(columns, self.keys, strict=True)))
        return rows.where(~any_null(columns)).join(known, columns, "left_anti").select(*rows.columns)

    def _noted(self, before: int | None = None) -> DataFrame:
        try:
            rows = self.spark.read.schema(StructType(list(self.schema.fields)).add(_RUN, LongType())).parquet(f"{self.root}/noted")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.schema)
        return (rows if before is None else rows.where(F.col(_RUN) < before)).drop(_RUN)

    def repeated(self) -> DataFrame:
        """Keys that occur more than once in all batches, with their number of rows."""
        return self._noted().groupBy(*self.keys).agg(F.sum(ROWS).alias("rows"))


def run_unique(spark: SparkSession, stream: DataFrame, keys: Sequence[str], root: str) -> KeyIndex:
    """Takes new rows of ``stream`` into the index of its keys below ``root``; keys with a NULL in them are not looked at."""
    refuse_reserved(stream)
    index = KeyIndex(spark, keys, stream.schema, f"{root}/index")
    run_batches(stream.select(*keys), f"{root}/checkpoint", index.add)
    return index
