"""Change targets that a run brings up to date at a cost that follows its new changes.

Keys are dealt to buckets by an extendible hash: a bucket is named by how many bits of the hash it goes by and
what they are, and one that outgrows a bound of bytes is split by more bits, without touching others.  A
bucket has a base, a folder of settled changes (type 1: the latest of each key, type 2: all versions with
their ends, deletes included), and deltas, folders of the changes that runs have brought since.  A run writes
deltas only.  Readers merge them with the base, but for nothing else than the keys that deltas have; once the
deltas of a bucket are a fair part of its base, they are folded into a new base, so that on the whole each
byte of changes causes a few bytes of writing, however large the table is.

A manifest, of which the newest version counts, says which folders make up the target and which batches of
the log are in them, so a run that fails leaves the target as it was and the next one takes the same batches.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from siltstone.functions.names import BATCH, RESERVED, RUN
from siltstone.functions.rules import holds
from siltstone.operators.cdc import END, START
from siltstone.operators.skew import fits_broadcast
from siltstone.sources.writers import write_table

if TYPE_CHECKING:
    from siltstone.streaming.cdc import Feed

BUCKET = f"{RESERVED}bucket"
#: A base beyond so many bytes is split when it is next written.
MOST_BYTES = 256 << 20
#: Deltas are folded once they have more than this part of the base's bytes, and joined once they are more than so many.
FOLD_SHARE, MOST_DELTAS = 0.25, 16
_MOST_BITS = 48
_MANIFEST = "run string, batch bigint, schema string, bucket string, place int, folder string, bytes bigint"


@dataclass(frozen=True)
class Bucket:
    """Folders below the root, and their bytes."""

    base: str | None = None
    base_bytes: int = 0
    deltas: tuple[tuple[str, int], ...] = ()

    @property
    def delta_bytes(self) -> int:
        return sum(size for _, size in self.deltas)

    @property
    def folders(self) -> list[str]:
        return [*([self.base] if self.base else []), *(folder for folder, _ in self.deltas)]


@dataclass(frozen=True)
class Manifest:
    """Buckets by name (bits and their value), the last batch taken of each run of the log, and the schema of the feed."""

    version: int = -1
    seen: dict[str, int] = field(default_factory=dict)
    schema: StructType | None = None
    buckets: dict[str, Bucket] = field(default_factory=lambda: {"0-0": Bucket()})

    @property
    def changes(self) -> dict[str, list[str]]:
        return {name: bucket.folders for name, bucket in self.buckets.items() if bucket.folders}


def read_manifest(spark: SparkSession, root: str) -> Manifest:
    """The newest version: a row for each folder and each run of the log, however long the log is."""
    try:
        every = spark.read.schema(f"{_MANIFEST}, version bigint").parquet(f"{root}/manifest")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return Manifest()
    rows = every.where(F.col("version") == every.agg(F.max("version")).scalar()).orderBy("bucket", "place").collect()
    if not rows:
        return Manifest()
    seen = {row["run"]: row["batch"] for row in rows if row["run"] is not None}
    schema = next(StructType.fromDDL(row["schema"]) for row in rows if row["schema"] is not None)
    buckets: dict[str, Bucket] = {}
    for row in rows:
        if row["bucket"] is None:
            continue
        known = buckets.get(row["bucket"], Bucket())
        if row["place"] == 0:
            known = replace(known, base=row["folder"], base_bytes=row["bytes"])
        elif row["place"] > 0:
            known = replace(known, deltas=(*known.deltas, (row["folder"], row["bytes"])))
        buckets[row["bucket"]] = known
    return Manifest(rows[0]["version"], seen, schema, buckets)


def _write_manifest(spark: SparkSession, manifest: Manifest, root: str) -> None:
    rows = [(run, batch, None, None, None, None, None) for run, batch in manifest.seen.items()]
    rows.append((None, None, _ddl(manifest.schema), None, None, None, None))
    for name, bucket in manifest.buckets.items():
        rows.append((None, None, None, name, -1, None, None))  # an empty bucket counts too
        if bucket.base:
            rows.append((None, None, None, name, 0, bucket.base, bucket.base_bytes))
        rows += [(None, None, None, name, i + 1, folder, size) for i, (folder, size) in enumerate(bucket.deltas)]
    found = spark.createDataFrame(rows, _MANIFEST)
    found.coalesce(1).write.mode("error").parquet(f"{root}/manifest/version={manifest.version}")


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)


def pending(
    spark: SparkSession, root: str, manifest: Manifest, log: str | None = None, schema: StructType | None = None
) -> DataFrame:
    """Changes of the log that are not in the target; only their folders are read.  ``schema`` is that of the feed as it is now."""
    old = [(F.col(RUN) == run) & (F.col(BATCH) <= batch) for run, batch in manifest.seen.items()]
    reader = spark.read
    if schema is not None:
        reader = reader.schema(StructType(list(schema.fields)).add(RUN, StringType()).add(BATCH, LongType()))
    found = reader.parquet(log or f"{root}/log")
    return found.where(~reduce(lambda a, b: a | b, old)) if old else found


def bucket_of(keys: Sequence[str], names: Iterable[str]) -> Column:
    """The bucket of each row: for each number of bits there is, whether these bits of the hash name one."""
    by_bits: dict[int, list[int]] = {}
    for name in names:
        bits, value = map(int, name.split("-"))
        by_bits.setdefault(bits, []).append(value)
    hashed = F.xxhash64(*keys)
    found = []
    for bits, values in sorted(by_bits.items()):
        value = hashed.bitwiseAND(F.lit((1 << bits) - 1))
        found.append(F.when(value.isin(values), F.concat(F.lit(f"{bits}-"), value.cast("string"))))
    return F.coalesce(*found)


def bring_up_to_date(
    spark: SparkSession,
    feed: Feed,
    scd_type: int,
    root: str,
    log: str | None = None,
    schema: StructType | None = None,
    most_bytes: int = MOST_BYTES,
) -> bool:
    """Takes pending changes of the log (below ``root`` unless ``log`` names it) into the target; whether there were any."""
    manifest = read_manifest(spark, root)
    fresh = pending(spark, root, manifest, log, schema)
    seen = {row[0]: row[1] for row in fresh.groupBy(RUN).agg(F.max(BATCH)).collect()}
    if not seen:
        return False
    changes = fresh.drop(RUN, BATCH)
    delta = feed.latest(changes) if scd_type == 1 else feed.settled(changes)
    written = _stored(spark, delta, bucket_of(feed.keys, manifest.buckets), f"{root}/delta-{uuid.uuid4().hex}", root)
    manifest = Manifest(manifest.version + 1, manifest.seen | seen, _together(manifest.schema, delta.schema), dict(manifest.buckets))
    for name, folder in written.items():
        bucket = manifest.buckets[name]
        manifest.buckets[name] = replace(bucket, deltas=(*bucket.deltas, folder))
    due = [n for n in written if (b := manifest.buckets[n]).base is None or b.delta_bytes > FOLD_SHARE * b.base_bytes]
    many = [n for n in written if n not in due and len(manifest.buckets[n].deltas) > MOST_DELTAS]
    _fold(spark, feed, scd_type, root, manifest, due, most_bytes)
    _join_deltas(spark, feed, scd_type, root, manifest, many)
    _write_manifest(spark, manifest, root)
    return True


def _together(known: StructType | None, new: StructType) -> StructType:
    """The columns of the feed so far, and those that are new; all can be missing in some rows."""
    fields = list(known.fields) if known else []
    fields += [f for f in new.fields if f.name not in {k.name for k in fields}]
    return StructType([StructField(f.name, f.dataType) for f in fields])


def _stored(spark: SparkSession, df: DataFrame, bucket: Column, path: str, root: str) -> dict[str, tuple[str, int]]:
    """Writes a folder for each bucket; their names below ``root`` and their bytes."""
    write_table(df.withColumn(BUCKET, bucket), path, [BUCKET], mode="error", rebalance=True)
    files = spark.read.schema("__none int").parquet(path).select("_metadata.file_path", "_metadata.file_size").distinct()
    name = F.regexp_extract("file_path", f"{BUCKET}=([^/]+)/", 1).alias("bucket")
    sizes = files.groupBy(name).agg(F.sum("file_size").alias("bytes")).collect()
    below = path.removeprefix(f"{root}/")
    return {row["bucket"]: (f"{below}/{BUCKET}={row['bucket']}", row["bytes"]) for row in sizes}


def _read(spark: SparkSession, root: str, schema: StructType, folders: Sequence[str]) -> DataFrame:
    return spark.read.schema(schema).parquet(*(f"{root}/{folder}" for folder in folders))


def _base_schema(schema: StructType, feed: Feed, scd_type: int) -> StructType:
    return schema if scd_type == 1 else StructType([*schema.fields, StructField(END, schema[feed.sequence_by].dataType)])


def _rows(spark: SparkSession, feed: Feed, scd_type: int, root: str, manifest: Manifest, names: Sequence[str]) -> DataFrame:
    """Settled rows of buckets, as a base has them: those of keys without deltas as they are stored."""
    buckets = [manifest.buckets[n] for n in names]
    schema = _base_schema(manifest.schema, feed, scd_type)
    clean = [b.base for b in buckets if b.base and not b.deltas]
    parts = [_read(spark, root, schema, clean)] if clean else []
    settle = feed.latest if scd_type == 1 else feed.versions
    if deltas := [folder for b in buckets for folder, _ in b.deltas]:
        new = _read(spark, root, manifest.schema, deltas)
        bases = [b.base for b in buckets if b.base and b.deltas]
        if not bases:
            parts.append(settle(new))
        else:
            base = _read(spark, root, schema, bases)
            touched = new.select(*(F.col(k).alias(f"__touched_{i}") for i, k in enumerate(feed.keys))).distinct()
            touched = F.broadcast(touched) if fits_broadcast(touched) else touched
            same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__touched_{i}")) for i, k in enumerate(feed.keys)))
            parts.append(base.join(touched, same, "left_anti"))
            old = base.join(touched, same, "left_semi").select(*manifest.schema.names)
            parts.append(settle(old.unionByName(new)))
    if not parts:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts)


def _fold(spark: SparkSession, feed: Feed, scd_type: int, root: str, manifest: Manifest, names: list[str], most_bytes: int) -> None:
    """New bases for buckets, with their deltas in them; those beyond the bound are split, but never a single key."""
    if not names:
        return
    children = {n: [n] for n in names}
    size = {n: (b := manifest.buckets[n]).base_bytes + b.delta_bytes for n in names}
    if large := [n for n in names if size[n] > most_bytes]:
        held = _read(spark, root, manifest.schema, [f for n in large for f in manifest.buckets[n].folders])
        keys = held.groupBy(bucket_of(feed.keys, large).alias("bucket")).agg(F.approx_count_distinct(F.xxhash64(*feed.keys)).alias("keys"))
        for row in keys.collect():
            bits, value = map(int, row["bucket"].split("-"))
            more = math.ceil(math.log2(size[row["bucket"]] / most_bytes))
            more = max(min(more, math.ceil(math.log2(max(row["keys"], 1))), _MOST_BITS - bits), 0)
            children[row["bucket"]] = [f"{bits + more}-{value | i << bits}" for i in range(1 << more)]
    every = [c for found in children.values() for c in found]
    rows = _rows(spark, feed, scd_type, root, manifest, names)
    written = _stored(spark, rows, bucket_of(feed.keys, every), f"{root}/base-{uuid.uuid4().hex}", root)
    for name in names:
        del manifest.buckets[name]
    for child in every:
        folder, held_bytes = written.get(child, (None, 0))
        manifest.buckets[child] = Bucket(folder, held_bytes)


def _join_deltas(spark: SparkSession, feed: Feed, scd_type: int, root: str, manifest: Manifest, names: list[str]) -> None:
    """One delta in place of many small ones; bases stay."""
    if not names:
        return
    rows = _read(spark, root, manifest.schema, [f for n in names for f, _ in manifest.buckets[n].deltas])
    rows = feed.latest(rows) if scd_type == 1 else feed.settled(rows)
    written = _stored(spark, rows, bucket_of(feed.keys, names), f"{root}/delta-{uuid.uuid4().hex}", root)
    for name in names:
        manifest.buckets[name] = replace(manifest.buckets[name], deltas=(written[name],))


def read_target(spark: SparkSession, feed: Feed, scd_type: int, root: str) -> DataFrame:
    """The target as of the last run: what it has in its bases, merged with the changes since then."""
    manifest = read_manifest(spark, root)
    if manifest.schema is None:
        raise ValueError(f"no run has brought changes to {root}")
    rows = _rows(spark, feed, scd_type, root, manifest, list(manifest.buckets))
    if feed.deletes is not None:
        rows = rows.where(~holds(feed.deletes))
    payload = [F.col(f"`{c}`") for c in manifest.schema.names if c not in {*feed.keys, *feed.except_cols}]
    ends = [] if scd_type == 1 else [F.col(feed.sequence_by).alias(START), F.col(END)]
    return rows.select(*feed.keys, *payload, *ends)


def publish_target(spark: SparkSession, feed: Feed, scd_type: int, root: str, name: str) -> None:
    """Lets readers of this session find the target, as of now, as ``name``; others call :func:`read_target`."""
    read_target(spark, feed, scd_type, root).createOrReplaceTempView(name)
