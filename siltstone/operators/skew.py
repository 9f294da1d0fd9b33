"""Joins that stay balanced when one key holds a large part of all rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DatetimeType, NumericType

ROWS = "__rows"
FAN = "__fan"
SHARES = 4096
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 256 * 1024**2
_FIXED_WIDTH = (NumericType, BooleanType, DatetimeType)

_SALT, _PARTS, _ROW = "__salt", "__parts", "__row"


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key, keys with a NULL part left out; combined before the shuffle."""
    return df.where(~any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS))


def fan_of(counts: DataFrame, shares: int = SHARES) -> Column:
    """Into how many parts a counted key should be split: one per ``shares``-th of all rows.

    All parts beyond each key's first together number less than ``shares``,
    and fewer than ``shares`` keys have more than one, whatever the data.
    That makes hot keys safe to broadcast and their matches safe to repeat.
    """
    share = F.col(ROWS) * F.lit(shares) / counts.agg(F.sum(ROWS)).scalar()
    return F.greatest(F.ceil(share), F.lit(1)).cast("int")


def hot_keys(counts: DataFrame, shares: int = SHARES) -> DataFrame:
    """Keys that hold more than one share, with their number of parts."""
    return counts.withColumn(FAN, fan_of(counts, shares)).where(F.col(FAN) > 1)


def any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))


def skew_left_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    hot: DataFrame | None = None,
    shares: int = SHARES,
) -> DataFrame:
    """Left equi-join that spreads hot and NULL keys of ``left`` over many tasks.

    A hot row is salted with a hash of its values and of the partition it sits
    in, and the matching rows on the right are repeated once per part of their
    key.  Rows are spread both where they lie in many partitions and where the
    left side is clustered by the key already.  Neither values nor partition
    change when a task runs again, so a lost executor cannot send the same row
    to two places.  ``hot`` takes hot keys already known.
    """
    keys = list(keys)
    hot = hot_keys(key_counts(left, keys), shares) if hot is None else hot
    hot = F.broadcast(hot.select(*keys, FAN))
    spread = F.when(any_null(keys), F.lit(shares)).otherwise(F.coalesce(FAN, F.lit(1)))
    salt = F.xxhash64(F.spark_partition_id(), *_hashable(left))
    salted = left.join(hot, keys, "left").withColumn(_SALT, F.pmod(salt, spread))
    parts = F.sequence(F.lit(0), F.coalesce(FAN, F.lit(1)) - 1)
    repeated = right.join(hot, keys, "left").withColumn(_SALT, F.explode(parts))
    added = [c for c in right.columns if c not in keys]
    return salted.drop(FAN).join(repeated.drop(FAN), [*keys, _SALT], "left").select(*left.columns, *added)


def skew_left_flags(
    left: DataFrame, rights: Sequence[tuple[DataFrame, Sequence[str], DataFrame]], shares: int = SHARES
) -> DataFrame:
    """What left joins with several tables of flags would add, spread like :func:`skew_left_join`, behind one shuffle of ``left``.

    ``rights`` holds tables of keys and a flag, one row per key, the names of
    the keys, and which of them are hot.  All have the same key columns, or some of
    them these and the same further ones.  Joins on different columns would
    shuffle each by its own, so keys travel among the rows and windows hand on
    their flags.  All go by the shared columns and a salt.  Within a hot shared
    key the salt follows the further columns, so a key is repeated no more
    often than it has parts itself.
    """
    shared, whole = (list(end((keys for _, keys, _ in rights), key=len)) for end in (min, max))
    further = [k for k in whole if k not in shared]
    hot = {len(keys): hot for _, keys, hot in rights}

    def with_parts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        for of, name in ((shared, _PARTS), (whole, FAN)):
            if len(of) <= len(keys):
                df = df.join(F.broadcast(hot[len(of)].select(*of, F.col(FAN).alias(name))), of, "left")
        return df

    parts = F.coalesce(_PARTS, F.lit(1))
    # whole keys are counted without those that have a NULL, so their shares may be the larger ones
    own = F.least(F.coalesce(FAN, F.lit(1)), parts)
    start = F.pmod(F.xxhash64(*further), parts) if further else F.lit(0)
    place = F.xxhash64(F.spark_partition_id(), *_hashable(left))
    salt = F.when(any_null(shared), F.pmod(place, F.lit(shares))).when(any_null(whole), F.pmod(place, parts))
    salt = salt.otherwise(F.pmod(start + F.pmod(place, own), parts)).cast("int")
    rows, flags = with_parts(left, whole).select(*left.columns, salt.alias(_SALT), F.lit(True).alias(_ROW)), {}
    for right, keys, _ in rights:
        copies = F.sequence(F.lit(0), parts - 1)
        if len(keys) == len(whole):
            copies = F.transform(F.sequence(F.lit(0), own - 1), lambda i: F.pmod(start + i, parts).cast("int"))
        repeated = with_parts(right, keys).select(*right.columns, F.explode(copies).alias(_SALT))
        rows = rows.unionByName(repeated, allowMissingColumns=True)
        flags |= {c: keys for c in right.columns if c not in keys}
    rows = rows.repartition(*shared, _SALT)
    group = Window.partitionBy(_SALT, *shared)
    if further:  # the order that windows of whole keys need, so rows are sorted once
        group = group.orderBy(*further).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    for flag, keys in flags.items():
        within = group if len(keys) == len(shared) else Window.partitionBy(_SALT, *shared, *further)
        rows = rows.withColumn(flag, F.max(flag).over(within))
    return rows.where(_ROW).select(*left.columns, *flags)


def _hashable(df: DataFrame) -> list[Column]:
    """Columns that can be hashed: all but those with a map or a variant inside."""
    return [F.col(f"`{f.name}`") for f in df.schema.fields if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows with ``max_bytes`` of text in all.

    Looks for one row beyond them.  Spark reads a few partitions first and
    more only while it has not found it, so a large table is not counted.
    Bytes are summed only once the rows are known to be few.
    """
    if df.select(F.lit(1).alias("one")).offset(max_rows).limit(1).collect():
        return False
    of_any_length = [f.name for f in df.schema.fields if not isinstance(f.dataType, _FIXED_WIDTH)]
    if not of_any_length:
        return True
    width = reduce(lambda a, b: a + b, (_text_bytes(F.col(f"`{name}`")) for name in of_any_length))
    return (df.agg(F.sum(width)).first()[0] or 0) <= max_bytes


def _text_bytes(column: Column) -> Column:
    return F.coalesce(F.octet_length(column.cast("string")), F.lit(0)).cast("bigint")
