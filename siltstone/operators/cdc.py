"""Change feeds to current state (type 1) and full history (type 2).

The highest sequence wins whatever the order of arrival.  A row is a delete
only where the predicate is true.  Equal changes collapse into one; differing
changes with the same key and sequence are settled by the order of their
values, so the outcome never depends on partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.rules import holds
from siltstone.operators.chunks import CHUNK as _CHUNK
from siltstone.operators.chunks import NEXT as _NEXT
from siltstone.operators.chunks import SEQ as _SEQ
from siltstone.operators.chunks import cuts_of as _cuts
from siltstone.operators.chunks import with_chunk as _with_chunk
from siltstone.operators.skew import SHARES

START = "__START_AT"
END = "__END_AT"

_GONE = "__gone"


def _gone(deletes: str | Column | None) -> Column:
    return F.lit(False) if deletes is None else holds(deletes)


def _payload(changes: DataFrame, keys: Sequence[str], except_cols: Sequence[str]) -> list[str]:
    return [c for c in changes.columns if c not in {*keys, *except_cols}]


def latest_changes(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    deletes: str | Column | None = None,
    except_cols: Sequence[str] = (),
) -> DataFrame:
    """The winning change of each key, deletes included, in the columns of the feed.

    One aggregate, combined before the shuffle: a hot key sends one row per map task.
    """
    payload = _payload(changes, keys, except_cols)
    ranked = [*payload, *(c for c in changes.columns if c not in {*keys, *payload})]
    winner = F.max(F.struct(F.col(sequence_by).alias(_SEQ), _gone(deletes).alias(_GONE), *ranked))
    return (
        changes.groupBy(*keys)
        .agg(winner.alias("__winner"))
        .select(*(F.col(c) if c in keys else F.col(f"__winner.`{c}`") for c in changes.columns))
    )


def scd1(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    deletes: str | Column | None = None,
    except_cols: Sequence[str] = (),
) -> DataFrame:
    """Current rows: the latest change per key, keys whose latest change is a delete left out."""
    payload = _payload(changes, keys, except_cols)
    winner = F.max(F.struct(F.col(sequence_by).alias(_SEQ), _gone(deletes).alias(_GONE), *payload))
    return (
        changes.groupBy(*keys)
        .agg(winner.alias("__winner"))
        .where(~F.col(f"__winner.{_GONE}"))
        .select(*keys, *(F.col(f"__winner.`{c}`") for c in payload))
    )


def scd2(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    deletes: str | Column | None = None,
    except_cols: Sequence[str] = (),
    distinct: bool = False,
    shares: int = SHARES,
) -> DataFrame:
    """All versions with ``__START_AT`` and ``__END_AT`` (NULL: still current).

    A delete closes the open version and yields none itself.  The history of a
    hot key is cut into chunks by sequence, so that no task sorts all of it;
    a chunk's last version ends at the cut that begins the next chunk.

    ``distinct`` promises that no key and sequence occur twice in the feed; it
    saves settling repetitions.
    """
    payload = _payload(changes, keys, except_cols)
    found = versions(changes, keys, sequence_by, deletes, except_cols, distinct, shares).where(~_gone(deletes))
    return found.select(*keys, *payload, F.col(sequence_by).alias(START), F.col(END))


def versions(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    deletes: str | Column | None = None,
    except_cols: Sequence[str] = (),
    distinct: bool = False,
    shares: int = SHARES,
) -> DataFrame:
    """One change of each key and sequence, deletes included, in the columns of the feed, and ``__END_AT``, the sequence of the next one.

    Chunks come first, by sequences alone, so that repetitions are settled and versions ordered in one shuffle.
    """
    keys = list(keys)
    feed = changes.withColumn(_SEQ, F.col(sequence_by))
    cuts = _cuts(feed.select(*keys, _SEQ), keys, shares)
    chunked = _with_chunk(feed, keys, cuts).repartition(*keys, _CHUNK)
    if not distinct:
        chunked = _settled(chunked, [*keys, _CHUNK, _NEXT], deletes, keys, except_cols, changes.columns)
    follower = F.lead(_SEQ).over(Window.partitionBy(*keys, _CHUNK).orderBy(_SEQ))
    return chunked.withColumn(END, F.coalesce(follower, _NEXT)).select(*changes.columns, END)


def settled_changes(
    changes: DataFrame, keys: Sequence[str], sequence_by: str, deletes: str | Column | None = None, except_cols: Sequence[str] = ()
) -> DataFrame:
    """One change of each key and sequence, in the columns of the feed: of differing ones a delete, else that of greatest values."""
    feed = changes.withColumn(_SEQ, F.col(sequence_by))
    return _settled(feed, list(keys), deletes, keys, except_cols, changes.columns).select(*changes.columns)


def _settled(
    feed: DataFrame, groups: list[str], deletes: str | Column | None, keys: Sequence[str], except_cols: Sequence[str], columns: list[str]
) -> DataFrame:
    payload = [c for c in columns if c not in {*keys, *except_cols}]
    rest = [c for c in columns if c not in {*keys, *payload}]
    winner = F.max(F.struct(_gone(deletes).alias(_GONE), *payload, *rest)).alias("__version")
    picked = [F.col(c) if c in keys else F.col(f"__version.`{c}`").alias(c) for c in columns]
    others = [c for c in groups if c not in keys]
    return feed.groupBy(*groups, _SEQ).agg(winner).select(*picked, *others, _SEQ)
