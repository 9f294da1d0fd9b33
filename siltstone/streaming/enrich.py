"""Enrichment batch by batch, for references that change or are too large to broadcast."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame

from siltstone.operators.asof import enrich_as_of
from siltstone.operators.joins import enrich
from siltstone.streaming.ingest import run_batches, write_batch


def run_enriched(
    stream: DataFrame,
    reference: Callable[[], DataFrame],
    on: Sequence[str],
    select: Sequence[str],
    rename: Mapping[str, str] | None,
    path: str,
    checkpoint: str,
) -> int:
    """Append enriched rows, one folder per micro-batch; returns how many rows were read.

    The reference of a plain stream-static join is fixed when the query starts.
    Here ``reference`` is called for each batch, and a batch, unlike a stream,
    has its hot keys spread when the reference is too large to broadcast.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(enrich(batch, reference(), on, select, rename), batch_id, path)

    return run_batches(stream, checkpoint, write)


def run_enriched_as_of(
    stream: DataFrame,
    versions: Callable[[], DataFrame],
    on: Sequence[str],
    at: str,
    valid_from: str,
    select: Sequence[str],
    rename: Mapping[str, str] | None,
    path: str,
    checkpoint: str,
    valid_to: str | None = None,
) -> int:
    """Like :func:`run_enriched`, but with the version that was valid at each row's own time, however late it comes."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(enrich_as_of(batch, versions(), on, at, valid_from, select, rename, valid_to), batch_id, path)

    return run_batches(stream, checkpoint, write)
