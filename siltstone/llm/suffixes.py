"""Byte-level dedup with a logarithmic family of suffix arrays per shard."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.repeats import ByteUnits, Search, as_runs, covered, repeated_spans, with_spans
from siltstone.llm.text import flat, fresh_name, ranges, slices

GRAM = 32
#: Distinct segments of a shard, and of a batch within it.
SHARD_ROWS, BATCH_ROWS = 1500, 300


class Level:
    """A suffix array: places in sorted order of the ``window`` bytes there, one for each distinct string.

    The byte behind them tells where the anchor is, so that only windows of the same anchor are equal.
    """

    def __init__(self, keys: np.ndarray, windows: np.ndarray, batches: int):
        self.keys, self.windows, self.batches = keys, windows, batches

    @staticmethod
    def build(keys: np.ndarray, windows: np.ndarray, repeated: np.ndarray) -> Level:
        order = np.argsort(keys, kind="stable")
        keys, windows = keys[order], windows[order]
        same = keys[1:] == keys[:-1]
        repeated[windows[1:][same]] = True
        repeated[windows[:-1][same]] = True
        fresh = np.ones(len(keys), bool)
        fresh[1:] = ~same
        return Level(keys[fresh], windows[fresh], 1)

    def scan(self, other: Level, repeated: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Marks the strings that both have; where those of ``other`` belong in this one, and which are here already."""
        place = np.searchsorted(self.keys, other.keys)
        here = np.zeros(len(place), bool)
        inside = place < len(self.keys)
        here[inside] = self.keys[place[inside]] == other.keys[inside]
        repeated[other.windows[here]] = True
        repeated[self.windows[place[here]]] = True
        return place, here

    def merge(self, other: Level, repeated: np.ndarray) -> Level:
        place, here = self.scan(other, repeated)
        place, new = place[~here], ~here
        keys = np.insert(self.keys, place, other.keys[new])
        return Level(keys, np.insert(self.windows, place, other.windows[new]), self.batches + other.batches)


def family_search(window: int, batch_rows: int) -> Search:
    """Finds repeated windows in a shard: batches get suffix arrays, which are scanned against the
    levels there are; levels of equal size are merged."""

    def search(shard: pa.Table) -> pa.Table:
        shard = shard.sort_by("seg")
        counts = shard.column("windows").to_numpy().astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum(counts)])
        repeated = np.repeat(shard.column("times").to_numpy() > 1, counts)
        levels: list[Level] = []
        for low in range(0, shard.num_rows, batch_rows):
            part = shard.slice(low, batch_rows).combine_chunks()
            data, offsets = flat(part.column("payload").combine_chunks())
            own = counts[low : low + part.num_rows]
            index = ranges(np.zeros(len(own), np.int64), own)
            start = np.repeat(offsets[:-1], own) + index
            at = np.repeat(part.column("at").to_numpy().astype(np.int64), own) - index
            table = np.empty((len(start), window + 2), np.uint8)
            table[:, :window] = np.lib.stride_tricks.sliding_window_view(data, window)[start]
            table[:, window], table[:, window + 1] = (at >> 7) + 1, (at & 127) + 1
            keys = table.view(f"S{window + 2}").ravel()
            level = Level.build(keys, bounds[low] + np.arange(len(start)), repeated)
            for older in levels:
                older.scan(level, repeated)
            while levels and levels[-1].batches == level.batches:
                level = levels.pop().merge(level, repeated)
            levels.append(level)
        return as_runs(shard.column("seg").to_pylist(), bounds, repeated)

    return search


def drop_repeated_bytes(docs: DataFrame, text_col: str = "text", window: int = 200, gram: int = GRAM, texts: bool = True) -> DataFrame:
    """All rows and columns of ``docs``, with n_bytes, n_removed, n_spans, kept_sha256 and, unless ``texts`` is off, kept (binary).

    A byte goes when it lies in a run of ``window`` bytes that also starts at another place of any
    row, the same one included; runs are judged on the input.  n_spans counts maximal runs of
    bytes that went.  What is kept need not be valid UTF-8.  Null texts are empty.  Repeated
    rows repeat each other.  Columns may have any names but those added.
    """
    added = {"n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"}
    if clash := {c.lower() for c in docs.columns} & added:
        raise ValueError(f"rename these columns first: {sorted(clash)}")
    spans = repeated_spans(docs, text_col, ByteUnits, window, gram, family_search(window, BATCH_ROWS), SHARD_ROWS)
    return _cut_out(docs, spans, text_col, texts)


def _cut_out(docs: DataFrame, spans: DataFrame, text_col: str, keep: bool) -> DataFrame:
    names = fresh_name(docs, "spans"), fresh_name(docs, "text")
    joined = with_spans(docs, spans.withColumnRenamed("spans", names[0]), text_col, fresh_name(docs, "fp"))
    joined = joined.select(*(F.col(f"`{c}`") for c in docs.columns), names[0], F.col(f"`{text_col}`").alias(names[1]))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, names[1]):
                data, offsets = flat(part.column(names[1]))
                gone = covered(part.column(names[0]), offsets)
                edges = np.diff(gone.astype(np.int8), prepend=0) == 1
                edges[offsets[:-1][offsets[:-1] < len(data)]] = gone[offsets[:-1][offsets[:-1] < len(data)]]
                sums = [np.concatenate([[0], np.cumsum(x)])[offsets] for x in (gone, edges)]
                kept = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                new = {"n_bytes": np.diff(offsets), "n_removed": np.diff(sums[0]), "n_spans": np.diff(sums[1])}
                arrays = [part.column(i) for i in range(part.num_columns - 2)] + [pa.array(x) for x in new.values()]
                arrays.append(pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()))
                if keep:
                    arrays.append(pa.array(kept, pa.binary()))
                yield pa.RecordBatch.from_arrays(arrays, names=[*part.schema.names[:-2], *new, "kept_sha256", *(["kept"] if keep else [])])

    kinds = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + (", kept binary" if keep else "")
    return joined.mapInArrow(cut, f"{fields}, {kinds}")
