"""Line dedup: content-defined chunks of lines, compared by their bytes, stay only where they come first.

A chunk ends where the rolling hash of the line hashes says so, wherever the lines stand, so copies of a passage
are cut alike but for what lies around its ends.  Chunks of several lines that also stand at a smaller place
go whole.  Around them, and in chunks that have no earlier copy, passages are followed line by
line: there every two neighbouring lines are a chunk of their own, also across boundaries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import bloom
from siltstone.llm.stored import stored
from siltstone.llm.text import Rolling, fingerprint, flat, fresh_name, ranges, run_hashes, signed, slices

_NEWLINE = 0x0A
#: A chunk ends behind a line when the rolling hash of the last WINDOW lines is divisible by DIVISOR.
WINDOW, DIVISOR = 1, 2
_PAIR = np.uint64(0xA24BAED4963EE407)


class Lines:
    """Lines of the texts of a slice: where each starts and stops in ``data``, and its row; an empty text has none."""

    def __init__(self, column: pa.Array):
        data, offsets = flat(column)
        lengths = np.diff(offsets)
        # a line feed behind every text closes its last line
        padded = np.full(len(data) + len(lengths), _NEWLINE, np.uint8)
        self.offsets = offsets + np.arange(len(offsets))
        inside = np.ones(len(padded), bool)
        inside[self.offsets[1:] - 1] = False
        padded[inside] = data
        self.data = padded
        stops = np.flatnonzero(padded == _NEWLINE)
        starts = np.concatenate([[0], stops[:-1] + 1]) if len(stops) else stops
        row = np.searchsorted(self.offsets, starts, side="right") - 1
        kept = lengths[row] > 0 if len(row) else np.zeros(0, bool)
        self.starts, self.stops, self.owner = starts[kept], stops[kept], row[kept]
        self.lines = np.bincount(self.owner, minlength=len(lengths))


class Chunks(Lines):
    """Chunks of the non-empty lines of each text, with the empty ones between them: row, start, stop, hash, and several.

    Only the last ``window`` lines of the text decide where a chunk ends, so lines put in before a passage move
    the boundaries within it by ``window`` lines at most.
    """

    def __init__(self, column: pa.Array, window: int = WINDOW, divisor: int = DIVISOR):
        super().__init__(column)
        self.filled = np.flatnonzero(self.stops > self.starts)
        owner, at = self.owner[self.filled], np.arange(len(self.filled))
        self._hashes = run_hashes(self.data, self.starts[self.filled], self.stops[self.filled])
        self._rolling = Rolling(self._hashes)
        counts = np.bincount(owner, minlength=len(self.lines))
        opening = np.cumsum(counts) - counts
        ends = self._rolling.of(np.maximum(at - window + 1, opening[owner]), at + 1) % np.uint64(divisor) == 0
        ends[(opening + counts)[counts > 0] - 1] = True
        self.last = np.flatnonzero(ends)
        self.first = np.concatenate([[0], self.last[:-1] + 1]) if len(self.last) else self.last
        self.row, self.several = owner[self.first], self.last > self.first
        self.start, self.stop = self._span(self.first, self.last)
        self.hash = self._rolling.of(self.first, self.last + 1)

    def _span(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        base = self.offsets[self.owner[self.filled[first]]]
        return self.starts[self.filled[first]] - base, self.stops[self.filled[last]] - base

    def pairs(self) -> tuple[np.ndarray, ...]:
        """Every two neighbours: (row, start, stop, hash, start of the chunk that holds both or -1 where they meet at a boundary)."""
        owner = self.owner[self.filled]
        first = np.flatnonzero(owner[1:] == owner[:-1]) if len(owner) else owner
        chunk = np.searchsorted(self.last, first)
        within = np.where(self.last[chunk] > first, self.start[chunk], -1) if len(first) else first
        return owner[first], *self._span(first, first + 1), self._rolling.of(first, first + 2) ^ _PAIR, within

    def text(self, row: int, start: int, stop: int) -> bytes:
        base = self.offsets[row]
        return self.data[base + start : base + stop].tobytes()


def hash_counts(docs: DataFrame, text_col: str, window: int, divisor: int) -> DataFrame:
    """How often each chunk of several lines, and each two neighbouring lines, occur in the corpus, by hash."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                chunks = Chunks(part.column("text"), window, divisor)
                found, times = np.unique(np.concatenate([chunks.hash[chunks.several], chunks.pairs()[3]]), return_counts=True)
                yield pa.RecordBatch.from_pydict({"hash": signed(found), "times": times.astype(np.int64)})

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "hash bigint, times bigint")
    return counted.groupBy("hash").agg(F.sum("times").alias("times"))


def occurrences(docs: DataFrame, wanted: np.ndarray, text_col: str, id_col: str, window: int, divisor: int) -> DataFrame:
    """Chunks and pairs that the filter ``wanted`` lets pass: id, fp, whole (a chunk), within, hash, body (their bytes), start, stop."""
    sent = docs.sparkSession.sparkContext.broadcast(wanted)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                chunks = Chunks(part.column("text"), window, divisor)
                own = tuple(x[chunks.several] for x in (chunks.row, chunks.start, chunks.stop, chunks.hash, chunks.start))
                row, start, stop, hashes, within = (np.concatenate(x) for x in zip(own, chunks.pairs(), strict=True))
                whole = np.arange(len(row)) < len(own[0])
                chosen = bloom.holds(sent.value, hashes)
                row, start, stop, hashes, within, whole = (x[chosen] for x in (row, start, stop, hashes, within, whole))
                bodies = [chunks.text(*x) for x in zip(row.tolist(), start.tolist(), stop.tolist(), strict=True)]
                columns = {
                    "id": part.column("id").take(pa.array(row)),
                    "fp": part.column("fp").take(pa.array(row)),
                    "whole": whole,
                    "within": within,
                    "hash": signed(hashes),
                    "body": pa.array(bodies, pa.binary()),
                    "start": start,
                    "stop": stop,
                }
                yield pa.RecordBatch.from_pydict(columns)

    plain = docs.select(F.col(id_col).alias("id"), fingerprint(text_col).alias("fp"), F.col(text_col).alias("text"))
    kind = plain.schema["id"].dataType.simpleString()
    return plain.mapInArrow(find, f"id {kind}, fp binary, whole boolean, within bigint, hash bigint, body binary, start bigint, stop bigint")


def drop_repeated_lines(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", window: int = WINDOW, divisor: int = DIVISOR
) -> DataFrame:
    """All rows and columns of ``docs`` without repeated passages of two or more non-empty lines, and n_lines, n_removed_lines.

    A line goes when it is in a passage whose bytes also stand at a smaller (id, text fingerprint, place), null
    ids last; empty lines go with the lines around them.  Of every line that goes an equal one stays at a smaller
    place.  Chunks are found by hash, but compared by their bytes; ``window`` and ``divisor`` say how they
    are cut, and change nothing in the result.  Rows that agree in id and text are one document that was repeated:
    they are treated alike.  Null texts stay null and have no lines, nor have empty ones; a text whose lines
    all go becomes empty, its row stays.  Columns may have any names but n_lines and n_removed_lines.
    """
    if clash := {c.lower() for c in docs.columns} & {"n_lines", "n_removed_lines"}:
        raise ValueError(f"rename these columns first: {sorted(clash)}")
    repeated = stored(hash_counts(docs, text_col, window, divisor).where(F.col("times") > 1).select("hash"), "chunk-hashes")
    found = stored(occurrences(docs, bloom.build(repeated, "hash"), text_col, id_col, window, divisor), "chunks")
    chunks = stored(_later(found.where("whole")).distinct(), "later-chunks")
    # a chunk that has an earlier copy is settled, and so are all pairs in it: its first copy stays to be compared with others
    settled = F.struct("id", "fp", F.col("start").alias("within"))
    own = F.struct("id", "fp", "within").eqNullSafe(F.col("settled"))
    open_ = found.where("NOT whole").join(chunks.select(settled.alias("settled")).hint("merge"), own, "left_anti")
    spans = chunks.unionByName(_later(stored(open_, "open-pairs"))).distinct()
    spans = spans.groupBy("id", "fp").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return _taken_out(docs, stored(spans, "line-spans"), text_col, id_col)


def _later(found: DataFrame) -> DataFrame:
    """Occurrences (id, fp, start, stop) whose bytes also stand at a smaller place."""
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "fp", "start")
    first = found.groupBy("hash", "body").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times"))
    first = stored(first.where(F.col("times") > 1).drop("times"), "chunk-firsts")
    return found.join(first, ["hash", "body"]).where(~place.eqNullSafe(F.col("first"))).select("id", "fp", "start", "stop")


def _taken_out(docs: DataFrame, spans: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """``docs`` without the lines that lie in the spans (id, fp, spans) of their text, and counts of lines."""
    key, gone, work = fresh_name(docs, "key"), fresh_name(docs, "spans"), fresh_name(docs, "text")
    spans = spans.select(F.struct("id", "fp").alias(key), F.col("spans").alias(gone)).hint("merge").alias("s")
    keyed = docs.withColumn(key, F.struct(F.col(f"`{id_col}`").alias("id"), fingerprint(text_col).alias("fp"))).alias("d")
    joined = keyed.join(spans, F.col(f"d.{key}").eqNullSafe(F.col(f"s.{key}")), "left")
    joined = joined.select(*(F.col(f"d.`{c}`") for c in docs.columns), F.col(f"s.{gone}"), F.col(f"d.`{text_col}`").alias(work))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    place = docs.columns.index(text_col)

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, work):
                texts, lines = part.column(work), Lines(part.column(work))
                kept = ~_covered(lines, part.column(gone))
                sizes = np.where(kept, lines.stops + 1 - lines.starts, 0)
                data = lines.data[ranges(lines.starts, sizes)]
                ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(lines.lines)])]
                # without the line feed that closes a text
                rest = [None if null else data[a : max(b - 1, a)].tobytes().decode() for a, b, null in zip(ends[:-1], ends[1:], texts.is_null().to_pylist(), strict=True)]
                columns = [part.column(i) for i in range(part.num_columns - 2)]
                columns[place] = pa.array(rest, pa.string())
                removed = np.bincount(lines.owner, ~kept, part.num_rows).astype(np.int64)
                columns += [pa.array(lines.lines.astype(np.int64)), pa.array(removed)]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names[:-2], "n_lines", "n_removed_lines"])

    return joined.mapInArrow(take, f"{fields}, n_lines bigint, n_removed_lines bigint")


def _covered(lines: Lines, spans: pa.Array) -> np.ndarray:
    """Which lines lie in the spans of their row."""
    known = spans.fill_null(pa.scalar([], spans.type)) if spans.null_count else spans
    counts = np.diff(known.offsets.to_numpy())
    base = lines.offsets[np.repeat(np.arange(len(counts)), counts)]
    values = known.flatten()
    edges = np.zeros(len(lines.starts) + 1, np.int64)
    np.add.at(edges, np.searchsorted(lines.starts, base + values.field("start").to_numpy()), 1)
    np.add.at(edges, np.searchsorted(lines.starts, base + values.field("stop").to_numpy()), -1)
    return np.cumsum(edges)[:-1] > 0
