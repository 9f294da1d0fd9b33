"""Which windows of all texts occur more than once: anchors gather the text that can repeat into shards.

Every window of ``window`` units (words or bytes) has an anchor, the run of ``gram`` units
within it whose hash is smallest, so equal windows have equal anchors.  Windows of an anchor
that occurs only once can't repeat.  The others form segments, which go to the shard of their
anchor; there an index finds the windows they share.  Equal segments are one, with a count.

An anchor with too many segments for a shard is split by a second anchor of the same windows, under another
hash: windows of a segment that have it at the same place are again a segment, equal ones are one, and
those with the same pair of anchors go together.  So it goes on with more hashes while some are too many.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import bloom
from siltstone.llm.stored import stored
from siltstone.llm.text import BYTE_VALUES, NOT_SPACE, Rolling, Words, fingerprint, flat, mix, ranges, signed, slices, starts_within
from siltstone.operators.skew import fits_broadcast

_LOW = np.uint64(0xFFFFFFFF)
_SECOND = np.uint64(0x8CB92BA72F3D8DD7)
#: How often segments are split by one more anchor.  What is then still too many goes window by window.
SPLITS = 3
_KNOWN = 200_000


class WordUnits:
    """Words between white space, in hashes."""

    def __init__(self, column: pa.Array):
        self.data, offsets = flat(column)
        self.words = Words(self.data, offsets, NOT_SPACE)
        self.values, self.offsets = self.words.hashes, self.words.offsets

    def cut(self, start: int, stop: int) -> bytes:
        return self.data[self.words.starts[start] : self.words.stops[stop - 1]].tobytes()


class ByteUnits:
    def __init__(self, column: pa.Array):
        self.data, self.offsets = flat(column)
        self.values = BYTE_VALUES[self.data]

    def cut(self, start: int, stop: int) -> bytes:
        return self.data[start:stop].tobytes()


Units = type[WordUnits] | type[ByteUnits]


class Segments:
    """Runs of windows with the same anchor: units [start, stop), of which ``anchor_at`` begins the anchor."""

    def __init__(self, units: WordUnits | ByteUnits, window: int, gram: int):
        starts = starts_within(units.offsets, window)
        rolling = Rolling(units.values)
        grams = rolling.grams(gram)
        span = window - gram + 1
        # the hash decides, then the place: the leftmost of equal grams
        keys = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
        anchors = (_sliding_minimum(keys, span)[starts] & _LOW).astype(np.int64) if len(starts) else starts
        first = np.flatnonzero(np.diff(anchors, prepend=-1))
        last = np.append(first[1:], len(anchors)) - 1 if len(first) else first
        self.anchor_at, self.start, self.stop = anchors[first], starts[first], starts[last] + window
        self.windows = last - first + 1
        # anchors have small hashes: mixed again, they are spread over shards and filter
        self.anchor = mix(grams[self.anchor_at] ^ _SECOND)
        self.units, self._rolling = units, rolling

    def row(self, chosen: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.units.offsets, self.start[chosen], side="right") - 1

    def ids(self, chosen: np.ndarray) -> np.ndarray:
        """128-bit hashes of the segments and of where their anchors are, as rows of 16 bytes."""
        start, stop = self.start[chosen], self.stop[chosen]
        at = (self.anchor_at[chosen] - start).astype(np.uint64)
        other = Rolling(mix(self.units.values ^ _SECOND)).of(start, stop)
        return np.stack([mix(self._rolling.of(start, stop) + at), mix(other ^ at)], axis=1)


def _sliding_minimum(values: np.ndarray, span: int) -> np.ndarray:
    """Minimum of each run of ``span`` values, from minima within blocks of that length."""
    blocks = -(-len(values) // span)
    padded = np.full(blocks * span, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    table = padded.reshape(blocks, span)
    from_left = np.minimum.accumulate(table, axis=1).ravel()
    from_right = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    count = max(len(values) - span + 1, 0)
    return np.minimum(from_right[:count], from_left[span - 1 : span - 1 + count])


def anchor_counts(docs: DataFrame, units: Units, window: int, gram: int) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found, times = np.unique(Segments(units(part.column("text")), window, gram).anchor, return_counts=True)
                yield pa.RecordBatch.from_pydict({"anchor": signed(found), "times": times.astype(np.int64)})

    return docs.select("text").mapInArrow(count, "anchor bigint, times bigint").groupBy("anchor").agg(F.sum("times").alias("times"))


def occurrences(docs: DataFrame, wanted: np.ndarray, units: Units, window: int, gram: int) -> DataFrame:
    """Segments whose anchor the filter ``wanted`` lets pass, one row each time they occur.

    fp, start (unit of the document), seg, anchor, at (of the anchor in it), windows, and
    payload (its text), which is null where the task has already given it.
    """
    sent = docs.sparkSession.sparkContext.broadcast(wanted)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[bytes] = set()
        for batch in batches:
            for part in slices(batch, "text"):
                segments = Segments(units(part.column("text")), window, gram)
                chosen = np.flatnonzero(bloom.holds(sent.value, segments.anchor))
                row = segments.row(chosen)
                raw = segments.ids(chosen).tobytes()
                ids = [raw[i : i + 16] for i in range(0, len(raw), 16)]
                payloads: list[bytes | None] = []
                for one, start, stop in zip(ids, segments.start[chosen].tolist(), segments.stop[chosen].tolist(), strict=True):
                    payloads.append(None if one in given else segments.units.cut(start, stop))
                    given.add(one)
                if len(given) > _KNOWN:
                    given = set()
                yield pa.RecordBatch.from_pydict(
                    {
                        "fp": part.column("fp").take(pa.array(row)),
                        "start": segments.start[chosen] - segments.units.offsets[row],
                        "seg": pa.array(ids, pa.binary()),
                        "anchor": signed(segments.anchor[chosen]),
                        "at": (segments.anchor_at[chosen] - segments.start[chosen]).astype(np.int32),
                        "windows": segments.windows[chosen].astype(np.int32),
                        "payload": pa.array(payloads, pa.binary()),
                    }
                )

    return docs.mapInArrow(find, "fp binary, start bigint, seg binary, anchor bigint, at int, windows int, payload binary")


_PARTS = "parent binary, index int, seg binary, key bigint, at int, windows int, payload binary, times bigint"


def split_segments(segments: DataFrame, units: Units, window: int, gram: int, level: int) -> DataFrame:
    """Runs of windows of each segment that have the same anchor under one more hash, as segments of their own.

    parent and index say where a part begins; key stands for all anchors that its windows have and how far they
    are apart.  With ``level`` 0 every window is a part, and its key stands for all of its text.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "payload", 1 << 18):
                text = units(part.column("payload"))
                counts = part.column("windows").to_numpy().astype(np.int64)
                row = np.repeat(np.arange(len(counts)), counts)
                index = ranges(np.zeros(len(counts), np.int64), counts)
                start = text.offsets[row] + index
                first, second = Rolling(text.values), Rolling(mix(text.values ^ _SECOND))
                own = text.offsets[:-1] + part.column("at").to_numpy()  # the first anchor of each segment
                if level:
                    grams = mix(first.grams(gram) ^ mix(np.array([level], np.uint64)))
                    keys = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
                    anchor = (_sliding_minimum(keys, window - gram + 1)[start] & _LOW).astype(np.int64)
                    opening = np.ones(len(row), bool)
                    opening[1:] = (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1])
                else:
                    opening = np.ones(len(row), bool)
                low = np.flatnonzero(opening)
                high = np.append(low[1:], len(row))
                row, index, begin = row[low], index[low], start[low]
                stop = begin + (high - low) - 1 + window
                at = own[row] - begin
                mark = at.astype(np.uint64)
                ids = np.stack([mix(first.of(begin, stop) + mark), mix(second.of(begin, stop) ^ mark)], axis=1)
                if level:
                    apart = (anchor[low] - own[row]).view(np.uint64)
                    key = mix(part.column("key").to_numpy().view(np.uint64)[row] ^ mix(grams[anchor[low]] + apart * _SECOND))
                else:
                    key = ids[:, 0]
                raw, rows = ids.tobytes(), pa.array(row)
                columns = {
                    "parent": part.column("seg").take(rows),
                    "index": index.astype(np.int32),
                    "seg": pa.array([raw[i : i + 16] for i in range(0, len(raw), 16)], pa.binary()),
                    "key": signed(np.ascontiguousarray(key)),
                    "at": at.astype(np.int32),
                    "windows": (high - low).astype(np.int32),
                    "payload": pa.array([text.cut(a, b) for a, b in zip(begin.tolist(), stop.tolist(), strict=True)], pa.binary()),
                    "times": part.column("times").take(rows),
                }
                yield pa.RecordBatch.from_pydict(columns)

    return segments.select("seg", "key", "at", "windows", "payload", "times").mapInArrow(split, _PARTS)


def balanced(distinct: DataFrame, units: Units, window: int, gram: int, most: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Segments (seg, key, at, windows, payload, times) of keys that have at most ``most``, and where parts stand in what was split.

    Both are lists, from the segments as they were to the parts of parts.
    """
    settled, places = [], []
    current = distinct
    for level in [*range(1, SPLITS + 1), 0]:
        hot = stored(current.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select("key"), "hot-anchors")
        if hot.isEmpty():
            break
        # more hot keys than can be sent around are joined by a shuffle
        known = F.broadcast(hot) if fits_broadcast(hot) else hot
        settled.append(stored(current.join(known, "key", "left_anti"), "settled"))
        parts = stored(split_segments(current.join(known, "key", "left_semi"), units, window, gram, level), "parts")
        places.append(parts.select("parent", "index", "seg"))
        first = [F.first(c).alias(c) for c in ("key", "at", "windows", "payload")]
        current = stored(parts.groupBy("seg").agg(F.sum("times").alias("times"), *first), "distinct-parts")
    return [*settled, current], places


#: What an index gets and gives: rows of one shard (seg, at, windows, payload, times) to (seg, runs of repeated windows).
Search = Callable[[pa.Table], pa.Table]
_FOUND = "seg binary, runs array<struct<first:int,last:int>>"


def as_runs(segs: list[bytes], bounds: np.ndarray, repeated: np.ndarray) -> pa.Table:
    """Runs of repeated windows of each segment, from one flag per window; segments without any are left out."""
    # a run ends at its segment's end at the latest
    flagged = np.flatnonzero(repeated)
    row = np.searchsorted(bounds, flagged, side="right") - 1
    opening = np.ones(len(flagged), bool)
    opening[1:] = (flagged[1:] != flagged[:-1] + 1) | (row[1:] != row[:-1])
    first = np.flatnonzero(opening)
    last = np.append(first[1:], len(flagged)) - 1 if len(first) else first
    owner = row[first]
    lists: dict[int, list[dict]] = {}
    for i, a, b in zip(owner.tolist(), (flagged[first] - bounds[owner]).tolist(), (flagged[last] - bounds[owner]).tolist(), strict=True):
        lists.setdefault(i, []).append({"first": a, "last": b})
    kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
    return pa.table({"seg": pa.array([segs[i] for i in lists], pa.binary()), "runs": pa.array(list(lists.values()), kind)})


def repeated_spans(docs: DataFrame, text_col: str, units: Units, window: int, gram: int, search: Search, shard_rows: int) -> DataFrame:
    """fp and spans (array of start, stop in units, sorted) of each distinct text in which a window repeats.

    Rows count each for themselves: a text on two rows repeats as a whole.  A shard gets
    about ``shard_rows`` distinct segments; an anchor with more of them is split.
    """
    plain = docs.select(fingerprint(text_col).alias("fp"), F.col(f"`{text_col}`").alias("text"))
    anchors = stored(anchor_counts(plain, units, window, gram).where(F.col("times") > 1).select("anchor"), "anchors")
    found = stored(occurrences(plain, bloom.build(anchors, "anchor"), units, window, gram), "segments")
    first = [F.first(c, ignorenulls=True).alias(c) for c in ("anchor", "at", "windows", "payload")]
    distinct = stored(found.groupBy("seg").agg(F.count(F.lit(1)).alias("times"), *first), "distinct-segments")
    settled, parts = balanced(distinct.withColumnRenamed("anchor", "key"), units, window, gram, shard_rows)
    shards = max(sum(s.count() for s in settled) // shard_rows, 1) * 2
    columns = ["seg", "at", "windows", "payload", "times"]
    rows = [s.select(F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"), *columns) for s in settled]
    # equal windows have equal keys, so they are in one shard, whichever segment they belong to
    every = stored(reduce(DataFrame.unionByName, rows).groupBy("shard").applyInArrow(search, _FOUND), "runs")
    for step in reversed(parts):
        moved = F.transform("runs", lambda x: F.struct((x["first"] + F.col("index")).alias("first"), (x["last"] + F.col("index")).alias("last")))
        whole = step.join(every, "seg").select(F.col("parent").alias("seg"), moved.alias("runs"))
        whole = whole.groupBy("seg").agg(F.flatten(F.collect_list("runs")).alias("runs"))
        every = stored(every.unionByName(whole), "all-runs")
    places = stored(found.select("fp", "start", "seg").distinct(), "places")
    span = F.transform(
        "runs", lambda x: F.struct((F.col("start") + x["first"]).alias("start"), (F.col("start") + x["last"] + window).alias("stop"))
    )
    spans = places.join(every, "seg").select("fp", span.alias("spans"))
    return stored(spans.groupBy("fp").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans")), "spans")


def with_spans(docs: DataFrame, spans: DataFrame, text_col: str, key: str) -> DataFrame:
    """All rows of ``docs`` with the spans of their text, null where there are none."""
    keyed = docs.withColumn(key, fingerprint(text_col))
    return keyed.join(spans.withColumnRenamed("fp", key).hint("merge"), key, "left").drop(key)


def covered(spans: pa.Array, offsets: np.ndarray) -> np.ndarray:
    """Which units lie in a span; ``spans`` holds a list of (start, stop) for each row."""
    edges = np.zeros(int(offsets[-1]) + 1, np.int64)
    known = spans.fill_null(pa.scalar([], spans.type)) if spans.null_count else spans
    counts = np.diff(known.offsets.to_numpy())
    row = np.repeat(np.arange(len(counts)), counts)
    values = known.flatten()
    np.add.at(edges, offsets[row] + values.field("start").to_numpy(), 1)
    np.add.at(edges, offsets[row] + values.field("stop").to_numpy(), -1)
    return np.cumsum(edges)[:-1] > 0
