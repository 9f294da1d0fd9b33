"""Substring dedup with an FM-index per shard: backward search over a wavelet matrix gives matching statistics."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.repeats import Search, WordUnits, as_runs, covered, repeated_spans, with_spans
from siltstone.llm.text import fresh_name, joined_words, ranges, slices

GRAM = 8
SHARD_ROWS = 6000
_MARK = np.uint64(0xC2B2AE3D27D4EB4F)


class Bits:
    """A packed bit vector with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        words = -(-(len(bits) + 1) // 64)
        padded = np.zeros(words * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))]).astype(np.int32)

    def ones(self, place: np.ndarray) -> np.ndarray:
        word, low = place >> 6, (place & 63).astype(np.uint64)
        below = self.words[word] & ((np.uint64(1) << low) - np.uint64(1))
        return self.before[word] + np.bitwise_count(below)


class WaveletMatrix:
    """A sequence of symbols, one bit vector per bit, that counts a symbol before any place."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.levels: list[tuple[int, Bits, int]] = []
        current = symbols
        for shift in range(max(int(largest).bit_length(), 1) - 1, -1, -1):
            bits = (current >> shift) & 1
            self.levels.append((shift, Bits(bits), int((bits == 0).sum())))
            current = np.concatenate([current[bits == 0], current[bits == 1]])
        every = np.arange(largest + 1)
        self.base = self._down(every, np.zeros(largest + 1, np.int64))

    def _down(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.ones(place)
            place = np.where((symbol >> shift) & 1, zeros + ones, place - ones)
        return place

    def count(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How many of the first ``place`` symbols are ``symbol``."""
        return self._down(symbol, place) - self.base[symbol]


class FmIndex:
    """Suffixes of a text in order of their first ``depth`` symbols, as their Burrows-Wheeler transform.

    Patterns of less than ``depth`` symbols are found exactly.  Beside the transform it keeps the
    common prefixes of neighbouring suffixes, so that an interval can be widened when a match is
    cut short at its end.
    """

    def __init__(self, text: np.ndarray, depth: int):
        largest = int(text.max()) if len(text) else 0
        ranks = [text.astype(np.int64)]
        order = np.argsort(ranks[0], kind="stable")
        size = 1
        while size < depth:
            rank = ranks[-1]
            ahead = np.full(len(rank), -1, np.int64)
            ahead[: max(len(rank) - size, 0)] = rank[size:]
            key = rank * (len(rank) + 2) + ahead + 1
            order = np.argsort(key, kind="stable")
            sorted_key = key[order]
            fresh = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])]) if len(key) else key
            following = np.empty(len(key), np.int64)
            following[order] = fresh
            ranks.append(following)
            size *= 2
        self.size = len(text)
        self.wavelet = WaveletMatrix(text[order - 1] if len(text) else text, largest)
        counts = np.bincount(text, minlength=largest + 1)
        self.first = np.cumsum(counts) - counts
        self._common = self._prefixes(order, ranks)

    def _prefixes(self, order: np.ndarray, ranks: list[np.ndarray]) -> list[np.ndarray]:
        """Minima of common prefix lengths of neighbours in the order, over runs of 1, 2, 4, ... of them."""
        common = np.zeros(self.size + 1, np.int64)
        if self.size > 1:
            left, right = order[:-1].copy(), order[1:].copy()
            length = np.zeros(self.size - 1, np.int64)
            for level in range(len(ranks) - 1, -1, -1):
                inside = (left < self.size) & (right < self.size)
                same = np.zeros(self.size - 1, bool)
                same[inside] = ranks[level][left[inside]] == ranks[level][right[inside]]
                step = same.astype(np.int64) << level
                left, right, length = left + step, right + step, length + step
            common[1:-1] = length
        common = np.minimum(common, 255).astype(np.uint8)
        common[0] = common[-1] = 0
        tables = [common]
        while (1 << len(tables)) <= len(common):
            half = 1 << (len(tables) - 1)
            tables.append(np.minimum(tables[-1][:-half], tables[-1][half:]))
        return tables

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the suffixes that have ``symbol`` before what [low, high) has in common."""
        first = self.first[symbol]
        return first + self.wavelet.count(symbol, low), first + self.wavelet.count(symbol, high)

    def widen(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The next larger intervals with a common prefix, and its length: matches cut short at the end."""
        length = np.maximum(self._common[0][low], self._common[0][high]).astype(np.int64)
        low, high = low.copy(), high.copy()
        for level in range(len(self._common) - 1, -1, -1):
            table, step = self._common[level], 1 << level
            # entries low, low - 1, ... as long as suffixes share the prefix with the one before
            begin = low - step + 1
            at = np.maximum(begin, 0)
            moves = (begin > 0) & (table[at] >= length)
            low = np.where(moves, low - step, low)
            end = high + step
            at = np.minimum(high, len(table) - 1)
            moves = (end <= self.size) & (high < len(table)) & (table[at] >= length)
            high = np.where(moves, end, high)
        return low, high, length

    def matching_statistics(self, pattern: np.ndarray, starts: np.ndarray, stops: np.ndarray, at_least: int) -> np.ndarray:
        """For each place of ``pattern`` within a [start, stop): the length of the longest match that
        begins there and has ``at_least`` occurrences in the text.

        All runs go from right to left at once: a match is extended to the left while enough
        suffixes have it, else it is cut short at its end until it can be.
        """
        found = np.zeros(len(pattern), np.int64)
        place, start = stops.copy(), starts
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), self.size)
        length = np.zeros(len(starts), np.int64)
        active = np.flatnonzero(place > start)
        while len(active):
            lo, hi, symbol = low[active], high[active], pattern[place[active] - 1]
            new_lo, new_hi = self.extend(symbol, lo, hi)
            fits = new_hi - new_lo >= at_least
            empty = ~fits & (length[active] == 0)
            moved = active[fits]
            low[moved], high[moved] = new_lo[fits], new_hi[fits]
            length[moved] += 1
            place[moved] -= 1
            found[place[moved]] = length[moved]
            place[active[empty]] -= 1
            cut = active[~fits & ~empty]
            if len(cut):
                low[cut], high[cut], length[cut] = self.widen(low[cut], high[cut])
            active = active[place[active] > start[active]]
        return found


def index_search(window: int) -> Search:
    """Finds repeated windows in a shard: its distinct segments are the text of an FM-index, and those
    that occur once are streamed against it.  A window repeats if it has two occurrences in the index.

    The word at which a segment's anchor begins is another symbol there than elsewhere, so a
    window is found at its own anchor only, once in each distinct segment.
    """

    def search(shard: pa.Table) -> pa.Table:
        shard = shard.sort_by("seg")
        units = WordUnits(shard.column("payload").combine_chunks())
        counts = shard.column("windows").to_numpy().astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum(counts)])
        values = units.values.copy()
        values[units.offsets[:-1] + shard.column("at").to_numpy()] ^= _MARK
        _, symbols = np.unique(values, return_inverse=True)
        lengths = np.diff(units.offsets)
        place = np.arange(len(symbols)) + np.repeat(np.arange(len(lengths)), lengths)
        text = np.zeros(len(symbols) + len(lengths), np.int64)  # 0 ends each segment
        text[place] = symbols + 1
        starts = units.offsets[:-1] + np.arange(len(lengths))
        repeated = np.repeat(shard.column("times").to_numpy() > 1, counts)
        once = shard.column("times").to_numpy() == 1
        index = FmIndex(text, 2 * window)
        matches = index.matching_statistics(text, starts[once], starts[once] + lengths[once], 2)
        first = ranges(starts, counts)
        repeated |= matches[first] >= window
        return as_runs(shard.column("seg").to_pylist(), bounds, repeated)

    return search


def drop_repeated_words(docs: DataFrame, text_col: str = "text", window: int = 35, gram: int = GRAM, texts: bool = True) -> DataFrame:
    """All rows and columns of ``docs``, with n_words, n_removed, kept_sha256 and, unless ``texts`` is off, kept.

    Words stand between white space, unchanged.  A word goes when it lies in a run of ``window``
    words that also starts at another place of any row, the same one included; runs are judged on
    the input.  kept joins what is left by single spaces.  Null and empty texts have no words.
    Repeated rows repeat each other.  Columns may have any names but those added.  Words are
    compared by 64-bit hashes.
    """
    if clash := {c.lower() for c in docs.columns} & {"n_words", "n_removed", "kept", "kept_sha256"}:
        raise ValueError(f"rename these columns first: {sorted(clash)}")
    spans = repeated_spans(docs, text_col, WordUnits, window, gram, index_search(window), SHARD_ROWS)
    names = fresh_name(docs, "spans"), fresh_name(docs, "text")
    joined = with_spans(docs, spans.withColumnRenamed("spans", names[0]), text_col, fresh_name(docs, "fp"))
    joined = joined.select(*(F.col(f"`{c}`") for c in docs.columns), names[0], F.col(f"`{text_col}`").alias(names[1]))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, names[1]):
                units = WordUnits(part.column(names[1]))
                gone = covered(part.column(names[0]), units.offsets)
                kept = joined_words(units.words, units.data, ~gone)
                removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[units.offsets])
                arrays = [part.column(i) for i in range(part.num_columns - 2)]
                arrays += [pa.array(np.diff(units.offsets)), pa.array(removed), pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())]
                if texts:
                    arrays.append(pa.array([x.decode() for x in kept], pa.string()))
                new = ["n_words", "n_removed", "kept_sha256", *(["kept"] if texts else [])]
                yield pa.RecordBatch.from_arrays(arrays, names=[*part.schema.names[:-2], *new])

    kinds = "n_words bigint, n_removed bigint, kept_sha256 string" + (", kept string" if texts else "")
    return joined.mapInArrow(cut, f"{fields}, {kinds}")
