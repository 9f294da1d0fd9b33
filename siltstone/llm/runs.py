"""Periodic runs of words: a harmonic grid of places, extended both ways by a difference-cover index.

A stretch with period p is a streak of words that equal the word p further on.  Each period has a
grid of places so dense that every streak long enough holds one; the streak around it is as long
as the longest common extensions of the place and the one p further on, to the right and to the left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.text import NOT_SPACE, Words, flat, fresh_name, joined_words, ranges, slices, word_ids

#: Of any two residues modulo 31 some shift of both is in the cover: every difference occurs in it once.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
#: Grid places looked at in one go.
POINTS = 1 << 21
_ADDED = ("n_runs", "run_start", "run_length", "run_period", "exponent_milli", "runs", "collapsed")


def _shifts() -> np.ndarray:
    inside = np.isin(np.arange(PERIOD), COVER)
    shifts = np.zeros((PERIOD, PERIOD), np.int64)
    for i in range(PERIOD):
        for j in range(PERIOD):
            shifts[i, j] = next(d for d in range(PERIOD) if inside[(i + d) % PERIOD] and inside[(j + d) % PERIOD])
    return shifts


_SHIFTS = _shifts()


class CoverIndex:
    """Longest common extensions of places in a sequence of numbers from 0 on, up to ``longest``.

    Only suffixes that begin at a place whose remainder is in the cover are sorted.  Two places reach such
    suffixes after the same few steps, which are compared one by one; from there the extension is
    the smallest common prefix of neighbours between the two in the order, from a sparse table.
    """

    def __init__(self, symbols: np.ndarray, longest: int):
        self.symbols = symbols
        size = len(symbols)
        every = np.arange(-(-size // PERIOD))[:, None] * PERIOD + np.array(COVER)
        places = every.ravel()[every.ravel() < size]
        self._number = np.full(PERIOD, -1)
        self._number[list(COVER)] = np.arange(len(COVER))
        levels = self._ranks(places, longest)
        order = np.argsort(levels[-1], kind="stable")
        self._rank = np.empty(len(order), np.int64)
        self._rank[order] = np.arange(len(order))
        self._table = self._sparse(self._common(places, order, levels))

    def _sample(self, place: np.ndarray) -> np.ndarray:
        return place // PERIOD * len(COVER) + self._number[place % PERIOD]

    def _ranks(self, places: np.ndarray, longest: int) -> list[np.ndarray]:
        """Ranks of the sampled suffixes by their first ``PERIOD``, twice, four times ... as many symbols."""
        padded = np.concatenate([self.symbols + 1, np.zeros(PERIOD, np.int64)])  # 0 is behind the end
        width = int(padded.max(initial=1)).bit_length()
        packed = max(62 // width, 1)
        order = np.arange(len(places))
        differs = np.zeros(max(len(places) - 1, 0), bool)
        columns = []
        for first in range(0, PERIOD, packed):
            column = np.zeros(len(places), np.int64)
            for i in range(first, min(first + packed, PERIOD)):
                column = column << width | padded[places + i]
            columns.append(column)
        for column in reversed(columns):
            order = order[np.argsort(column[order], kind="stable")]
        for column in columns:
            differs |= np.diff(column[order]) != 0
        levels = [_named(order, differs)]
        step, covered = len(COVER), PERIOD
        while covered < longest and len(places) and levels[-1].max() < len(places) - 1:
            ahead = np.zeros(len(places), np.int64)
            ahead[: max(len(places) - step, 0)] = levels[-1][step:] + 1
            key = levels[-1] * (len(places) + 1) + ahead
            order = np.argsort(key, kind="stable")
            levels.append(_named(order, np.diff(key[order]) != 0))
            step, covered = step * 2, covered * 2
        return levels

    def _common(self, places: np.ndarray, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common prefix lengths of neighbours in the order; where they are beyond what was ranked, at least that."""
        left, right = order[:-1].copy(), order[1:].copy()
        length = np.zeros(len(left), np.int64)
        for level in range(len(levels) - 1, -1, -1):
            inside = np.flatnonzero((left < len(places)) & (right < len(places)))
            same = inside[levels[level][left[inside]] == levels[level][right[inside]]]
            left[same] += len(COVER) << level
            right[same] += len(COVER) << level
            length[same] += PERIOD << level
        at, other = places[order[:-1]] + length, places[order[1:]] + length
        open_ = np.flatnonzero(np.maximum(at, other) < len(self.symbols))
        for _ in range(PERIOD):
            open_ = open_[self.symbols[at[open_]] == self.symbols[other[open_]]]
            length[open_] += 1
            at[open_] += 1
            other[open_] += 1
            open_ = open_[np.maximum(at[open_], other[open_]) < len(self.symbols)]
        return length

    @staticmethod
    def _sparse(values: np.ndarray) -> list[np.ndarray]:
        tables = [values.astype(np.int32)]
        while (2 << len(tables)) <= 2 * len(values):
            half = 1 << (len(tables) - 1)
            tables.append(np.minimum(tables[-1][:-half], tables[-1][half:]))
        return tables

    def extension(self, i: np.ndarray, j: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many symbols from ``i`` and ``j`` (never the same) on are equal, ``limit`` at most; it must not lead beyond the end."""
        shift = _SHIFTS[i % PERIOD, j % PERIOD]
        direct = np.minimum(shift, limit)
        length = np.zeros(len(i), np.int64)
        going = np.flatnonzero(direct > 0)
        for step in range(PERIOD):
            going = going[self.symbols[i[going] + step] == self.symbols[j[going] + step]]
            length[going] += 1
            going = going[direct[going] > step + 1]
            if not len(going):
                break
        synchronised = np.flatnonzero((length == shift) & (shift < limit))
        s = shift[synchronised]
        a, b = (self._rank[self._sample(x[synchronised] + s)] for x in (i, j))
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp(np.maximum(high - low, 1).astype(np.float64))[1] - 1
        further = np.zeros(len(low), np.int64)
        for used in np.unique(level):
            chosen = level == used
            table = self._table[used]
            further[chosen] = np.minimum(table[low[chosen]], table[high[chosen] - (1 << int(used))])
        length[synchronised] = np.minimum(s + further, limit[synchronised])
        return length


def _named(order: np.ndarray, differs: np.ndarray) -> np.ndarray:
    ranks = np.zeros(len(order), np.int64)
    ranks[order[1:]] = np.cumsum(differs)
    return ranks


def find_runs(symbols: np.ndarray, offsets: np.ndarray, least: int = 24, times: int = 3) -> tuple[np.ndarray, ...]:
    """(row, start in it, length, smallest period) of all runs of the sequences that ``offsets`` bound, in that order.

    A run is a stretch of at least ``least`` symbols and ``times`` periods that no neighbour extends.
    """
    if times < 2 or least < 1:
        raise ValueError("a run has two periods at least")
    counts = np.diff(offsets)
    nothing = (np.zeros(0, np.int64),) * 4
    largest = np.where(counts >= least, counts // times, 0)
    if not largest.any():
        return nothing
    row = np.repeat(np.arange(len(counts)), largest)
    period = ranges(np.ones(len(counts), np.int64), largest)
    # matching places in a run that is just long enough: the grid is as wide
    width = np.maximum(least - period, (times - 1) * period)
    points = (counts[row] - period - 1) // width + 1
    ends = np.cumsum(points)
    index, found, low = None, [], 0
    while low < len(row):
        high = max(int(np.searchsorted(ends, (ends[low - 1] if low else 0) + POINTS, side="right")), low + 1)
        of = np.repeat(np.arange(low, high), points[low:high])
        at = offsets[row[of]] + ranges(np.zeros(high - low, np.int64), points[low:high]) * width[of]
        low = high
        same = symbols[at] == symbols[at + period[of]]
        of, at = of[same], at[same]
        if not len(at):
            continue
        index = index or CoverIndex(symbols, int(counts.max()))
        stop = at + index.extension(at, at + period[of], offsets[1:][row[of]] - at - period[of])
        fresh = np.ones(len(at), bool)  # several places of one streak have the same end
        fresh[1:] = (of[1:] != of[:-1]) | (stop[1:] != stop[:-1])
        found.append((of[fresh], at[fresh], stop[fresh]))
    if not found:
        return nothing
    of, at, stop = (np.concatenate(x) for x in zip(*found, strict=True))
    index = CoverIndex(symbols[::-1], int(counts.max()))
    before = np.zeros(len(at), np.int64)
    inner = np.flatnonzero(at > offsets[row[of]])
    i = at[inner]
    before[inner] = index.extension(len(symbols) - i, len(symbols) - i - period[of[inner]], i - offsets[row[of[inner]]])
    start, p, owner = at - before, period[of], row[of]
    long = stop - start >= width[of]
    start, p, owner, length = start[long], p[long], owner[long], (stop - start)[long] + p[long]
    # a multiple of the smallest period gives the same stretch
    order = np.lexsort((p, length, start, owner))
    start, p, owner, length = start[order], p[order], owner[order], length[order]
    first = np.ones(len(order), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    order = np.lexsort((p[first], start[first], owner[first]))
    owner, start, length, p = (x[first][order] for x in (owner, start, length, p))
    return owner, start - offsets[owner], length, p


def strongest(owner: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """For each owner the place of its run with the greatest length by period; ties to the smaller start, then period."""
    whole, rest = np.divmod(length, period)
    parts = []
    for _ in range(2):  # 64 binary places tell any two such fractions apart
        part, rest = np.divmod(rest << 32, period)
        parts.append(part)
    order = np.lexsort((period, start, -parts[1], -parts[0], -whole, owner))
    first = np.ones(len(order), bool)
    first[1:] = np.diff(owner[order]) != 0
    return order[first]


def collapse_runs(docs: DataFrame, text_col: str = "text", least: int = 24, times: int = 3) -> DataFrame:
    """All rows and columns of ``docs``, with their periodic runs of words and the text without the repetitions.

    Words stand between white space, unchanged, and are compared by their bytes.  A run is a stretch of words
    with smallest period q (words q apart are the same), of ``least`` words and ``times`` periods at
    least, that no neighbouring word extends.  Added are n_runs; run_start (word number), run_length, run_period
    and exponent_milli (thousandths of periods, rounded down) of the run with most periods, ties to the smaller
    start, then period, null without any run; runs (array of start, length, period, by start and period);
    and collapsed, the words that no run contains behind its first period, joined by single spaces.

    Each row counts for itself, so repeated rows give equal results, and no row is shuffled.  Null and empty
    texts have no words, no runs and an empty ``collapsed``.  Texts are worked on whole: a very long one is
    a slice of its own, and takes memory in proportion to its words.  Columns may have any names but those added.
    """
    if clash := {c.lower() for c in docs.columns} & {*_ADDED}:
        raise ValueError(f"rename these columns first: {sorted(clash)}")
    work = fresh_name(docs, "text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, work):
                data, offsets = flat(part.column(work))
                words = Words(data, offsets, NOT_SPACE)
                found = find_runs(word_ids(words, data), words.offsets, least, times)
                owner, start, length, period = found
                edges = np.zeros(len(words.starts) + 1, np.int64)
                np.add.at(edges, words.offsets[owner] + start + period, 1)
                np.add.at(edges, words.offsets[owner] + start + length, -1)
                kept = joined_words(words, data, np.cumsum(edges)[:-1] == 0)
                best = strongest(*found)
                chosen = np.full(part.num_rows, -1)
                chosen[owner[best]] = best
                without = chosen < 0
                pick = [np.append(x, 0)[chosen] for x in (start, length, period)]
                milli = 1000 * pick[1] // np.maximum(pick[2], 1)
                bounds = np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32)
                structs = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], fields=list(kind.value_type))
                new = [pa.array(np.diff(bounds).astype(np.int64)), *(pa.array(x, mask=without) for x in (*pick, milli))]
                new += [pa.ListArray.from_arrays(pa.array(bounds), structs), pa.array([x.decode() for x in kept], pa.string())]
                old = [part.column(i) for i in range(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*old, *new], names=[*part.schema.names[:-1], *_ADDED])

    kinds = "n_runs bigint, run_start bigint, run_length bigint, run_period bigint, exponent_milli bigint"
    kinds += ", runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return docs.withColumn(work, F.col(f"`{text_col}`")).mapInArrow(collapse, f"{fields}, {kinds}")
