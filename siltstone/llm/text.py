"""Arrow text columns as numpy arrays: words, hashes and rolling hashes of whole batches at once.

All functions work on the concatenated UTF-8 bytes of many documents, so no Python code runs per word.
A null text counts as an empty one.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Text held as numpy arrays at one time, unless one document is longer.
SLICE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def fingerprint(text: str | Column) -> Column:
    """16 bytes that stand for a text; rows with equal texts get equal results everywhere here."""
    column = F.col(text) if isinstance(text, str) else text
    return F.unhex(F.md5(F.coalesce(column, F.lit("")).cast("binary")))


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    name = f"__{stem}"
    while name.lower() in taken:
        name += "_"
    return name


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most ``limit`` bytes in ``column``, or a single longer row."""
    if not batch.num_rows:
        return
    _, offsets = flat(batch.column(column))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop
    give_back()


def give_back() -> None:
    """Returns freed memory to the system: workers live on behind a slice, and are used for other stages."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


@functools.lru_cache(maxsize=1)
def _trim() -> Callable[[int], int] | None:
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and where each row begins and the last ends."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values so that all their bits depend on all bits of the input."""
    x = values ^ (values >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, size: int) -> np.ndarray:
    if len(_powers[kind]) < size:
        factors = np.full(max(size, 1 << 21), _BASE if kind == "up" else _BASE_INVERSE, np.uint64)
        factors[0] = 1
        _powers[kind] = np.cumprod(factors)
    return _powers[kind][:size]


class Rolling:
    """Hashes of any runs of a sequence of 64-bit values, from one pass of prefix sums."""

    def __init__(self, values: np.ndarray):
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * _power("up", len(values)), out=self.sums[1:])

    def of(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        down = _power("down", len(self.sums))
        return mix((self.sums[stops] - self.sums[starts]) * down[starts] + (stops - starts).astype(np.uint64))

    def grams(self, size: int) -> np.ndarray:
        """Hashes of all runs of ``size`` values, one for each start."""
        count = max(len(self.sums) - size, 0)
        down = _power("down", len(self.sums))[:count]
        return mix((self.sums[size : size + count] - self.sums[:count]) * down + np.uint64(size))


#: A 64-bit value for each byte.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))


def run_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Hashes of runs of bytes of any length: the sum of their pieces of eight bytes, each mixed with its place.

    Unlike a polynomial modulo 2**64 it has no long runs that always agree (Thue-Morse words).
    """
    lengths = stops - starts
    pieces = (lengths + 7) >> 3
    first = np.cumsum(pieces) - pieces
    number = ranges(np.zeros(len(pieces), np.int64), pieces)
    at = np.repeat(starts, pieces) + number * 8
    padded = np.append(data, np.zeros(8, np.uint8))
    values = np.lib.stride_tricks.sliding_window_view(padded, 8)[at].view("<u8").ravel()
    held = np.minimum(np.repeat(lengths, pieces) - number * 8, 8).astype(np.uint64)
    values &= np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(8) * (np.uint64(8) - held))
    values = mix(mix(values + held) ^ mix((number.astype(np.uint64) + np.uint64(1)) * _BASE))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    return mix(sums[first + pieces] - sums[first] + lengths.astype(np.uint64) * _BASE)


class Words:
    """Words of many documents: byte spans, hashes and which words belong to which document."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
        inside = is_word[data]
        before = np.zeros(len(data), bool)
        before[1:] = inside[:-1]
        edges = offsets[:-1][offsets[:-1] < len(data)]
        before[edges] = False
        after = np.zeros(len(data), bool)
        after[:-1] = inside[1:]
        ends = offsets[1:][offsets[1:] > 0]
        after[ends - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.stops = np.flatnonzero(inside & ~after) + 1
        self.offsets = np.searchsorted(self.starts, offsets)
        self.hashes = run_hashes(data, self.starts, self.stops)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def word_ids(words: Words, data: np.ndarray) -> np.ndarray:
    """A number for each word, equal for equal bytes only: hashes name the words, and every word is compared with the first of its name."""
    _, first, ids = np.unique(words.hashes, return_index=True, return_inverse=True)
    lengths = words.stops - words.starts
    model = first[ids]
    wrong = lengths != lengths[model]
    places = ranges(words.starts, np.where(wrong, 0, lengths))
    others = ranges(words.starts[model], np.where(wrong, 0, lengths))
    differs = data[places] != data[others]
    if wrong.any() or differs.any():
        names: dict[bytes, int] = {}
        parts = [data[a:b].tobytes() for a, b in zip(words.starts.tolist(), words.stops.tolist(), strict=True)]
        ids = np.array([names.setdefault(p, len(names)) for p in parts], np.int64)
    return ids.astype(np.int64)


def joined_words(words: Words, data: np.ndarray, keep: np.ndarray) -> list[bytes]:
    """The words with ``keep`` of each document, joined by single spaces."""
    starts, lengths = words.starts[keep], (words.stops - words.starts)[keep] + 1
    text = np.append(data, np.uint8(0x20))[ranges(starts, lengths)]
    stops = np.cumsum(lengths)
    text[stops - 1] = 0x20
    kept = np.concatenate([[0], np.cumsum(keep)])[words.offsets]
    ends = np.concatenate([[0], stops])[kept]
    return [text[a : max(b - 1, a)].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]


#: Word bytes between white space: all but space, tab, line feed, vertical tab, form feed and carriage return.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: ASCII digits and lower-case letters and every byte of a character beyond ASCII.
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

#: Bytes with A-Z lower-cased.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def starts_within(offsets: np.ndarray, size: int) -> np.ndarray:
    """Starts of all runs of ``size`` units that stay within one document."""
    counts = np.maximum(np.diff(offsets) - size + 1, 0)
    return ranges(offsets[:-1], counts)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each pair, one after the other."""
    total = int(counts.sum())
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) if total else np.zeros(0, np.int64)
    return np.arange(total, dtype=np.int64) + shift


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)
