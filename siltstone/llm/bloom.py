"""A Bloom filter over 64-bit hashes whose size has a stated bound."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BLOCK_BITS = 15
#: 32 MB. Beyond about 2**24 hashes the filter lets more strangers pass, and the exact join behind it drops them.
MOST_BITS = 1 << 28


def build(hashes: DataFrame, column: str, most_bits: int = MOST_BITS) -> np.ndarray:
    """Bits for the non-null values of ``column``: 16 each, rounded up, within ``most_bits``.

    Each hash has its bits in one block, so a block is made by one small group and
    the driver gets ``most_bits`` at most, whatever the number of hashes.
    """
    known = hashes.select(F.col(column).alias("hash")).where(F.col("hash").isNotNull())
    wanted = max(known.count() * 16, 1)
    depth = min(max(wanted - 1, 1).bit_length(), most_bits.bit_length() - 1) - _BLOCK_BITS
    depth = max(depth, 1)

    def fill(key: tuple, group: pa.Table) -> pa.Table:
        bits = np.zeros(1 << _BLOCK_BITS, bool)
        for place in _places(group.column("hash").to_numpy().view(np.uint64)):
            bits[place] = True
        return pa.table({"block": [key[0].as_py()], "bits": [np.packbits(bits).tobytes()]})

    block = F.shiftrightunsigned("hash", 64 - depth)
    filled = known.distinct().groupBy(block.alias("block")).applyInArrow(fill, "block bigint, bits binary")
    out = np.zeros((1 << depth, (1 << _BLOCK_BITS) // 8), np.uint8)
    for row in filled.toLocalIterator():
        out[row.block] = np.frombuffer(row.bits, np.uint8)
    return out


def holds(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be among those the filter was built from; never False for one that is."""
    depth = int(len(bits)).bit_length() - 1
    block = (hashes >> np.uint64(64 - depth)).astype(np.int64)
    found = np.ones(len(hashes), bool)
    for place in _places(hashes):
        found &= (bits[block, place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1
    return found


def _places(hashes: np.ndarray) -> list[np.ndarray]:
    low = np.uint64((1 << _BLOCK_BITS) - 1)
    return [((hashes >> np.uint64(shift)) & low).astype(np.int64) for shift in (0, 15, 30)]
