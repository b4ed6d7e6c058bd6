"""Vectorised hashes of byte strings, and a membership filter of bounded size."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
FILTER_BITS = (24, 27)  # a filter has 2 ** 24 bits (2 MB) to 2 ** 27 (16 MB), whatever it holds
KEY_BITS = 8            # of a filter for each key, within these sizes


@lru_cache(4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse, modulo 2 ** 64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n + 1, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all bits (a bijection)."""
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


class PrefixHash:
    """Hashes of any substrings of ``data``: equal strings have equal hashes, whatever their places."""

    def __init__(self, data: np.ndarray):
        n = 1 << max(16, int(len(data)).bit_length())
        up, down = _powers(n)
        self.down = down
        self.sum = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=self.sum[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sum[ends] - self.sum[starts]) * self.down[starts])


def filter_of(df: DataFrame, column: str) -> np.ndarray:
    """Bitmap of a column of hashes, sized by their number. At most 16 MB of words come to the driver, however long the column.

    A fuller filter lets more rows through to the join that follows; results do not change.
    """
    bits = min(max((KEY_BITS * df.count() - 1).bit_length(), FILTER_BITS[0]), FILTER_BITS[1])
    bit = F.shiftrightunsigned(F.col(column), 64 - bits)
    words = (df.select(F.shiftrightunsigned(bit, 6).alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int")).alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow())
    out = np.zeros(1 << bits - 6, np.uint64)
    out[words["w"].to_numpy()] = words["b"].to_numpy().view(np.uint64)
    return out


def passes(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = hashes >> np.uint64(64 - (len(bitmap).bit_length() + 5))
    return (bitmap[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)
