"""MurmurHash3 (x86, 32 bits, seed 0) of case-folded names; Spark's own ``hash`` has another seed and tail."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, functions as F

_M = 0xFFFFFFFF


def _rotl(x: int, n: int) -> int:
    return (x << n | x >> 32 - n) & _M


def murmur3(data: bytes, seed: int = 0) -> int:
    """Signed 32-bit value."""
    h, whole = seed, len(data) // 4 * 4
    for i in range(0, len(data), 4):
        k = int.from_bytes(data[i : i + 4], "little") * 0xCC9E2D51 & _M
        k = _rotl(k, 15) * 0x1B873593 & _M
        h ^= k
        if i < whole:
            h = (_rotl(h, 13) * 5 + 0xE6546B64) & _M
    h ^= len(data)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
        h = (h ^ h >> shift) * factor & _M
    return h - (1 << 32) if h >> 31 else h


def name_hash(name: Column) -> Column:
    """For distinct names: join the hashes back to the rows."""

    @F.pandas_udf("int")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else murmur3(x.casefold().encode("utf-8")))

    return run(name)
