"""A bit table of fixed size that tells which keys cannot be in a set.

It only thins what goes into an exact join, so its false positives change no
result; its size is a parameter, so it can be collected and broadcast however
large the set is.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 26


class Bloom:
    """Of a column of 64-bit hashes; two bits for each."""

    def __init__(self, df: DataFrame, column: str):
        mask = (1 << BITS) - 1
        slots = F.array(*[F.shiftrightunsigned(F.col(column), s).bitwiseAND(F.lit(mask)) for s in (0, BITS)])
        words = df.select(F.explode(slots).alias("s")).select(
            F.shiftright("s", 6).alias("w"), F.expr("shiftleft(1L, cast(s & 63 as int))").alias("b"))
        got = words.groupBy("w").agg(F.expr("bit_or(b)").alias("b")).toArrow()  # 2 ** (BITS - 6) rows at most
        self.table = np.zeros(1 << (BITS - 6), np.uint64)
        self.table[got["w"].to_numpy()] = got["b"].to_numpy().view(np.uint64)

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        k = keys.view(np.uint64)
        out = np.ones(len(k), bool)
        for s in (0, BITS):
            slot = (k >> np.uint64(s)) & np.uint64((1 << BITS) - 1)
            out &= (self.table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
        return out
