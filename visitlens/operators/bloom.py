"""Bloom filter of a key set as a column expression.

The bits are set by one aggregate (``bit_or`` per 64-bit word, combined
map-side), so only the words reach the driver, at most ``bits / 64`` however
many keys there are; the test is a built-in expression that runs where the
rows are scanned. A key of the set is always found; others are by mistake at
a rate that grows with the set, so an exact join stands behind the filter.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F

HASHES = 4


def _positions(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits).cast("bigint")) for i in range(HASHES)]


class BloomFilter:
    """A set of ``bits`` bits (a multiple of 64); ``add`` keys, test with ``may_contain``."""

    def __init__(self, bits: int = 1 << 18):
        if bits % 64:
            raise ValueError("bits must be a multiple of 64")
        self.bits = bits
        self.words = [0] * (bits // 64)

    def add(self, keys: DataFrame, column: str) -> None:
        """Set the bits of the column's values."""
        at = keys.select(F.explode(F.array(*_positions(F.col(column), self.bits))).alias("p"))
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"),
                              F.pmod("p", F.lit(64)).cast("int"))
        found = at.groupBy(F.floor(F.col("p") / 64).alias("word")).agg(F.bit_or(bit).alias("bits"))
        for r in found.collect():
            self.words[r["word"]] |= r["bits"] & (2**64 - 1)

    def __bool__(self) -> bool:
        return any(self.words)

    def may_contain(self, column: str) -> Column:
        """False only for values that were never added."""
        signed = [w - 2**64 if w >> 63 else w for w in self.words]
        words = F.from_json(F.lit(json.dumps(signed)), "array<bigint>")   # one folded literal
        out = F.lit(True)
        for p in _positions(F.col(column), self.bits):
            word = F.get(words, F.floor(p / 64).cast("int"))
            out = out & (F.getbit(word, F.pmod(p, F.lit(64)).cast("int")) == 1)
        return out
