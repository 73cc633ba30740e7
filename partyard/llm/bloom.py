"""Bloom filter of fixed size: a bounded broadcast that stands before an exact join.

However many terms there are, the filter keeps its size; with more terms it only lets
more rows through, which the join behind it drops.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 21  # three slices of a 63-bit hash; 2 ** 21 bits are 256 KiB
SLICES = 3
SEED = 42  # the seed of Spark's xxhash64


def build(terms: DataFrame, term: Column) -> bytes:
    """Filter over a string column; at most 2 ** 15 rows of it reach the driver."""
    h = F.xxhash64(term)
    places = F.array(*(F.shiftrightunsigned(h, k * BITS).bitwiseAND(F.lit((1 << BITS) - 1)) for k in range(SLICES)))
    at = F.col("at")
    slots = (
        terms.select(F.explode(places).alias("at"))
        .groupBy(F.shiftright(at, 6).alias("slot"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int"))).alias("mask"))
        .collect()
    )
    out = np.zeros(1 << (BITS - 6), np.int64)
    for row in slots:
        out[row.slot] = row.mask
    return out.tobytes()


class Passed(dict):
    """``passed[word]``: may the word be among the terms?  Answers are remembered."""

    def __init__(self, filled: bytes, most: int = 1_000_000) -> None:
        super().__init__()
        self.bits, self.most = np.frombuffer(filled, np.int64).tolist(), most

    def __missing__(self, word: str) -> bool:
        if len(self) >= self.most:
            self.clear()
        h, mask, bits = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), SEED), (1 << BITS) - 1, self.bits
        answer = self[word] = all(
            bits[(p := (h >> (k * BITS)) & mask) >> 6] >> (p & 63) & 1 for k in range(SLICES)
        )
        return answer
