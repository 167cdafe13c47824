"""Bloom filters of a fixed number of bits: small enough for every task, whatever goes in.

More entries let more through in error; callers sort that out by joins, so results do not change.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITMAP_BITS = 1 << 24


def bitmap_of(rows: DataFrame, column: str, bits: int = BITMAP_BITS) -> np.ndarray:
    """A Bloom filter of a fixed number of bits over a column of 64-bit hashes, two bits for each."""
    shift, mask = bits.bit_length() - 1, F.lit(bits - 1)
    at = F.explode(
        F.array(
            F.col(column).bitwiseAND(mask),
            F.shiftrightunsigned(column, shift).bitwiseAND(mask),
        )
    )
    n = F.col("at") + 1
    blocks = (
        rows.select(at.alias("at"))
        .groupBy(F.bitmap_bucket_number(n).alias("block"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(n)).alias("set"))
    )
    out = np.zeros(bits // 8, np.uint8)
    for block, found in blocks.collect():  # at most ``bits`` bits
        start = (block - 1) * 4096
        found = np.frombuffer(found, np.uint8)[: len(out) - start]
        out[start : start + len(found)] = found
    return out


def in_bitmap(hashes: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    bits = len(bitmap) * 8
    shift, mask = np.uint64(bits.bit_length() - 1), np.uint64(bits - 1)
    first, second = hashes & mask, (hashes >> shift) & mask
    held = lambda at: (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1
    return (held(first) & held(second)).astype(bool)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
