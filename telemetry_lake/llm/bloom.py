"""A blocked Bloom filter: one 256-bit block per key, eight bits set in it."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Odd multipliers that pick the bit of each of a block's eight words.
SALTS = [0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31]
BITS_PER_KEY = 16
# The filter never grows beyond this. With more keys it lets more strangers through,
# which the exact join behind it removes; the result stays the same.
MAX_BYTES = 8 << 20


def _bit(low: Column, salt: int) -> Column:
    # 32-bit multiplication in 64 bits: split the salt, so that no product overflows.
    high, rest = salt >> 16, salt & 0xFFFF
    product = ((low * F.lit(high)).bitwiseAND(F.lit(0xFFFF)) * F.lit(1 << 16) + low * F.lit(rest)).bitwiseAND(
        F.lit(0xFFFFFFFF)
    )
    return F.shiftright(product, 27).cast("int")


def build(keys: DataFrame, hash_col: str, max_bytes: int = MAX_BYTES) -> np.ndarray:
    """The filter over a column of 64-bit hashes, as blocks x 8 words.

    Spark ORs the words of each block, map side first; the driver gets one row per
    block that is used, at most `max_bytes` in all.
    """
    count = keys.count()
    blocks = max(1, min(max_bytes // 32, -(-count * BITS_PER_KEY // 256)))
    key = F.col(hash_col)
    low = key.bitwiseAND(F.lit(0xFFFFFFFF))
    words = [
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), _bit(low, salt))).alias(f"w{i}")
        for i, salt in enumerate(SALTS)
    ]
    grouped = keys.groupBy((F.shiftrightunsigned(key, 32) % F.lit(blocks)).alias("block")).agg(*words)
    bits = np.zeros((blocks, len(SALTS)), dtype=np.uint32)
    used = grouped.toPandas()
    if len(used):
        bits[used["block"].to_numpy()] = used[[f"w{i}" for i in range(len(SALTS))]].to_numpy().astype(np.uint32)
    return bits


def might_contain(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """False only for hashes that were not among the keys."""
    hashes = hashes.astype(np.int64).view(np.uint64)
    block = bits[(hashes >> np.uint64(32)) % np.uint64(len(bits))]
    low = (hashes & np.uint64(0xFFFFFFFF))[:, None]
    bit = ((low * np.array(SALTS, dtype=np.uint64)) & np.uint64(0xFFFFFFFF)) >> np.uint64(27)
    return ((block >> bit.astype(np.uint32)) & np.uint32(1)).all(axis=1)
