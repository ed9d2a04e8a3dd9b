"""A fixed-size bitmap of hashes: a semi-join reduction that never loses a match.

Its size does not depend on the data, so sending it to every task is always safe. When it fills
up it lets more rows through to the exact join that follows, and nothing else changes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 2**26 bits: 8 MB, at most 2,048 rows of 4 KB to the driver.
BITS = 1 << 26
_CHUNK = 1 << 15


def bitmap(df: DataFrame, hashed: Column, bits: int = BITS) -> bytes:
    """Bit h modulo `bits` is set for each hash h; built by the tasks in chunks of 4 KB."""
    place = hashed.bitwiseAND(F.lit(bits - 1))
    chunks = (
        df.select(place.alias("place")).filter("place is not null")
        .groupBy(F.shiftright("place", 15).alias("chunk"))
        .agg(F.bitmap_construct_agg(F.col("place").bitwiseAND(F.lit(_CHUNK - 1))).alias("bits"))
    )
    whole = bytearray(bits // 8)
    for row in chunks.collect():  # bits / 2**15 rows at most
        whole[row.chunk * _CHUNK // 8 : (row.chunk + 1) * _CHUNK // 8] = row.bits
    return bytes(whole)


def probe(table: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Whether each hash's bit is set in a bitmap read with `np.frombuffer(..., np.uint8)`."""
    place = hashed & np.uint64(len(table) * 8 - 1)
    bit = np.uint8(1) << (place & np.uint64(7)).astype(np.uint8)
    return (table[(place >> np.uint64(3)).astype(np.int64)] & bit) != 0
