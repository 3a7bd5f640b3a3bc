"""Sets of hashes as bits: of a fixed size, never missing a member, at times taking in others."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bit_set(keys: DataFrame, key: str, bits: int) -> bytes:
    """The low bits of 64-bit keys as a set; ``bits`` bounds what reaches the driver."""
    place = F.col(key).bitwiseAND(F.lit(bits - 1).cast("long"))
    found = (
        keys.select(place.alias("place"))
        .groupBy(F.shiftright("place", 6).alias("k"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(place & 63 as int)))").alias("v"))
        .toArrow()
    )
    words = np.zeros(bits // 64, np.int64)
    words[found.column("k").to_numpy()] = found.column("v").to_numpy()
    return words.tobytes()


def in_bit_set(held: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys may be in a set, given as bytes; those that are, surely are among them."""
    place = keys & (8 * len(held) - 1)
    return (held[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
