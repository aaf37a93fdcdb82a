"""Fixed-size membership maps: a bounded thing to send to every task, whatever the number of members."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def member_bits(keys: DataFrame, column: str, bits: int = 23) -> np.ndarray:
    """Bit map of 2**bits places (1 MB at 23) with the hashed places of keys[column] set.

    Built by a distributed or-aggregation; at most 2**bits / 64 longs reach the driver however many keys there are.
    A full map only lets more rows through; callers join exactly afterwards.
    """
    place = F.pmod(F.xxhash64(F.col(column)), F.lit(1 << bits))
    got = (
        keys.where(F.col(column).isNotNull())
        .select(place.alias("p"))
        .groupBy(F.shiftright("p", 6).alias("w"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("b"))
        .toPandas()
    )
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[got["w"].to_numpy(dtype=np.int64)] = got["b"].to_numpy(dtype=np.int64)
    return out.view(np.uint64)


def hits(places: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which places (0 .. 64 * len(bits) - 1) are set."""
    places = places.astype(np.int64)
    return (bits[places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1) != 0
