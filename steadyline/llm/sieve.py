"""A bit table of fixed size over 64-bit hashes, for turning away what cannot match before it is moved.

A hash that was put in is always let through; others are turned away as long as the table is not full. So a
sieve never decides a result: whatever passes is compared exactly afterwards. Its size does not depend on the data.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 26  # 8 MB
_PLACES = 2


def sent(hashes: DataFrame, column: str) -> Broadcast:
    """The table of a column for use in tasks, see :func:`opened`. Few bits are sent as few bytes."""
    return hashes.sparkSession.sparkContext.broadcast(zlib.compress(build(hashes, column).tobytes(), 1))


def opened(table: Broadcast) -> np.ndarray:
    return np.frombuffer(zlib.decompress(table.value), np.uint64)


def build(hashes: DataFrame, column: str) -> np.ndarray:
    """The table of all values of a long column, put together by Spark: at most 2^20 words reach the driver."""
    at = F.array(*[F.shiftrightunsigned(column, 64 - BITS * (k + 1)) for k in range(_PLACES)])
    places = hashes.select(F.explode(at).alias("at")).select(F.col("at").bitwiseAND(F.lit((1 << BITS) - 1)).alias("at"))
    words = places.groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(at & 63 AS INT))")).alias("bits")
    )
    found = words.toArrow()
    table = np.zeros(1 << (BITS - 6), np.uint64)
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return table


def passes(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the unsigned 64-bit ``hashes`` may have been put in."""
    found = np.ones(len(hashes), bool)
    for k in range(_PLACES):
        at = (hashes >> np.uint64(64 - BITS * (k + 1))) & np.uint64((1 << BITS) - 1)
        found &= (table[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return found
