"""A Bloom filter of fixed size over 64-bit hashes: saves work before an exact join.

Its bits are put together by Spark as 64-bit words, so neither the driver nor a task holds more
than the filter, however many hashes there are. Hashes that were put in always pass.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 22
SHIFTS = (0, 21, 42)


def build(frame: DataFrame, hashes: Column):
    """Broadcast bits of the hashes in a column."""
    parts = [F.shiftright("_hash", shift).bitwiseAND(F.lit(BITS - 1)) for shift in SHIFTS]
    places = frame.select(hashes.alias("_hash")).select(F.explode(F.array(*parts)).alias("_place"))
    bit = F.expr("shiftleft(1L, cast(pmod(_place, 64) AS int))")
    rows = (
        places.groupBy(F.shiftright("_place", 6).cast("int").alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
        .toPandas()  # at most BITS / 64 rows
    )
    words = np.zeros(BITS // 64, np.int64)
    words[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return frame.sparkSession.sparkContext.broadcast(words)


def bits(words: np.ndarray) -> np.ndarray:
    """One boolean for each bit."""
    return np.unpackbits(words.view(np.uint8), bitorder="little").view(bool)


def passes(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    hashes = hashes.view(np.uint64)
    found = np.ones(len(hashes), bool)
    for shift in SHIFTS:
        found &= table[(hashes >> np.uint64(shift)) & np.uint64(BITS - 1)]
    return found
