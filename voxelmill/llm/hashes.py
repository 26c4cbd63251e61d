"""A bit table of bounded size over 64-bit hashes, for use inside numpy code."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the smallest and largest table (128 kB and 32 MB), and bits for every hash between them.
LEAST, MOST, EACH = 1 << 20, 1 << 28, 16


@dataclass(frozen=True)
class BitTable:
    """Tells of a hash that it isn't in a column, or that it may be."""

    size: int
    data: Broadcast[bytes]

    def may_hold(self, h: np.ndarray) -> np.ndarray:
        at = (h.view(np.uint64) & np.uint64(self.size - 1)).astype(np.int64)
        return (np.frombuffer(self.data.value, np.uint8)[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def bit_table(wanted: DataFrame, column: str) -> BitTable:
    """The bit table of a long column of a written table: 32 MB at most whatever the row count. Nulls count for nothing."""
    size = min(MOST, max(LEAST, 1 << int(wanted.count() * EACH).bit_length()))
    maps = (
        wanted.where(F.col(column).isNotNull()).select((F.col(column).bitwiseAND(F.lit(size - 1)) + 1).alias("_bit"))
        .groupBy(F.bitmap_bucket_number("_bit").alias("no")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("bits"))
    )
    table = np.zeros(size // 8, np.uint8)
    for no, bits in maps.collect():
        table[(no - 1) * 4096 : no * 4096] |= np.frombuffer(bits, np.uint8)
    return BitTable(size, wanted.sparkSession.sparkContext.broadcast(table.tobytes()))
