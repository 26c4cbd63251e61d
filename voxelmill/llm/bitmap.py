"""A bitmap of bounded size that tells which rows needn't be shuffled for a join."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the smallest and largest bitmap (128 kB and 32 MB), and bits for every key between them.
LEAST, MOST, EACH = 1 << 20, 1 << 28, 16


@dataclass(frozen=True)
class Bitmap:
    bits: int
    data: Broadcast[bytes]


def _bit(key: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def bitmap(wanted: DataFrame, key: str) -> Bitmap:
    """The bitmap of a column of a written table, built by aggregation; 32 MB at most whatever the row count."""
    size = min(MOST, max(LEAST, 1 << int(wanted.count() * EACH).bit_length()))
    maps = (
        wanted.select((_bit(key, size) + 1).alias("_bit"))
        .groupBy(F.bitmap_bucket_number("_bit").alias("no")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("bits"))
    )
    table = np.zeros(size // 8, np.uint8)
    for no, bits in maps.collect():
        table[(no - 1) * 4096 : no * 4096] |= np.frombuffer(bits, np.uint8)
    return Bitmap(size, wanted.sparkSession.sparkContext.broadcast(table.tobytes()))


def filtered(rows: DataFrame, key: str, shared: Bitmap, inside: bool = True) -> DataFrame:
    """Rows whose key may be in the bitmap's column, or those whose key can't be. The more keys a bitmap
    holds, the fewer rows it tells apart, but no row is lost: a join of the first part must follow."""
    data, bit = shared.data, "_bit"
    while bit in rows.columns:
        bit += "_"

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(data.value, np.uint8)
        for batch in batches:
            at = batch.column(bit).to_numpy()
            yield batch.filter(pa.array(((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1) == inside))

    marked = rows.withColumn(bit, _bit(key, shared.bits))
    return marked.mapInArrow(keep, marked.schema).drop(bit)


def only_of(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    return filtered(rows, key, bitmap(wanted, key))
