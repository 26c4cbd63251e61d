"""Geometry of volumes in voxel form: boxes, axes, shifts, filling, chunk grids, packing.

A volume in voxel form has one integer column per axis and a value column ``v``; absent rows are zero.
All but ``densify`` and ``pack`` are narrow projections and filters, so box predicates reach the scan."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelmill.functions.arithmetic import SPARK_TYPE, ceil_div, floor_div

AXES = ("z", "y", "x")
BLOCKS = "origin array<long>, shape array<int>, dtype string, data binary"


def voxelize(rows: DataFrame, values: str, axis: str = "x", keep: Sequence[str] = (), v: str = "v") -> DataFrame:
    """One row per element of an array column; the element's index becomes an axis."""
    return rows.select(*keep, F.posexplode(values).alias(axis, v)).withColumn(axis, F.col(axis).cast("long"))


def box(df: DataFrame, bounds: Mapping[str, tuple[int, int]], rebase: bool = False) -> DataFrame:
    """Voxels with start <= axis < stop; with ``rebase`` the box starts at 0 on every axis."""
    out = df.where(reduce(lambda a, b: a & b, [(F.col(k) >= lo) & (F.col(k) < hi) for k, (lo, hi) in bounds.items()]))
    return shifted(out, {k: -lo for k, (lo, _) in bounds.items()}) if rebase else out


def box_on_chunks(df: DataFrame, bounds: Mapping[str, tuple[int, int]], chunk: Mapping[str, int]) -> DataFrame:
    """``box`` on a table partitioned by chunk columns (c + axis), which prunes partitions first."""
    for k, (lo, hi) in bounds.items():
        df = df.where(F.col(f"c{k}").between(lo // chunk[k], (hi - 1) // chunk[k]))
    return box(df, bounds)


def depth_crop(df: DataFrame, depth: int, axis: str = "z") -> DataFrame:
    return df.where(F.col(axis) < depth)


def transposed(df: DataFrame, axes: Mapping[str, str]) -> DataFrame:
    """Rename axes: ``{"y": "x", "x": "y"}`` swaps two."""
    return df.select(*(F.col(c).alias(axes.get(c, c)) for c in df.columns))


def shifted(df: DataFrame, by: Mapping[str, int | Column]) -> DataFrame:
    return df.withColumns({k: F.col(k) + (F.lit(n) if isinstance(n, int) else n) for k, n in by.items()})


def with_axes(df: DataFrame, axes: Sequence[str]) -> DataFrame:
    """Axes that ``df`` lacks, with one place each: a scalar or a vector as an array of more axes."""
    return df.withColumns({k: F.lit(0).cast("long") for k in axes if k not in df.columns})


def coordinates(spark: SparkSession, extents: Mapping[str, int]) -> DataFrame:
    """Every coordinate of a box, in C order; made where it is used, not on the driver."""
    out = spark.range(math.prod(extents.values()))
    rest = F.col("id")
    columns = {}
    for k, n in reversed(extents.items()):
        columns[k] = F.pmod(rest, F.lit(n))
        rest = floor_div(rest, n)
    return out.select(*(columns[k].alias(k) for k in extents))


def densify(df: DataFrame, extents: Mapping[str, int], fill: int | float = 0, v: str = "v") -> DataFrame:
    """Every voxel of the box; the absent ones are ``fill``. One shuffle of both sides, by coordinate."""
    grid = coordinates(df.sparkSession, extents)
    return grid.join(df.select(*extents, v), list(extents), "left").withColumn(v, F.coalesce(v, F.lit(fill).cast(df.schema[v].dataType)))


def with_chunks(df: DataFrame, chunk: Mapping[str, int]) -> DataFrame:
    return df.withColumns({f"c{k}": floor_div(k, n) for k, n in chunk.items()})


def chunk_stats(df: DataFrame, chunk: Mapping[str, int], v: str = "v") -> DataFrame:
    """Count, sum, least and greatest value of each chunk that has voxels."""
    return with_chunks(df, chunk).groupBy(*(f"c{k}" for k in chunk)).agg(
        F.count(v).alias("n"), F.sum(v).alias("total"), F.min(v).alias("least"), F.max(v).alias("greatest")
    )


def chunk_grid(spark: SparkSession, shape: Mapping[str, int], chunk: Mapping[str, int]) -> DataFrame:
    """All chunks of a volume in C order: index, start and stop on every axis; edges are clipped."""
    counts = {f"c{k}": -(-n // chunk[k]) for k, n in shape.items()}
    out = coordinates(spark, counts)
    for k, n in shape.items():
        first = F.col(f"c{k}") * chunk[k]
        out = out.withColumn(f"{k}_start", first).withColumn(f"{k}_stop", F.least(first + chunk[k], F.lit(n).cast("long")))
    return out


def chunk_counts(df: DataFrame, sizes: Sequence[str], chunk: int) -> list[Column]:
    """Chunks along each size column."""
    return [ceil_div(c, chunk).alias(f"n_{c}") for c in sizes]


def pack(df: DataFrame, shape: Sequence[int], chunk: Sequence[int], dtype: str, axes: Sequence[str] = AXES, v: str = "v", fill: float = 0) -> DataFrame:
    """Blocks of voxels, one per chunk with any voxel; absent ones are ``fill``. A task holds one chunk at a time."""
    keys = [f"c{k}" for k in axes]

    def build(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        at = [k.as_py() for k in key]
        origin = [a * c for a, c in zip(at, chunk, strict=True)]
        size = [min(c, s - o) for c, s, o in zip(chunk, shape, origin, strict=True)]
        out = np.full(size, fill, dtype)
        out[tuple(rows.column(k).to_numpy() - o for k, o in zip(axes, origin, strict=True))] = rows.column(v).to_numpy()
        return block_table([(origin, out)])

    return with_chunks(df, dict(zip(axes, chunk, strict=True))).select(*keys, *axes, v).groupBy(*keys).applyInArrow(build, BLOCKS)


def block_table(blocks: Sequence[tuple[Sequence[int], np.ndarray]]) -> pa.Table:
    return pa.table({
        "origin": pa.array([list(map(int, o)) for o, _ in blocks], pa.list_(pa.int64())),
        "shape": pa.array([list(a.shape) for _, a in blocks], pa.list_(pa.int32())),
        "dtype": pa.array([a.dtype.name for _, a in blocks], pa.string()),
        "data": pa.array([np.ascontiguousarray(a).tobytes() for _, a in blocks], pa.binary()),
    })


def arrays(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple[list[int], np.ndarray]]:
    """Origin and array of every block of a batch."""
    for o, s, d, b in zip(*(batch.column(c) for c in ("origin", "shape", "dtype", "data")), strict=True):
        yield o.as_py(), np.frombuffer(b.as_buffer(), np.dtype(d.as_py())).reshape(s.as_py())


def unpack(blocks: DataFrame, dtype: str, axes: Sequence[str] = AXES, v: str = "v", sparse: bool = False, absent: float | None = None) -> DataFrame:
    """Voxels of blocks; with ``sparse`` without the zeros, and without those that are ``absent``."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for origin, a in arrays(batch):
                yield from voxel_batches([np.arange(o, o + n) for o, n in zip(origin, a.shape, strict=True)], a, dtype, axes, v, sparse, absent=absent)

    return blocks.mapInArrow(explode, voxel_schema(dtype, axes, v))


def voxel_schema(dtype: str, axes: Sequence[str] = AXES, v: str = "v") -> str:
    return ", ".join(f"{k} long" for k in axes) + f", {v} {SPARK_TYPE[dtype]}"


def voxel_batches(places: Sequence[np.ndarray], a: np.ndarray, dtype: str, axes: Sequence[str] = AXES, v: str = "v", sparse: bool = False, most: int = 1 << 19, absent: float | None = None) -> Iterator[pa.RecordBatch]:
    """Rows of an array whose elements lie at ``places`` on each axis, about ``most`` of them in a batch."""
    step = max(1, most // max(1, math.prod(a.shape[1:])))
    for k in range(0, len(a) if a.ndim else 1, step):
        b, here = (a[k : k + step], [places[0][k : k + step], *places[1:]]) if a.ndim else (a, [])
        wanted = [*([b != 0] if sparse else []), *([b != absent] if absent is not None else [])]
        at = np.nonzero(np.logical_and.reduce(wanted)) if wanted else np.unravel_index(np.arange(b.size), b.shape)
        values = pa.array(np.atleast_1d(b[at])).cast(ARROW_TYPE[dtype])
        yield pa.RecordBatch.from_arrays([*(pa.array(x.astype(np.int64)[i]) for i, x in zip(at, here, strict=True)), values], [*axes, v])


ARROW_TYPE = {
    "uint8": pa.int16(), "uint16": pa.int32(), "uint32": pa.int64(), "uint64": pa.decimal128(20, 0), "int8": pa.int8(), "int16": pa.int16(),
    "int32": pa.int32(), "int64": pa.int64(), "float32": pa.float32(), "float64": pa.float64(),
}
