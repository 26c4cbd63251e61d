"""Multi-resolution levels by windowed reduction, and projections.

A window takes two voxels on every pooled axis; what is left over at the end of an odd axis is dropped,
an axis of length one isn't pooled. Values are cast back to the array's type, so fractions are cut off
level by level, and each level is made from the one before it. NaN is no value; absent voxels are zero, unless
blocks hold a number that stands for them: windows leave it out, and are absent themselves if they hold nothing else.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelmill.functions.arithmetic import floor_div
from voxelmill.operators.grid import BLOCKS, arrays, block_table

Reducer = str | Callable[[Column], Column]
NUMPY = {"mean": np.nanmean, "median": np.nanmedian, "max": np.nanmax, "min": np.nanmin}


def factors(shape: Mapping[str, int], skip: Sequence[str] = ()) -> dict[str, int]:
    return {k: 1 if k in skip or n == 1 else 2 for k, n in shape.items()}


def next_shape(shape: Mapping[str, int], skip: Sequence[str] = ()) -> dict[str, int]:
    return {k: n if k in skip else max(1, n // 2) for k, n in shape.items()}


def _number(v: str, kind: str) -> Column:
    return F.when(~F.isnan(v), F.col(v)) if kind in ("double", "float") else F.col(v)


def coarsened(df: DataFrame, shape: Mapping[str, int], mode: Reducer = "mean", skip: Sequence[str] = (), dense: bool = False, v: str = "v") -> DataFrame:
    """The next level in voxel form; other integer columns of ``df`` (time, channel) stay axes.

    Unless ``dense``, absent voxels count as zeros: each window knows how many voxels it should have, so
    nothing need be filled in before. A callable gets the value column and returns an aggregate; it
    sees the present voxels only."""
    f = factors(shape, skip)
    kind = df.schema[v].dataType.simpleString()
    others = [c for c in df.columns if c not in (*shape, v)]
    inside = df
    for k, n in shape.items():
        if f[k] == 2 and n % 2:
            inside = inside.where(F.col(k) < n // 2 * 2)
    cells = inside.withColumns({k: floor_div(k, 2) for k in shape if f[k] == 2})
    x, full = _number(v, kind), math.prod(f.values())
    absent = F.lit(0) if dense else F.lit(full) - F.count(F.lit(1))
    if mode == "mean":
        value = F.sum(x) / (F.count(x) + absent)
    elif mode == "median":
        value = F.median(x) if dense else _median(F.concat(F.collect_list(x.cast("double")), F.array_repeat(F.lit(0.0), absent.cast("int"))))
    elif mode in ("max", "min"):
        own = F.max(x) if mode == "max" else F.min(x)
        pick = F.greatest if mode == "max" else F.least
        value = F.when(absent > 0, pick(own, F.lit(0).cast(kind))).otherwise(own)
    elif callable(mode):
        value = mode(x)
    else:
        raise ValueError(f"no such reduction: {mode}")
    if kind in ("double", "float"):
        value = F.coalesce(value, F.lit(float("nan")))
    return cells.groupBy(*others, *shape).agg(value.cast(kind).alias(v))


def _median(values: Column) -> Column:
    """Of a window's values, eight at most."""
    s = F.array_sort(values)
    n = F.size(s)
    low, high = F.element_at(s, floor_div(n + 1, 2).cast("int")), F.element_at(s, (floor_div(n, 2) + 1).cast("int"))
    return F.when(n > 0, (low + high) / 2)


def levels(df: DataFrame, shape: Mapping[str, int], count: int, mode: Reducer = "mean", skip: Sequence[str] = (), dense: bool = False, v: str = "v") -> Iterator[tuple[int, dict[str, int], DataFrame]]:
    """Level number, shape and voxels of levels 0 to ``count``, each made from the one before."""
    shape = dict(shape)
    yield 0, shape, df
    for level in range(1, count + 1):
        df, shape = coarsened(df, shape, mode, skip, dense, v), next_shape(shape, skip)
        yield level, shape, df


def projected(df: DataFrame, axis: str, v: str = "v") -> DataFrame:
    """Maximum-intensity projection along an axis, NaN left out."""
    kind = df.schema[v].dataType.simpleString()
    return df.groupBy(*(c for c in df.columns if c not in (axis, v))).agg(F.max(_number(v, kind)).alias(v))


# ---------------------------------------------------------------- block form


def reduce_array(a: np.ndarray, f: Sequence[int], mode: str | Callable[..., np.ndarray], absent: float | None = None) -> np.ndarray:
    """One block's windows; its leftover at odd ends is dropped, and so are voxels that are ``absent``."""
    a = a[tuple(slice(0, n // k * k) for n, k in zip(a.shape, f, strict=True))]
    split = a.reshape([m for n, k in zip(a.shape, f, strict=True) for m in (n // k, k)])
    function = NUMPY[mode] if isinstance(mode, str) else mode
    if absent is not None and (a == absent).any():
        return _reduce_present(split, mode, function, absent)
    if a.dtype.kind in "iu" and a.itemsize < 8 and mode == "mean":
        # exact in integers, cut off towards zero as the cast from a float would
        total = split.sum(tuple(range(1, split.ndim, 2)), dtype=np.int64)
        n = math.prod(f)
        return (np.sign(total) * (np.abs(total) // n)).astype(a.dtype)
    return function(split, axis=tuple(range(1, split.ndim, 2))).astype(a.dtype)


def _reduce_present(split: np.ndarray, mode: str | Callable[..., np.ndarray], function: Callable[..., np.ndarray], absent: float) -> np.ndarray:
    """Windows of the voxels that are there. Functions get numbers with NaN for the others."""
    over, there, whole = tuple(range(1, split.ndim, 2)), split != absent, split.dtype.kind in "iu"
    n = there.sum(over)
    if whole and split.itemsize < 8 and mode == "mean":
        total = np.where(there, split, 0).sum(over, dtype=np.int64)
        out = np.sign(total) * (np.abs(total) // np.maximum(n, 1))
    elif whole and mode in ("max", "min"):
        limits = np.iinfo(split.dtype)
        out = function(np.where(there, split, split.dtype.type(limits.min if mode == "max" else limits.max)), axis=over)
    else:
        # windows without any voxel get one, so that no function sees an empty window
        out = function(np.where(there, split, np.where(np.expand_dims(n, over) > 0, np.nan, 0.0)), axis=over)
    return np.where(n > 0, out, absent).astype(split.dtype)


def cut_pieces(batches: Iterator[pa.RecordBatch], shape: Sequence[int], chunk: Sequence[int]) -> Iterator[tuple[list[list[int]], list[tuple[list[int], np.ndarray]]]]:
    """Of every block, the grid indices and pieces (origin, array) that its chunks make of it."""
    for batch in batches:
        for origin, a in arrays(batch):
            spans = [range(o // c, -(-min(o + n, s) // c)) for o, n, s, c in zip(origin, a.shape, shape, chunk, strict=True)]
            if not all(spans):
                continue
            at, pieces = [], []
            for cell in np.ndindex(*(len(s) for s in spans)):
                index = [s[i] for s, i in zip(spans, cell, strict=True)]
                lo = [max(o, i * c) for o, i, c in zip(origin, index, chunk, strict=True)]
                hi = [min(o + n, (i + 1) * c, s) for o, n, i, c, s in zip(origin, a.shape, index, chunk, shape, strict=True)]
                at.append(index)
                pieces.append((lo, a[tuple(slice(x - o, y - o) for x, y, o in zip(lo, hi, origin, strict=True))]))
            yield at, pieces


def rechunked(blocks: DataFrame, shape: Sequence[int], chunk: Sequence[int], dtype: str, fill: float = 0) -> DataFrame:
    """Any boxes to whole chunks of a grid, in one shuffle. Pieces are cut where they are read; a chunk is
    put together in one task, ``fill`` where nothing is, later origins over earlier ones."""
    ndim = len(shape)
    keys = [f"k{i}" for i in range(ndim)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, pieces in cut_pieces(batches, shape, chunk):
            t = block_table(pieces)
            t = pa.table([*(pa.array([i[d] for i in at], pa.int64()) for d in range(ndim)), *t.columns], [*keys, *t.schema.names])
            yield from t.to_batches()

    def build(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        origin = [k.as_py() * c for k, c in zip(key, chunk, strict=True)]
        out = np.full([min(c, s - o) for c, s, o in zip(chunk, shape, origin, strict=True)], fill, dtype)
        for lo, a in sorted(arrays(rows), key=lambda x: x[0]):
            out[tuple(slice(x - o, x - o + n) for x, o, n in zip(lo, origin, a.shape, strict=True))] = a
        return block_table([(origin, out)])

    pieces = blocks.select("origin", "shape", "dtype", "data").mapInArrow(cut, ", ".join(f"{k} long" for k in keys) + f", {BLOCKS}")
    return pieces.groupBy(*keys).applyInArrow(build, BLOCKS)


def coarsened_blocks(chunks: DataFrame, shape: Sequence[int], chunk: Sequence[int], dtype: str, pooled: Sequence[bool], mode: str | Callable[..., np.ndarray] = "mean", whole: bool = True, absent: float | None = None) -> tuple[DataFrame, list[int]]:
    """The next level of boxes of whole chunks with even sizes on pooled axes: windows never cross chunks, so
    they are reduced where they lie, and only an eighth of the data is shuffled into the new chunks. Without
    ``whole`` the reduced boxes stay as they are, and nothing is shuffled."""
    f = [2 if p and n > 1 else 1 for p, n in zip(pooled, shape, strict=True)]
    if any(k == 2 and c % 2 and c < n for k, c, n in zip(f, chunk, shape, strict=True)):
        raise ValueError("pooled axes need chunks of even size")
    new = [max(1, n // 2) if p else n for p, n in zip(pooled, shape, strict=True)]

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for origin, a in arrays(batch):
                b = reduce_array(a, f, mode, absent)
                if b.size:
                    yield from block_table([([o // k for o, k in zip(origin, f, strict=True)], b)]).to_batches()

    small = chunks.mapInArrow(shrink, BLOCKS)
    return rechunked(small, new, chunk, dtype, absent or 0) if whole else small, new
