"""Stored arrays compared by digests of their chunks, whole groups by trees of digests.

A digest stands for the values of a box, however they are encoded, so arrays of different chunks, shards and codecs can be
compared on one grid. Eight neighbours make a node of the next level, up to one digest for a group. Two trees are compared from
the top, below nodes that differ only, and voxels are read only from boxes that differ. Trees are tables and may be kept: a
group is compared with what it was, or with a copy elsewhere, without reading either's voxels."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelmill.functions.arithmetic import SPARK_TYPE, floor_div
from voxelmill.operators.grid import ARROW_TYPE
from voxelmill.sources.blocks import Bounds
from voxelmill.sources.shared import written
from voxelmill.sources.zarr import children, detect, opened

#: Neighbours that make a node, and boxes that a task takes at a time.
FAN, STEP = 8, 64
TREE = "array string, level int, node long, digest string"


def arrays_in(path: str, name: str = "") -> list[str]:
    """Names of all arrays in a group; an array is its own, with an empty name."""
    found = detect(f"{path}/{name}" if name else path)
    if found is None:
        raise ValueError(f"no Zarr node: {path}")
    if found[1] == "array":
        return [name]
    return [x for n in children(f"{path}/{name}" if name else path) for x in arrays_in(path, f"{name}/{n}" if name else n)]


def _at(path: str, name: str) -> str:
    return f"{path}/{name}" if name else path


def _box(node: int, shape: Sequence[int], cell: Sequence[int]) -> Bounds:
    index = np.unravel_index(node, [-(-n // c) for n, c in zip(shape, cell, strict=True)])
    return [(int(i) * c, min(int(i) * c + c, n)) for i, c, n in zip(index, cell, shape, strict=True)]


def digest(a: np.ndarray) -> str:
    kind = f"{a.dtype.newbyteorder('<').str}{a.shape}".encode()
    return hashlib.blake2b(kind + np.ascontiguousarray(a, a.dtype.newbyteorder("<")).tobytes(), digest_size=16).hexdigest()


def _cell(path: str, name: str, cell: Sequence[int] | None) -> list[int]:
    a = opened(_at(path, name))
    return list(cell or a.inner or a.chunk)


def leaves(spark: SparkSession, path: str, names: Sequence[str], cell: Sequence[int] | None = None) -> DataFrame:
    """(array, level 0, node, digest) of every box of a grid: each array's own chunks, or ``cell``."""
    counts = []
    for n in names:
        shape = opened(_at(path, n)).shape
        counts.append((n, math.prod(-(-s // c) for s, c in zip(shape, _cell(path, n, cell), strict=True))))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, first, last in zip(*(batch.column(c).to_pylist() for c in ("array", "first", "last")), strict=True):
                a, grid = opened(_at(path, name)), _cell(path, name, cell)
                found = [digest(a.read(_box(k, a.shape, grid))) for k in range(first, last)]
                n = len(found)
                yield pa.RecordBatch.from_arrays([pa.array([name] * n, pa.string()), pa.array([0] * n, pa.int32()), pa.array(range(first, last), pa.int64()), pa.array(found, pa.string())], ["array", "level", "node", "digest"])

    spans = spark.createDataFrame(counts, "array string, n long").where("n > 0").select("array", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(STEP).cast("long"))).alias("first"))
    spans = spans.select("array", "first", F.least(F.col("first") + STEP, "n").alias("last"))
    return spans.repartition(4 * spark.sparkContext.defaultParallelism).mapInArrow(look, TREE)


def tree(spark: SparkSession, path: str, cell: Sequence[int] | None = None) -> DataFrame:
    """All levels of digests, a written table (array, level, node, digest): level 0 are boxes, and each array has one node at the top."""
    names = arrays_in(path)
    level = written(leaves(spark, path, names, cell))
    most, out, k = level.agg(F.max("node")).first()[0] or 0, level, 0
    while most:
        most, k = most // FAN, k + 1
        below = F.sort_array(F.collect_list(F.struct("node", "digest")))
        level = written(level.groupBy("array", floor_div("node", FAN).alias("up")).agg(F.sha2(F.array_join(F.transform(below, lambda x: x["digest"]), ","), 256).alias("digest")).select("array", F.lit(k).alias("level"), F.col("up").alias("node"), "digest"))
        out = out.unionByName(level)
    return written(out)


def root(digests: DataFrame) -> str:
    """One digest of all arrays and their names."""
    top = digests.join(digests.agg(F.max("level").alias("level")), "level")
    return top.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "array", "digest"))), ","), 256)).first()[0]


def differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """(array, node) of the boxes that differ, or that one tree lacks. Both trees must be of one grid."""
    top = max(t.agg(F.max("level")).first()[0] or 0 for t in (a, b))
    found = None
    for level in range(top, -1, -1):
        left, right = (t.where(F.col("level") == level).select("array", "node", F.col("digest").alias(n)) for t, n in ((a, "left"), (b, "right")))
        if found is not None:
            above = found.select("array", F.col("node").alias("up"))
            left, right = (t.withColumn("up", floor_div("node", FAN)).join(above, ["array", "up"], "left_semi").drop("up") for t in (left, right))
        found = left.join(right, ["array", "node"], "full_outer").where(~F.col("left").eqNullSafe(F.col("right"))).select("array", "node")
    return found


def voxels_of(cells: DataFrame, a: str, b: str, axes: Sequence[str], cell: Sequence[int] | None = None) -> DataFrame:
    """(array, axes, left, right) of the voxels that differ in boxes (array, node) of the groups or arrays ``a`` and ``b``, which
    have the same shapes and types. Nothing else is read. The grid is that of ``a``, or ``cell``."""
    names = arrays_in(a)
    for n in names:
        x, y = opened(_at(a, n)), opened(_at(b, n))
        if x.shape != y.shape or x.dtype.newbyteorder("=") != y.dtype.newbyteorder("="):
            raise ValueError(f"arrays of different shapes or types: {n or a}")
    dtype = opened(_at(a, names[0])).dtype.newbyteorder("=").name if names else "int32"

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, node in zip(batch.column("array").to_pylist(), batch.column("node").to_pylist(), strict=True):
                x, y = opened(_at(a, name)), opened(_at(b, name))
                box = _box(node, x.shape, _cell(a, name, cell))
                p, q = x.read(box), y.read(box)
                at = np.nonzero((p != q) & ~((p != p) & (q != q)))
                places = [pa.array(i.astype(np.int64) + lo) for i, (lo, _) in zip(at, box, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(at[0]), pa.string()), *places, *(pa.array(v[at]).cast(ARROW_TYPE[dtype]) for v in (p, q))], ["array", *axes, "left", "right"])

    kinds = ", ".join(f"{k} long" for k in axes)
    return cells.mapInArrow(look, f"array string, {kinds}, left {SPARK_TYPE[dtype]}, right {SPARK_TYPE[dtype]}")


def stored_diff(spark: SparkSession, a: str, b: str, axes: Sequence[str]) -> DataFrame:
    """The voxels in which two stored arrays differ: (axes, left, right). Chunks of ``b`` are digested on the grid of ``a``."""
    grid = _cell(a, "", None)
    return voxels_of(differing(tree(spark, a, grid), tree(spark, b, grid)), a, b, axes, grid).drop("array")
