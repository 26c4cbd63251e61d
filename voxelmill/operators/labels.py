"""Annotation masks: content boxes per slice, their place at other levels, label maps, histograms."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelmill.operators.grid import BLOCKS, arrays, block_table

BORDERS = ("top", "bottom", "left", "right")
#: Larger label maps are joined instead of being part of the plan.
IN_PLAN = 4096


def borders(mask: DataFrame, height: int, width: int, slice_axis: str = "z", v: str = "v") -> DataFrame:
    """Distance of each slice's content (v > 0) to its four borders, less a margin of one, at least 0; -1
    where a slice is empty. One pass of minima and maxima, combined before the shuffle."""
    on = lambda c: F.when(F.col(v) > 0, F.col(c))
    raw = {"top": F.min(on("y")), "bottom": F.lit(height - 1) - F.max(on("y")), "left": F.min(on("x")), "right": F.lit(width - 1) - F.max(on("x"))}
    return mask.groupBy(slice_axis).agg(*(F.when(c.isNull(), -1).otherwise(F.greatest(c - 1, F.lit(0))).cast("long").alias(k) for k, c in raw.items()))


def scaled(boxes: DataFrame, levels: int, level: int) -> DataFrame:
    """Borders found at the coarsest of ``levels`` levels, at a finer one; empty slices stay -1."""
    factor = 2 ** (levels - level - 1)
    return boxes.withColumns({k: F.when(F.col(k) < 0, F.col(k)).otherwise(F.col(k) * factor) for k in BORDERS})


def inside(voxels: DataFrame, boxes: DataFrame, height: int, width: int, slice_axis: str = "z") -> DataFrame:
    """Voxels within their slice's borders. Boxes are one row per slice; Spark broadcasts them if small."""
    met = voxels.join(boxes, slice_axis)
    ok = (F.col("top") >= 0) & F.col("y").between(F.col("top"), height - 1 - F.col("bottom")) & F.col("x").between(F.col("left"), width - 1 - F.col("right"))
    return met.where(ok).drop(*BORDERS)


def remapped(voxels: DataFrame, mapping: Mapping[int, int], strict: bool = True, v: str = "v") -> DataFrame:
    """New labels by a map; a label that isn't in it is an error, or else stays. An empty map changes nothing."""
    if not mapping:
        return voxels
    kind = voxels.schema[v].dataType
    if len(mapping) > IN_PLAN:
        table = voxels.sparkSession.createDataFrame([(int(a), int(b)) for a, b in mapping.items()], "_old long, _new long")
        met = voxels.join(table, F.col(v).cast("long") == F.col("_old"), "left")
        missing: Column = F.raise_error(F.concat(F.lit("no new label for "), F.col(v).cast("string"))).cast("long") if strict else F.col(v).cast("long")
        return met.withColumn(v, F.coalesce("_new", missing).cast(kind)).drop("_old", "_new")
    table = F.create_map(*(F.lit(x).cast("long") for pair in mapping.items() for x in pair))
    new = F.try_element_at(table, F.col(v).cast("long"))
    other: Column = F.raise_error(F.concat(F.lit("no new label for "), F.col(v).cast("string"))).cast("long") if strict else F.col(v).cast("long")
    return voxels.withColumn(v, F.coalesce(new, other).cast(kind))


def histogram(voxels: DataFrame, by: tuple[str, ...] = (), v: str = "v") -> DataFrame:
    return voxels.groupBy(*by, v).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- block form


def block_extents(blocks: DataFrame) -> DataFrame:
    """z, y0, y1, x0, x1: first and last row and column of each slice's content, of blocks with axes z, y, x.
    Slices without content have no row. Every block gives a row for a slice, merged before the shuffle."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, ...]] = []
            for (z, y, x), a in arrays(batch):
                rows, columns = (a > 0).any(2), (a > 0).any(1)
                for k in np.flatnonzero(rows.any(1)).tolist():
                    r, c = np.flatnonzero(rows[k]), np.flatnonzero(columns[k])
                    out.append((z + k, y + int(r[0]), y + int(r[-1]), x + int(c[0]), x + int(c[-1])))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in range(5)], ["z", "y0", "y1", "x0", "x1"])

    found = blocks.mapInArrow(look, "z long, y0 long, y1 long, x0 long, x1 long")
    return found.groupBy("z").agg(F.min("y0").alias("y0"), F.max("y1").alias("y1"), F.min("x0").alias("x0"), F.max("x1").alias("x1"))


def block_borders(blocks: DataFrame, height: int, width: int) -> dict[int, tuple[int, ...]]:
    """``borders`` of the slices with content: five numbers for each come to the driver."""
    return {r["z"]: tuple(max(n - 1, 0) for n in (r["y0"], height - 1 - r["y1"], r["x0"], width - 1 - r["x1"])) for r in block_extents(blocks).collect()}


def clipped_blocks(blocks: DataFrame, boxes: Mapping[int, tuple[int, ...]], factor: int, height: int, width: int, mapping: Mapping[int, int]) -> DataFrame:
    """Blocks with zeros outside their slices' borders (which are ``factor`` times those given), labels renamed
    by a map. Blocks without a label left are dropped; nothing is shuffled."""
    old = np.array(sorted(mapping), np.int64)
    new = np.array([mapping[k] for k in old.tolist()], np.int64)
    shared = blocks.sparkSession.sparkContext.broadcast(dict(boxes))

    def clip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for (z, y, x), a in arrays(batch):
                out = np.zeros_like(a)
                for k in range(a.shape[0]):
                    box = own.get(z + k)
                    if box is None:
                        continue
                    top, bottom, left, right = (n * factor for n in box)
                    s = (k, slice(max(top - y, 0), max(height - bottom - y, 0)), slice(max(left - x, 0), max(width - right - x, 0)))
                    out[s] = a[s]
                if len(old) and out.any():
                    some = out[out != 0].astype(np.int64)
                    at = np.minimum(np.searchsorted(old, some), len(old) - 1)
                    if (old[at] != some).any():
                        raise ValueError(f"no new label for {some[old[at] != some][0]}")
                    out[out != 0] = new[at].astype(a.dtype)
                if out.any():
                    yield from block_table([([z, y, x], out)]).to_batches()

    return blocks.mapInArrow(clip, BLOCKS)
