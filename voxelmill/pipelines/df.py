"""Dark-field images with their own wavelet levels: levels are copied, not computed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from voxelmill.functions.arithmetic import floor_div
from voxelmill.pipelines.common import Written, given, inspected, placed, write_metadata
from voxelmill.plans.config import ArrayOptions, GeneralOptions, HeaderOptions, autoconfig, default_output
from voxelmill.plans.layout import layout
from voxelmill.sinks import zarr as sink
from voxelmill.sinks.extras import write_json
from voxelmill.sources.blocks import source
from voxelmill.sources.shared import written


def _levels(path: str, fmt: str) -> tuple[int, tuple[float, float]]:
    """How many levels an image has, and its pixels' width and height."""
    if fmt == "zarr":
        from voxelmill.sources.zarr import level_count

        return level_count(path), (1.0, 1.0)
    extra = source(fmt).kind(path, {}).info().extra
    return extra["levels"] + 1, extra["pixel"]


def _copied(spark: SparkSession, inp: Sequence[str], levels: int, fmt: str, path: str, general: GeneralOptions, array: ArrayOptions, stack: bool) -> tuple[list[list[int]], str]:
    """Every level of every image, in the middle of the largest; written level by level."""
    shapes, kind = [], ""
    for level in range(levels):
        options = {"level": str(level), "maxLoad": str(general.max_load)}
        found = written(inspected(given(spark, inp), fmt, lambda _, options=options: options))
        h, w = F.element_at("size", -2), F.element_at("size", -1)
        head = found.agg(F.max(h).alias("h"), F.max(w).alias("w"), F.max_by("dtype", "no").alias("dtype"), F.min(F.when(F.size("size") == 3, F.col("size")[0]).otherwise(0)).alias("channels")).first()
        most, kind, channels = [head["h"], head["w"]], head["dtype"], head["channels"]
        lead = ([channels] if channels else []) + ([len(inp)] if stack else [])
        long = lambda x: F.lit(x).cast("long")
        front = ([long(0)] if channels else []) + ([F.col("no")] if stack else [])
        places = found.select(
            "path", F.lit(fmt).alias("format"), "options", F.array(*front, floor_div(long(most[0]) - h, 2), floor_div(long(most[1]) - w, 2)).alias("start"),
            F.array(*[long(0)] * (len(front) + 2)).alias("lo"), F.array(*([long(channels)] if channels else []), *([long(1)] if stack else []), h, w).alias("hi"), F.lit(len(front) - 1 if stack else None).cast("int").alias("insert"),
        )
        shape = [*lead, *most]
        o = array if len(array.chunk) != 1 else ArrayOptions(**(vars(array) | {"chunk": (*([channels] if channels else []), *([1] if stack else []), array.chunk[0], array.chunk[0])}))
        chunk, shard = layout(shape, 1, o) if len(shape) > 1 else (shape, None)
        chunk = [min(c, s) for c, s in zip(chunk, shape, strict=True)] if shard is None else chunk
        sink.write_array(f"{path}/{level}", placed(places, kind), shape, chunk, shard, kind, o)
        shapes.append(shape)
    return shapes, kind


@autoconfig
def single_slice(spark: SparkSession, inp: str, *, thickness: float | None = None, fmt: str = "jp2", general: GeneralOptions, array: ArrayOptions, header: HeaderOptions) -> Written:
    """One image: (channel,) row, column. ``fmt`` may name any format that has levels."""
    path = general.out or default_output(inp, header)
    sink.create_group(path, array)
    levels, (width, height) = _levels(inp, fmt)
    shapes, kind = _copied(spark, [inp], levels, fmt, path, general, array, stack=False)
    axes = "cyx" if len(shapes[0]) == 3 else "yx"
    write_metadata(path, axes, shapes, kind, array, header, (width, height, thickness or 1.0), "um", kind="jpeg2000", align=2)
    return Written(path, shapes, shapes[-1], None)


@autoconfig
def multi_slice(spark: SparkSession, inp: Sequence[str], *, thickness: float | None = None, fmt: str = "jp2", general: GeneralOptions, array: ArrayOptions, header: HeaderOptions) -> Written:
    """Images of different sizes: (channel,) slice, row, column; slices aren't pooled. Writes a sidecar."""
    path = general.out or default_output(inp[0], header)
    sink.create_group(path, array)
    found = [_levels(p, fmt) for p in inp]
    levels, (width, height) = min(n for n, _ in found), found[-1][1]
    shapes, kind = _copied(spark, list(inp), levels, fmt, path, general, array, stack=True)
    axes = "czyx" if len(shapes[0]) == 4 else "zyx"
    write_metadata(path, axes, shapes, kind, array, header, (width, height, thickness or 1.0), "um", skip=[axes.index("z")], kind="jpeg2000", align=2)
    doc = {"PixelSize": [width, height], "PixelSizeUnits": "um", "SliceThickness": thickness, "SliceThicknessUnits": "um", "SampleStaining": "LY"}
    write_json(path.rstrip("/").removesuffix(".zarr") + ".json", doc)
    return Written(path, shapes, shapes[-1], None)
