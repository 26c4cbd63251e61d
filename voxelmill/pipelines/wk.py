"""Annotation masks on top of a multi-scale image: the parts of each slice that hold labels."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from voxelmill.operators import labels
from voxelmill.pipelines.common import Written
from voxelmill.plans.config import ArrayOptions, GeneralOptions, autoconfig
from voxelmill.sinks import zarr as sink
from voxelmill.sources.blocks import opened
from voxelmill.sources.zarr import attributes, level_count
from voxelmill.sources.zarr import opened as zarr_array


def mask_name(level: int) -> str:
    return "1" if level == 0 else f"{1 << level}-{1 << level}-1"


@autoconfig
def webknossos(spark: SparkSession, wkw_dir: str, ome_dir: str, dic: str | None = None, *, fmt: str = "wkw", general: GeneralOptions, array: ArrayOptions) -> Written:
    """For every level of the image: the mask within each slice's content box, found at the coarsest level,
    with labels renamed by ``dic`` (a JSON object). Masks lie in folders 1, 2-2-1, 4-4-1, ..."""
    path = general.out or wkw_dir.rstrip("/") + ".ome.zarr"
    mapping = {int(k): int(v) for k, v in (json.loads(dic) if dic else {}).items()}
    count = level_count(ome_dir)
    sink.create_group(path, array)
    shapes = [list(zarr_array(f"{ome_dir}/{level}").shape[-3:]) for level in range(count)]

    def mask(level: int) -> tuple[DataFrame, str]:
        z, y, x = shapes[level]
        blocks, info = opened(spark, fmt, f"{wkw_dir}/{mask_name(level)}", shape=f"{x},{y},{z}", maxLoad=general.max_load)
        if list(info.shape) != shapes[level]:
            raise ValueError(f"mask {mask_name(level)} has shape {info.shape}, the image {shapes[level]}")
        return blocks, info.dtype

    _, h, w = shapes[-1]
    boxes = labels.block_borders(mask(count - 1)[0], h, w)
    for level in range(count):
        blocks, kind = mask(level)
        _, h, w = shapes[level]
        chunk = [min(c, s) for c, s in zip(zarr_array(f"{ome_dir}/{level}").chunk[-3:], shapes[level], strict=True)]
        sink.write_array(f"{path}/{level}", labels.clipped_blocks(blocks, boxes, 2 ** (count - level - 1), h, w, mapping), shapes[level], chunk, None, kind, array)
    copied = attributes(ome_dir)
    sink.update_attributes(path, {k: copied[k] for k in ("multiscales", "ome") if k in copied})
    return Written(path, shapes, chunk, None)
