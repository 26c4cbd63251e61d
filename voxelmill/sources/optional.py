"""JPEG 2000, whose decoder is a separate package (glymur)."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from typing import Any

import numpy as np

from voxelmill.sources.blocks import BlockSource, Format, Info, Part


def level_shape(shape: tuple[int, ...], level: int) -> tuple[int, ...]:
    """Height and width at a wavelet level; channels stay."""
    return (-(-shape[0] // 2**level), -(-shape[1] // 2**level), *shape[2:])


def level_area(rows: tuple[int, int], columns: tuple[int, int], level: int, shape: tuple[int, ...]) -> tuple[int, int, int, int]:
    """A level's box in full-resolution coordinates, within the image."""
    up = lambda x, n: min(x << level, n)
    return up(rows[0], shape[0]), up(columns[0], shape[1]), up(rows[1], shape[0]), up(columns[1], shape[1])


def pixel_size(xmp: bytes | None) -> tuple[float, float]:
    """Width and height of a pixel in an XMP packet; (1, 1) if it doesn't say."""
    try:
        root = ET.fromstring(xmp or b"")
        found = {e.tag.rpartition("}")[2]: e.text for e in root.iter()} | {k.rpartition("}")[2]: v for e in root.iter() for k, v in e.attrib.items()}
        return float(found["PixelWidth"] or ""), float(found["PixelHeight"] or "")
    except (ET.ParseError, KeyError, ValueError):
        return 1.0, 1.0


class Jp2Format(Format):
    """Axes: (channel,) row, column. Options: ``level``, the wavelet level; ``maxLoad``."""

    def _image(self) -> Any:
        import glymur

        return glymur.Jp2k(self.path)

    def info(self) -> Info:
        image, level = self._image(), int(self.options.get("level", 0))
        shape = level_shape(image.shape, level)
        size = next((pixel_size(getattr(b, "raw_data", None)) for b in image.box if getattr(b, "box_id", "") == "uuid"), (1.0, 1.0))
        return Info((*shape[2:], *shape[:2]), image.dtype.name, {"full": image.shape, "level": level, "levels": image.codestream.segment[2].num_res, "pixel": size})

    def parts(self, info: Info) -> list[Part]:
        step, lead = int(self.options.get("maxLoad", 1024)), info.shape[:-2]
        h, w = info.shape[-2:]
        return [Part((*[0] * len(lead), i, j), (*lead, min(step, h - i), min(step, w - j))) for i in range(0, h, step) for j in range(0, w, step)]

    def load(self, info: Info, part: Part) -> np.ndarray:
        (i, j), (h, w) = part.origin[-2:], part.shape[-2:]
        a = self._image().read(rlevel=info.extra["level"], area=level_area((i, i + h), (j, j + w), info.extra["level"], info.extra["full"]))
        return a.transpose(2, 0, 1) if a.ndim == 3 else a


class Jp2Source(BlockSource):
    kind, short = Jp2Format, "jp2"
