"""NIfTI-1 headers and images, plain, gzipped or stored beside a chunked volume."""

from __future__ import annotations

import gzip
import struct
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np

from voxelmill.functions.orientation import Matrix
from voxelmill.sources import files
from voxelmill.sources.blocks import BlockSource, Bounds, Format, Info, Part
from voxelmill.sources.zarr import opened

#: Fixed values of the format: data type codes, unit codes.
TYPES = {2: "uint8", 4: "int16", 8: "int32", 16: "float32", 64: "float64", 256: "int8", 512: "uint16", 768: "uint32", 1024: "int64", 1280: "uint64"}
UNITS = {"unknown": 0, "meter": 1, "mm": 2, "micron": 3, "sec": 8, "msec": 16, "usec": 24}
SIZE = 348


@dataclass
class Header:
    shape: tuple[int, ...] = (1, 1, 1)
    dtype: str = "uint8"
    zooms: tuple[float, ...] = (1.0, 1.0, 1.0)
    affine: Matrix = field(default_factory=lambda: np.eye(4).tolist())
    space_unit: str = "unknown"
    time_unit: str = "unknown"
    offset: int = SIZE + 4
    slope: float = 1.0
    inter: float = 0.0

    def packed(self) -> bytes:
        """The 348 bytes; sizes beyond the format's 16 bits are kept as -1, as large volumes do."""
        out = bytearray(SIZE)
        n = len(self.shape)
        dims = [n, *self.shape, *[1] * (7 - n)]
        struct.pack_into("<i", out, 0, SIZE)
        struct.pack_into("<8h", out, 40, *(d if d < 1 << 15 else -1 for d in dims))
        code = next(k for k, v in TYPES.items() if v == self.dtype)
        struct.pack_into("<hh", out, 70, code, np.dtype(self.dtype).itemsize * 8)
        m = np.array(self.affine, float)
        struct.pack_into("<8f", out, 76, 1.0, *(list(self.zooms) + [1.0] * 7)[:7])
        struct.pack_into("<fff", out, 108, float(self.offset), self.slope, self.inter)
        out[123] = UNITS[self.space_unit] | UNITS[self.time_unit]
        struct.pack_into("<hh", out, 252, 0, 1)
        struct.pack_into("<12f", out, 280, *m[:3].ravel())
        struct.pack_into("<4s", out, 344, b"n+1\0")
        return bytes(out)

    @classmethod
    def unpacked(cls, data: bytes) -> Header:
        order = "<" if struct.unpack_from("<i", data)[0] == SIZE else ">"
        if struct.unpack_from(f"{order}i", data)[0] != SIZE:
            raise ValueError("no NIfTI-1 header")
        dims = struct.unpack_from(f"{order}8h", data, 40)
        n = dims[0]
        code = struct.unpack_from(f"{order}h", data, 70)[0]
        zooms = struct.unpack_from(f"{order}8f", data, 76)
        offset, slope, inter = struct.unpack_from(f"{order}fff", data, 108)
        q, s = struct.unpack_from(f"{order}hh", data, 252)
        if s > 0:
            affine = [*np.array(struct.unpack_from(f"{order}12f", data, 280)).reshape(3, 4).tolist(), [0.0, 0.0, 0.0, 1.0]]
        else:
            affine = np.diag([*(zooms[1:4] if q == 0 else (zooms[1] * (zooms[0] or 1), *zooms[2:4])), 1.0]).tolist()
        unit = {v: k for k, v in UNITS.items()}
        return cls(tuple(dims[1 : n + 1]), TYPES[code], tuple(zooms[1 : n + 1]), affine, unit.get(data[123] & 7, "unknown"), unit.get(data[123] & 56, "unknown"), int(offset), slope, inter)


def _bytes(path: str) -> bytes:
    data = files.read(path)
    return gzip.decompress(data) if path.endswith(".gz") else data


def load_header(path: str) -> Header:
    """Of a .nii or .nii.gz file, of a chunked volume's ``nifti`` array, or of a raw header file."""
    if path.rstrip("/").endswith(".zarr") or files.is_dir(path):
        node = f"{path}/nifti" if files.exists(f"{path}/nifti") else path
        return Header.unpacked(opened(node).load([0]).tobytes())
    if path.endswith((".nii", ".nii.gz")):
        return Header.unpacked(_bytes(path)[:SIZE])
    data = files.read(path)
    if len(data) >= SIZE:
        return Header.unpacked(data[:SIZE])
    raise ValueError(f"no header in {path}")


def image_header(shape: Sequence[int], dtype: str, affine: Matrix, zooms: Sequence[float], space_unit: str, base: Header | None = None) -> Header:
    """Of a stored array, whose axes are the header's backwards: the last three, made up with ones; 4-D
    arrays put their first axis last."""
    spatial = list(shape[-3:])[::-1]
    spatial += [1] * (3 - len(spatial))
    lead = list(shape[:-3])[::-1]
    h = base or Header()
    return Header((*spatial, *lead), dtype if dtype in TYPES.values() else "float64", (*zooms, *[1.0] * len(lead)), affine, space_unit, h.time_unit)


class NiftiFormat(Format):
    """Axes as stored in memory order: the file's backwards."""

    def info(self) -> Info:
        h = Header.unpacked(_bytes(self.path)[:SIZE])
        return Info(tuple(reversed(h.shape)), h.dtype, {"offset": h.offset})

    def parts(self, info: Info) -> list[Part]:
        if self.path.endswith(".gz"):
            return [Part([0] * len(info.shape), info.shape)]
        step = max(1, (16 << 20) // max(1, int(np.prod(info.shape[1:])) * np.dtype(info.dtype).itemsize))
        return [Part((k, *[0] * (len(info.shape) - 1)), (min(step, info.shape[0] - k), *info.shape[1:])) for k in range(0, info.shape[0], step)]

    def load_box(self, info: Info, part: Part, bounds: Bounds) -> tuple[list[int], np.ndarray]:
        """Of a plain file only the slices within the bounds are read."""
        lo, hi = max(part.origin[0], bounds[0][0]), min(part.origin[0] + part.shape[0], bounds[0][1])
        return super().load_box(info, Part((lo, *part.origin[1:]), (max(0, hi - lo), *part.shape[1:])), bounds)

    def load(self, info: Info, part: Part) -> np.ndarray:
        size = np.dtype(info.dtype).itemsize
        row = int(np.prod(info.shape[1:])) * size
        at, n = info.extra["offset"] + part.origin[0] * row, part.shape[0] * row
        data = _bytes(self.path)[at : at + n] if self.path.endswith(".gz") else files.read(self.path, at, n)
        return np.frombuffer(data, info.dtype).reshape(part.shape)


class NiftiSource(BlockSource):
    kind, short = NiftiFormat, "nifti"


def write_nifti(path: str, a: np.ndarray, affine: Matrix | None = None) -> None:
    h = Header(tuple(reversed(a.shape)), a.dtype.name, tuple([1.0] * a.ndim), affine or np.eye(4).tolist())
    data = h.packed() + b"\0" * 4 + a.tobytes()
    files.write(path, gzip.compress(data) if path.endswith(".gz") else data)
