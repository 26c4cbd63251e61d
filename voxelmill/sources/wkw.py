"""Voxel masks in WKW: cubes of blocks in the order of a space-filling curve, plain or compressed by LZ4."""

from __future__ import annotations

import struct
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

from voxelmill.sources import files
from voxelmill.sources.blocks import BlockSource, Bounds, Cells, Format, Info, Part

#: Fixed values of the format: magic bytes, voxel types, block types.
MAGIC, VERSION, HEAD = b"WKW", 1, 16
TYPES = {1: "uint8", 2: "uint16", 3: "uint32", 4: "uint64", 5: "float32", 6: "float64", 7: "int8", 8: "int16", 9: "int32", 10: "int64"}
RAW, LZ4, LZ4HC = 1, 2, 3


@dataclass(frozen=True)
class Head:
    """Block edge in voxels, file edge in blocks, block type, voxel type, bytes of a voxel (of all channels)
    and where the blocks begin."""

    block: int
    file: int
    kind: int
    dtype: str
    voxel: int
    start: int

    @classmethod
    def unpacked(cls, data: bytes, path: str) -> Head:
        magic, version, edges, kind, code, voxel, start = struct.unpack("<3s5BQ", data[:HEAD])
        if magic != MAGIC or version != VERSION or kind not in (RAW, LZ4, LZ4HC) or code not in TYPES:
            raise ValueError(f"no WKW file: {path}")
        return cls(1 << (edges & 15), 1 << (edges >> 4), kind, TYPES[code], voxel, start)

    def packed(self) -> bytes:
        code = next(k for k, v in TYPES.items() if v == self.dtype)
        return struct.pack("<3s5BQ", MAGIC, VERSION, self.block.bit_length() - 1 | (self.file.bit_length() - 1) << 4, self.kind, code, self.voxel, self.start)

    @property
    def channels(self) -> int:
        return self.voxel // np.dtype(self.dtype).itemsize


@lru_cache(4)
def curve(edge: int) -> np.ndarray:
    """Place of block (x, y, z) along the curve: their bits in turn, x lowest."""
    n = np.arange(edge)
    spread = sum(((n >> k) & 1) << 3 * k for k in range(edge.bit_length()))
    return spread[:, None, None] | spread[None, :, None] << 1 | spread[None, None, :] << 2


class WkwFormat(Format):
    """Axes: slice, row, column of channel 0. Options: ``shape`` (x,y,z) of the volume; ``maxLoad``. Blocks
    that aren't stored are zero."""

    def _file(self, x: int, y: int, z: int) -> str:
        return f"{self.path}/z{z}/y{y}/x{x}.wkw"

    def info(self) -> Info:
        head = Head.unpacked(files.read(f"{self.path}/header.wkw", 0, HEAD), self.path)
        x, y, z = (int(n) for n in self.options["shape"].split(","))
        # a part is a cube of whole blocks, no more of them than a file has
        step = min(head.file, max(1, int(self.options.get("maxLoad", 1024)) // head.block)) * head.block
        return Info((z, y, x), head.dtype, {"head": head, "cell": [step] * 3})

    def parts(self, info: Info) -> Cells:
        return self.within(info, [(0, n) for n in info.shape])

    def within(self, info: Info, bounds: Bounds) -> Cells:
        return Cells(info.shape, info.extra["cell"], bounds)

    def load(self, info: Info, part: Part) -> np.ndarray:
        return self.load_box(info, part, [(0, n) for n in info.shape])[1]

    def load_box(self, info: Info, part: Part, bounds: Bounds) -> tuple[list[int], np.ndarray]:
        h: Head = info.extra["head"]
        box = [(max(o, lo), min(o + n, hi)) for o, n, (lo, hi) in zip(part.origin, part.shape, bounds, strict=True)]
        out = np.zeros([max(0, hi - lo) for lo, hi in box], info.dtype)
        edge = h.block * h.file
        for z, y, x in np.ndindex(*(-(-hi // edge) - lo // edge for lo, hi in box)):
            at = [lo // edge + k for k, (lo, _) in zip((z, y, x), box, strict=True)]
            name = self._file(*reversed(at))
            if files.exists(name):
                self._put(out, box, name, h, [k * edge for k in at])
        return [lo for lo, _ in box], out

    def _put(self, out: np.ndarray, box: Bounds, name: str, h: Head, corner: list[int]) -> None:
        """What a file holds of the box; only the blocks that meet it are read."""
        size = h.block**3 * h.voxel
        ends = None if h.kind == RAW else np.frombuffer(files.read(name, HEAD, 8 * h.file**3), "<u8")
        start = Head.unpacked(files.read(name, 0, HEAD), name).start
        order = curve(h.file)
        inside = [(max(lo - c, 0) // h.block, -(-min(hi - c, h.block * h.file) // h.block)) for (lo, hi), c in zip(box, corner, strict=True)]
        for cell in np.ndindex(*(b - a for a, b in inside)):
            z, y, x = (a + k for (a, _), k in zip(inside, cell, strict=True))
            k = int(order[x, y, z])
            if ends is None:
                data = files.read(name, start + k * size, size)
            else:
                at = int(ends[k - 1]) if k else start
                data = pa.Codec("lz4_raw").decompress(files.read(name, at, int(ends[k]) - at), size, asbytes=True)
            # x runs fastest, the channels of a voxel lie together
            block = np.frombuffer(data, h.dtype).reshape(h.block, h.block, h.block, h.channels)[..., 0]
            origin = [c + i * h.block for c, i in zip(corner, (z, y, x), strict=True)]
            lo = [max(o, a) for o, (a, _) in zip(origin, box, strict=True)]
            hi = [min(o + h.block, b) for o, (_, b) in zip(origin, box, strict=True)]
            out[tuple(slice(a - b, e - b) for a, e, (b, _) in zip(lo, hi, box, strict=True))] = block[tuple(slice(a - o, e - o) for a, e, o in zip(lo, hi, origin, strict=True))]


class WkwSource(BlockSource):
    kind, short = WkwFormat, "wkw"


def write_wkw(path: str, a: np.ndarray, block: int = 32, file: int = 4, kind: int = LZ4, first: tuple[int, int, int] = (0, 0, 0)) -> None:
    """A small volume (slice, row, column) as a data set, or as those of its files that begin with number ``first`` on each axis."""
    edge, head = block * file, Head(block, file, kind, a.dtype.name, a.itemsize, HEAD + (0 if kind == RAW else 8 * file**3))
    files.write(f"{path}/header.wkw", Head(block, file, kind, a.dtype.name, a.itemsize, 0).packed())
    place = np.argsort(curve(file).ravel())
    for z, y, x in np.ndindex(*(-(-n // edge) for n in a.shape)):
        cube = np.zeros((edge, edge, edge), a.dtype)
        some = a[z * edge : (z + 1) * edge, y * edge : (y + 1) * edge, x * edge : (x + 1) * edge]
        cube[tuple(slice(0, n) for n in some.shape)] = some
        blocks = []
        for k in place:
            i, j, l = np.unravel_index(k, (file,) * 3)  # noqa: E741
            data = np.ascontiguousarray(cube[l * block : (l + 1) * block, j * block : (j + 1) * block, i * block : (i + 1) * block]).tobytes()
            blocks.append(data if kind == RAW else pa.Codec("lz4_raw").compress(data, asbytes=True))
        ends = b"" if kind == RAW else (head.start + np.cumsum([len(b) for b in blocks])).astype("<u8").tobytes()
        files.write(f"{path}/z{z + first[0]}/y{y + first[1]}/x{x + first[2]}.wkw", head.packed() + ends + b"".join(blocks))
