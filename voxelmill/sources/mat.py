"""MATLAB files: version 5, and version 7.3 (HDF5), whose chunks are read by the tasks that want them."""

from __future__ import annotations

import logging
import math
import struct
import zlib
from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np

from voxelmill.sources import files
from voxelmill.sources.blocks import Bounds, BlockSource, Cells, Format, Info, Part
from voxelmill.sources.hdf5 import Array, File, is_hdf5

#: Fixed values of the format: data types, array classes.
NUMBERS = {1: "i1", 2: "u1", 3: "i2", 4: "u2", 5: "i4", 6: "u4", 7: "f4", 9: "f8", 12: "i8", 13: "u8", 16: "u1", 17: "u2", 18: "u4"}
MATRIX, COMPRESSED = 14, 15
CELL, STRUCT, OBJECT, CHAR, SPARSE = 1, 2, 3, 4, 5
CLASSES = {6: "f8", 7: "f4", 8: "i1", 9: "u1", 10: "i2", 11: "u2", 12: "i4", 13: "u4", 14: "i8", 15: "u8"}
#: Bytes of an HDF5 array that a part holds, about.
PART = 16 << 20


def _elements(data: bytes, order: str) -> Iterator[tuple[int, bytes]]:
    at = 0
    while at + 8 <= len(data):
        kind, size = struct.unpack_from(order + "II", data, at)
        if kind >> 16:  # up to four bytes lie within the tag
            yield kind & 0xFFFF, data[at + 4 : at + 4 + (kind >> 16)]
            at += 8
            continue
        yield kind, data[at + 8 : at + 8 + size]
        at += 8 + size + (0 if kind == COMPRESSED else -size % 8)


def _array(data: bytes, order: str) -> tuple[str, Any]:
    parts = list(_elements(data, order))
    flags = struct.unpack_from(order + "I", parts[0][1])[0]
    kind, shape = flags & 0xFF, np.frombuffer(parts[1][1], order + "i4")
    name = parts[2][1].decode("latin-1").rstrip("\0")
    if kind in (STRUCT, OBJECT):
        rest = parts[3:] if kind == STRUCT else parts[4:]
        width = struct.unpack(order + "i", rest[0][1][:4])[0]
        fields = [rest[1][1][k : k + width].split(b"\0")[0].decode("latin-1") for k in range(0, len(rest[1][1]), width)]
        values = [_array(d, order)[1] if d else None for _, d in rest[2:]]
        records = [dict(zip(fields, values[k : k + len(fields)], strict=False)) for k in range(0, len(values), max(len(fields), 1))]
        return name, records[0] if len(records) == 1 else records
    if kind == CELL:
        return name, [_array(d, order)[1] if d else None for _, d in parts[3:]]
    if kind == CHAR:
        code, raw = parts[3]
        return name, raw.decode("utf-8" if code in (1, 2, 16) else "utf-16-le" if code in (4, 17) else "latin-1")
    if kind == SPARSE or kind not in CLASSES:
        raise ValueError(f"arrays of class {kind} aren't supported")
    code, raw = parts[3]
    a = np.frombuffer(raw, order + NUMBERS[code]).astype(CLASSES[kind])
    return name, a.reshape(shape, order="F")


def _v5(path: str) -> Iterator[tuple[str, Any]]:
    data = files.read(path)
    order = "<" if data[126:128] == b"IM" else ">"
    for kind, body in _elements(data[128:], order):
        if kind == COMPRESSED:
            kind, body = next(_elements(zlib.decompress(body), order))
        if kind == MATRIX:
            yield _array(body, order)


def read_mat(path: str) -> dict[str, Any]:
    """All variables of a version 5 file."""
    return dict(_v5(path))


def chosen_key(names: list[str], key: str | None, path: str) -> str:
    """The given key, or the first that doesn't begin with an underscore."""
    if key is not None:
        if key not in names:
            raise KeyError(f"no variable {key} in {path}")
        return key
    usable = [n for n in names if not n.startswith("_") and not n.startswith("#")]
    if not usable:
        raise KeyError(f"no variable in {path}")
    if len(usable) > 1:
        logging.warning("%s has %d variables; %s is read", path, len(usable), usable[0])
    return usable[0]


class MatFormat(Format):
    """Options: ``key``, the variable; ``maxLoad``, the largest part along an axis."""

    def info(self) -> Info:
        if is_hdf5(self.path):
            f = File(self.path)
            key = chosen_key([n for n in f.members if n == self.options.get("key") or f.array(n) is not None], self.options.get("key"), self.path)
            a = f.array(key)
            if a is None:
                raise ValueError(f"{key} of {self.path} isn't a numeric array")
            return Info(a.shape, np.dtype(a.dtype).newbyteorder("=").name, {"key": key, "array": a, "cell": self._cell(a)})
        found = read_mat(self.path)
        key = chosen_key(list(found), self.options.get("key"), self.path)
        a = np.asarray(found[key])
        return Info(a.shape, a.dtype.name, {"key": key})

    def _cell(self, a: Array) -> list[int]:
        """Whole chunks or rows: as many along each axis, from the last on, as ``maxLoad`` and the size of a part leave."""
        room, most = PART // np.dtype(a.dtype).itemsize, int(self.options.get("maxLoad", 1024))
        if a.chunk is None:
            return [max(1, room // max(1, math.prod(a.shape[1:]))), *(max(1, n) for n in a.shape[1:])] if a.shape else []
        cell = list(a.chunk)
        for k in range(len(cell) - 1, -1, -1):
            chunk, others = cell[k], math.prod(cell) // cell[k]
            cell[k] = chunk * max(1, min(most // chunk, room // (others * chunk), -(-a.shape[k] // chunk)))
        return cell

    def parts(self, info: Info) -> Sequence[Part]:
        return self.within(info, [(0, n) for n in info.shape])

    def within(self, info: Info, bounds: Bounds) -> Sequence[Part]:
        # a version 5 file can't be sliced: it is one part, so that it is parsed once
        return Cells(info.shape, info.extra["cell"], bounds) if "array" in info.extra else [Part([0] * len(info.shape), info.shape)]

    def load_box(self, info: Info, part: Part, bounds: Bounds) -> tuple[list[int], np.ndarray]:
        if "array" not in info.extra:
            return super().load_box(info, part, bounds)
        box = [(max(o, lo), min(o + n, hi)) for o, n, (lo, hi) in zip(part.origin, part.shape, bounds, strict=True)]
        return [lo for lo, _ in box], File(self.path).box(info.extra["array"], box)

    def load(self, info: Info, part: Part) -> np.ndarray:
        if "array" in info.extra:
            return self.load_box(info, part, [(0, n) for n in info.shape])[1]
        where = tuple(slice(o, o + n) for o, n in zip(part.origin, part.shape, strict=True))
        return np.asarray(dict(_v5(self.path))[info.extra["key"]])[where]


class MatSource(BlockSource):
    kind, short = MatFormat, "mat"


def write_mat(path: str, variables: dict[str, np.ndarray], compress: bool = True) -> None:
    """Numeric arrays as a version 5 file."""
    codes = {np.dtype(v).newbyteorder("<"): k for k, v in NUMBERS.items() if k < 16}
    classes = {np.dtype(v): k for k, v in CLASSES.items()}

    def element(kind: int, data: bytes) -> bytes:
        return struct.pack("<II", kind, len(data)) + data + b"\0" * (-len(data) % 8)

    out = b"MATLAB 5.0 MAT-file".ljust(124) + struct.pack("<H", 0x0100) + b"IM"
    for name, a in variables.items():
        a = np.atleast_2d(a)
        body = element(6, struct.pack("<II", classes[a.dtype], 0)) + element(5, np.array(a.shape, "<i4").tobytes()) + element(1, name.encode())
        body += element(codes[a.dtype.newbyteorder("<")], a.tobytes(order="F"))
        whole = element(MATRIX, body)
        out += struct.pack("<II", COMPRESSED, len(z)) + z if compress and (z := zlib.compress(whole)) else whole
    files.write(path, out)
