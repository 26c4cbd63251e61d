"""Chunked arrays and groups in Zarr formats 2 and 3, sharded ones included."""

from __future__ import annotations

import bz2
import gzip
import itertools
import json
import math
import struct
import zlib
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
from pyspark.sql.datasource import DataSourceWriter
from pyspark.sql.types import StructType

from voxelmill.sources import blosc, files
from voxelmill.sources.blocks import Bounds, BlockSource, Cells, Format, Info, Part

Codec = tuple[Callable[[bytes], bytes], Callable[[bytes], bytes]]
ABSENT = (1 << 64) - 1


def _zstd(level: int) -> Codec:
    import zstandard

    return zstandard.ZstdCompressor(level=level).compress, lambda b: zstandard.ZstdDecompressor().decompressobj().decompress(b)


def _blosc(options: dict) -> Codec:
    shuffle = {"noshuffle": 0, "shuffle": 1, "bitshuffle": 2, -1: 1}
    given = options.get("shuffle", 1)
    how, item = shuffle.get(given, given), int(options.get("typesize") or options.get("itemsize") or 1)
    return lambda b: blosc.compress(b, item, options.get("cname", "lz4"), int(options.get("clevel", 5)), how), blosc.decompress


def codec(name: str | None, options: dict | None = None) -> Codec:
    """Encoder and decoder of a compressor by name."""
    o = options or {}
    level = int(o.get("level", o.get("clevel", 5)))
    if name in (None, "none"):
        return bytes, bytes
    made: dict[str, Callable[[], Codec]] = {
        "zlib": lambda: (lambda b: zlib.compress(b, level), zlib.decompress), "gzip": lambda: (lambda b: gzip.compress(b, level, mtime=0), gzip.decompress),
        "bz2": lambda: (lambda b: bz2.compress(b, max(1, level)), bz2.decompress), "zstd": lambda: _zstd(level), "blosc": lambda: _blosc(o),
    }
    if name not in made:
        raise ValueError(f"unknown compressor: {name}")
    return made[name]()


def _crc_table() -> list[int]:
    out = []
    for n in range(256):
        for _ in range(8):
            n = n >> 1 ^ (0x82F63B78 if n & 1 else 0)
        out.append(n)
    return out


_CRC = _crc_table()


def crc32c(data: bytes) -> int:
    c = 0xFFFFFFFF
    for b in data:
        c = _CRC[(c ^ b) & 255] ^ c >> 8
    return c ^ 0xFFFFFFFF


def v2_dtype(dtype: str) -> str:
    return np.dtype(dtype).newbyteorder("<").str


def detect(path: str) -> tuple[int, str, dict] | None:
    """Format, node type and metadata document; format 3 is looked for first."""
    if files.exists(f"{path}/zarr.json"):
        doc = json.loads(files.read(f"{path}/zarr.json"))
        return 3, doc["node_type"], doc
    for name, kind in ((".zarray", "array"), (".zgroup", "group")):
        if files.exists(f"{path}/{name}"):
            return 2, kind, json.loads(files.read(f"{path}/{name}"))
    return None


def attributes(path: str) -> dict:
    found = detect(path)
    if found is None:
        raise ValueError(f"no Zarr node: {path}")
    if found[0] == 3:
        return found[2].get("attributes", {})
    return json.loads(files.read(f"{path}/.zattrs")) if files.exists(f"{path}/.zattrs") else {}


def children(path: str) -> list[str]:
    return [n for n in files.names(path) if detect(f"{path}/{n}")]


def level_count(path: str) -> int:
    """How many children have a number for a name."""
    return sum(n.isascii() and n.isdigit() for n in files.names(path))


class Layout:
    """Where an array's chunks are and how they are encoded."""

    def __init__(self, path: str, version: int, doc: dict[str, Any]) -> None:
        self.path, self.version, self.document = path, version, (version, doc)
        self.shape = tuple(doc["shape"])
        self.fill = doc.get("fill_value") or 0
        self.order = "C"
        self.inner: tuple[int, ...] | None = None
        self.turned: tuple[int, ...] | None = None
        if version == 2:
            self.dtype, self.chunk, self.order = np.dtype(doc["dtype"]), tuple(doc["chunks"]), doc.get("order", "C")
            c = doc.get("compressor")
            self.codec = codec(c["id"] if c else None, {"itemsize": self.dtype.itemsize} | c if c else None)
            self.separator = doc.get("dimension_separator", ".")
            return
        self.dtype, self.chunk = np.dtype(doc["data_type"]), tuple(doc["chunk_grid"]["configuration"]["chunk_shape"])
        key = doc["chunk_key_encoding"]
        self.prefix, self.separator = key["name"] == "default", key.get("configuration", {}).get("separator", "/" if key["name"] == "default" else ".")
        codecs = list(doc["codecs"])
        if codecs[0]["name"] == "sharding_indexed":
            inner = codecs[0]["configuration"]
            self.inner, codecs = tuple(inner["chunk_shape"]), list(inner["codecs"])
            self.index_first = inner.get("index_location", "end") == "start"
        # an array whose first axis runs fastest is stored as its transpose
        self.turned = tuple(codecs.pop(0)["configuration"]["order"]) if codecs[0]["name"] == "transpose" else None
        self.big = any(c["name"] == "bytes" and c.get("configuration", {}).get("endian") == "big" for c in codecs)
        self.dtype = self.dtype.newbyteorder(">") if self.big else self.dtype
        rest = [c for c in codecs if c["name"] not in ("bytes", "crc32c")]
        if len(rest) > 1:
            raise ValueError(f"codecs of {path} aren't supported: {[c['name'] for c in codecs]}")
        self.codec = codec(rest[0]["name"], rest[0].get("configuration")) if rest else codec(None)

    def file(self, index: Sequence[int]) -> str:
        parts = self.separator.join(map(str, index)) or "0"
        if self.version == 3 and self.prefix:
            parts = f"c{self.separator}{parts}"
        return f"{self.path}/{parts}"

    def bytes_of(self, a: np.ndarray) -> bytes:
        """An encoded chunk."""
        return self.codec[0](a.tobytes(order=self.order) if self.turned is None else np.ascontiguousarray(a.transpose(self.turned)).tobytes())

    def _decoded(self, data: bytes, shape: Sequence[int]) -> np.ndarray:
        flat = np.frombuffer(self.codec[1](data), self.dtype)
        a = flat.reshape(shape, order=self.order) if self.turned is None else flat.reshape([shape[k] for k in self.turned]).transpose(np.argsort(self.turned))
        return a.astype(self.dtype.newbyteorder("="))

    def index_of(self, name: str) -> np.ndarray:
        """Offset and size of every chunk of a shard."""
        counts = [s // c for s, c in zip(self.chunk, self.inner or self.chunk, strict=True)]
        length = 16 * math.prod(counts) + 4
        raw = files.read(name, 0 if self.index_first else files.length(name) - length, length)
        if struct.unpack("<I", raw[-4:])[0] != crc32c(raw[:-4]):
            raise ValueError(f"the index of {name} is damaged")
        return np.frombuffer(raw[:-4], "<u8").reshape(*counts, 2)

    def read(self, bounds: Bounds) -> np.ndarray:
        """A box, the fill value where nothing is stored. Of a chunk the whole file is read, of a shard its
        index and the chunks that meet the box."""
        out = np.full([hi - lo for lo, hi in bounds], self.fill, self.dtype.newbyteorder("="))
        if not out.size:
            return out

        def put(origin: Sequence[int], a: np.ndarray) -> None:
            lo = [max(o, x) for o, (x, _) in zip(origin, bounds, strict=True)]
            hi = [min(o + n, y) for o, n, (_, y) in zip(origin, a.shape, bounds, strict=True)]
            out[tuple(slice(x - b, y - b) for x, y, (b, _) in zip(lo, hi, bounds, strict=True))] = a[tuple(slice(x - o, y - o) for x, y, o in zip(lo, hi, origin, strict=True))]

        for index in _meeting(bounds, self.chunk):
            name, corner = self.file(index), [i * c for i, c in zip(index, self.chunk, strict=True)]
            if not files.exists(name):
                continue
            if self.inner is None:
                put(corner, self._decoded(files.read(name), self.chunk))
                continue
            table = self.index_of(name)
            inside = [(max(lo - o, 0), min(hi - o, c)) for (lo, hi), o, c in zip(bounds, corner, self.chunk, strict=True)]
            for cell in _meeting(inside, self.inner):
                at, n = (int(x) for x in table[cell])
                if at != ABSENT:
                    put([o + i * c for o, i, c in zip(corner, cell, self.inner, strict=True)], self._decoded(files.read(name, at, n), self.inner))
        return out

    def load(self, index: Sequence[int]) -> np.ndarray:
        """A whole chunk or shard, clipped to the array."""
        return self.read([(i * c, min(i * c + c, s)) for i, c, s in zip(index, self.chunk, self.shape, strict=True)])

    def part(self, most: int = 128 << 20) -> list[int]:
        """The boxes to read at once: chunks or shards, or of a shard that is too large as many of its chunks
        as are no larger than ``most`` bytes and divide it evenly."""
        if self.inner is None:
            return list(self.chunk)
        many = [s // c for s, c in zip(self.chunk, self.inner, strict=True)]
        while math.prod(many) > 1 and math.prod(many) * math.prod(self.inner) * self.dtype.itemsize > most:
            k = max(range(len(many)), key=lambda k: many[k])
            many[k] = max(d for d in range(1, many[k]) if many[k] % d == 0)
        return [n * c for n, c in zip(many, self.inner, strict=True)]


def _meeting(bounds: Bounds, cell: Sequence[int]) -> Iterator[tuple[int, ...]]:
    """Cells of a grid that meet a box."""
    return itertools.product(*(range(lo // c, -(-hi // c)) for (lo, hi), c in zip(bounds, cell, strict=True)))


def opened(path: str) -> Layout:
    found = detect(path)
    if found is None or found[1] != "array":
        raise ValueError(f"no Zarr array: {path}")
    return Layout(path, found[0], found[2])


class ZarrFormat(Format):
    """Options: ``level``, the child of a multi-scale group to read."""

    def _path(self) -> str:
        return f"{self.path}/{self.options['level']}" if "level" in self.options else self.path

    def info(self) -> Info:
        a = opened(self._path())
        return Info(a.shape, a.dtype.newbyteorder("=").name, {"chunk": a.inner or a.chunk, "cell": a.part(), "layout": a.document})

    def _layout(self, info: Info) -> Layout:
        return Layout(self._path(), *info.extra["layout"])

    def parts(self, info: Info) -> Sequence[Part]:
        return self.within(info, [(0, n) for n in info.shape])

    def within(self, info: Info, bounds: Bounds) -> Sequence[Part]:
        return Cells(info.shape, info.extra["cell"], bounds)

    def load(self, info: Info, part: Part) -> np.ndarray:
        return self.load_box(info, part, [(0, n) for n in info.shape])[1]

    def load_box(self, info: Info, part: Part, bounds: Bounds) -> tuple[list[int], np.ndarray]:
        box = [(max(o, lo), min(o + n, hi)) for o, n, (lo, hi) in zip(part.origin, part.shape, bounds, strict=True)]
        return [lo for lo, _ in box], self._layout(info).read(box)


class ZarrSource(BlockSource):
    """Can be written as well: see ``voxelmill.sinks.regions``."""

    kind, short = ZarrFormat, "zarr"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        from voxelmill.sinks.regions import ZarrWriter

        if schema.names[:4] != ["origin", "shape", "dtype", "data"]:
            raise ValueError(f"arrays are written from blocks, not from {', '.join(schema.names)}")
        options = self.options.copy()
        return ZarrWriter(options.pop("path"), options, overwrite)
