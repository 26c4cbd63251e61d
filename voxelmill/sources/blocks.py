"""Spark data sources that yield boxes of voxels, or voxels.

A format says how large its array is and how it is cut into parts; neighbouring parts become a partition of
bounded size, which is read on an executor part by part. ``.option("region", "0:4,:,10:20")`` leaves out
parts that lie outside and crops the others; without it the whole array is read.

With ``.option("form", "voxels")`` rows are voxels (a column for each axis, and ``v``), and conditions on axes choose
what is opened: ``where("z >= 3 and z < 9 and x in (5, 6)")`` opens the parts that hold such voxels and makes rows of
no others. Spark asks sources for that while ``spark.sql.python.filterPushdown.enabled`` is true; ``voxels`` sets it."""

from __future__ import annotations

import importlib
import importlib.util
import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual

from voxelmill.operators.grid import BLOCKS, block_table, voxel_batches, voxel_schema


@dataclass(frozen=True)
class Info:
    shape: tuple[int, ...]
    dtype: str
    extra: dict = field(default_factory=dict, hash=False, compare=False)


class Part(InputPartition):
    """One piece to read: where it starts, how large it is, and what its format needs to find it."""

    def __init__(self, origin: Sequence[int], shape: Sequence[int], **what: object) -> None:
        self.origin, self.shape, self.what = tuple(origin), tuple(shape), what
        super().__init__(self.origin)


class Group(InputPartition):
    """Parts ``first`` to ``last - 1``."""

    def __init__(self, first: int, last: int) -> None:
        self.first, self.last = first, last
        super().__init__((first, last))


#: Parts are grouped up to this size, but into no fewer partitions than the second number if there are as many.
GROUP_BYTES, GROUPS = 128 << 20, 64
Bounds = list[tuple[int, int]]


class Cells(Sequence[Part]):
    """The boxes of a regular grid that meet the bounds, made when they are asked for: a large array has
    millions."""

    def __init__(self, shape: Sequence[int], cell: Sequence[int], bounds: Bounds) -> None:
        self.shape, self.cell = shape, cell
        self.first = [lo // c for (lo, _), c in zip(bounds, cell, strict=True)]
        self.counts = [max(0, -(-hi // c) - f) if hi > lo else 0 for (lo, hi), c, f in zip(bounds, cell, self.first, strict=True)]

    def __len__(self) -> int:
        return math.prod(self.counts)

    def __getitem__(self, k):  # noqa: ANN001, ANN204
        if not 0 <= k < len(self):
            raise IndexError(k)
        origin = []
        for c, f, n in zip(reversed(self.cell), reversed(self.first), reversed(self.counts), strict=True):
            origin.insert(0, (f + k % n) * c)
            k //= n
        return Part(origin, [min(c, s - o) for c, s, o in zip(self.cell, self.shape, origin, strict=True)])


class Format:
    """What a format brings: ``info`` from headers, ``parts``, and ``load`` of one part. One with very many
    parts or with cheap access to some of a part has its own ``within`` and ``load_box``."""

    def __init__(self, path: str, options: dict[str, str]) -> None:
        self.path, self.options = path, options

    def info(self) -> Info:
        raise NotImplementedError

    def parts(self, info: Info) -> list[Part]:
        raise NotImplementedError

    def load(self, info: Info, part: Part) -> np.ndarray:
        raise NotImplementedError

    def within(self, info: Info, bounds: Bounds) -> Sequence[Part]:
        """The parts that meet the bounds."""
        return [p for p in self.parts(info) if all(o < hi and o + n > lo for o, n, (lo, hi) in zip(p.origin, p.shape, bounds, strict=True))]

    def load_box(self, info: Info, part: Part, bounds: Bounds) -> tuple[list[int], np.ndarray]:
        """Origin and array of what of a part lies within the bounds."""
        a = self.load(info, part)
        cut = tuple(slice(max(lo - o, 0), min(hi - o, n)) for o, n, (lo, hi) in zip(part.origin, a.shape, bounds, strict=True))
        return [o + c.start for o, c in zip(part.origin, cut, strict=True)], a[cut]


def region(text: str | None, shape: Sequence[int]) -> Bounds:
    """``a:b`` for each axis, ``...`` for as many as are missing; no strides or single indices."""
    if not text:
        return [(0, n) for n in shape]
    given = [x.strip() for x in text.split(",")]
    if "..." in given:
        k = given.index("...")
        given[k : k + 1] = [":"] * (len(shape) - len(given) + 1)
    if len(given) != len(shape) or not all(x.count(":") == 1 for x in given):
        raise ValueError(f"no region of {len(shape)} axes: {text}")
    out = []
    for x, n in zip(given, shape, strict=True):
        a, b = x.split(":")
        lo, hi, _ = slice(int(a) if a else None, int(b) if b else None).indices(n)
        out.append((lo, max(lo, hi)))
    return out


class _Reader(DataSourceReader):
    def __init__(self, made: Format) -> None:
        self.made = made
        self.info = made.info()
        self.bounds = region(made.options.get("region"), self.info.shape)

    def partitions(self) -> Sequence[InputPartition]:
        if any(lo >= hi for lo, hi in self.bounds):
            return [Group(0, 0)]
        parts = self.made.within(self.info, self.bounds)
        size = math.prod(parts[0].shape) * np.dtype(self.info.dtype).itemsize if len(parts) else 1
        step = max(1, min(GROUP_BYTES // max(1, size), -(-len(parts) // GROUPS)))
        return [Group(k, min(k + step, len(parts))) for k in range(0, len(parts), step)] or [Group(0, 0)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        assert isinstance(partition, Group)
        parts = self.made.within(self.info, self.bounds) if partition.last else []
        for k in range(partition.first, partition.last):
            origin, a = self.made.load_box(self.info, parts[k], self.bounds)
            if a.size:
                yield from block_table([(origin, a)]).to_batches()


class _VoxelReader(_Reader):
    """Voxels of the parts that conditions on axes leave."""

    def __init__(self, made: Format) -> None:
        super().__init__(made)
        self.axes = axes_of(made.options, len(self.info.shape))
        self.sparse = made.options.get("sparse", "false").lower() == "true"
        self.places: dict[int, list[int]] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Take the conditions that bound an axis or name its places; what is yielded is left to Spark."""
        for f in filters:
            if not self._taken(f):
                yield f

    def _taken(self, f: Filter) -> bool:
        name = getattr(f, "attribute", ())
        if len(name) != 1 or name[0] not in self.axes:
            return False
        k, value = self.axes.index(name[0]), getattr(f, "value", None)
        if isinstance(f, IsNotNull):
            return True
        if isinstance(f, In):
            if not all(type(x) is int for x in value):
                return False
            places = sorted({x for x in value if k not in self.places or x in self.places[k]})
            self.places[k] = places
            self._narrow(k, places[0] if places else 0, places[-1] + 1 if places else 0)
            return True
        if type(value) is not int:
            return False
        for kinds, lo, hi in (((EqualTo, EqualNullSafe), value, value + 1), ((GreaterThan,), value + 1, None), ((GreaterThanOrEqual,), value, None), ((LessThan,), None, value), ((LessThanOrEqual,), None, value + 1)):
            if isinstance(f, kinds):
                self._narrow(k, lo, hi)
                return True
        return False

    def _narrow(self, k: int, lo: int | None, hi: int | None) -> None:
        a, b = self.bounds[k]
        a, b = a if lo is None else max(a, lo), b if hi is None else min(b, hi)
        self.bounds[k] = (a, max(a, b))

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        assert isinstance(partition, Group)
        parts = self.made.within(self.info, self.bounds) if partition.last else []
        for n in range(partition.first, partition.last):
            part, bounds = parts[n], list(self.bounds)
            for k, places in self.places.items():
                own = [x for x in places if max(part.origin[k], bounds[k][0]) <= x < min(part.origin[k] + part.shape[k], bounds[k][1])]
                bounds[k] = (own[0], own[-1] + 1) if own else (0, 0)
            if any(lo >= hi for lo, hi in bounds):
                continue
            origin, a = self.made.load_box(self.info, part, bounds)
            at = [np.arange(o, o + s) for o, s in zip(origin, a.shape, strict=True)]
            for k, places in self.places.items():
                own = np.flatnonzero(np.isin(at[k], places))
                at[k], a = at[k][own], a.take(own, axis=k)
            if a.size:
                yield from voxel_batches(at, a, self.info.dtype, self.axes, "v", self.sparse)


def axes_of(options: Mapping[str, str], ndim: int) -> list[str]:
    """Names of axes: those of option ``axes``, or the last of t, c, z, y, x."""
    given = [x.strip() for x in options["axes"].split(",")] if "axes" in options else [*"tczyx"][5 - ndim :] if ndim <= 5 else [f"a{k}" for k in range(ndim)]
    if len(given) != ndim or len({*given, "v"}) != ndim + 1:
        raise ValueError(f"no names for {ndim} axes: {given}")
    return given


class BlockSource(DataSource):
    """Base of the registered sources; ``kind`` is the format's class."""

    kind: type[Format]
    short = ""

    @classmethod
    def name(cls) -> str:
        return cls.short

    def _made(self) -> Format:
        # names of options keep to no case here
        options = self.options.copy()
        return self.kind(options.pop("path"), options)

    def _voxels(self) -> bool:
        form = self.options.get("form", "blocks")
        if form not in ("blocks", "voxels"):
            raise ValueError(f"form is blocks or voxels, not {form}")
        return form == "voxels"

    def schema(self) -> str:
        if not self._voxels():
            return BLOCKS
        made = self._made()
        info = made.info()
        return voxel_schema(info.dtype, axes_of(made.options, len(info.shape)))

    def reader(self, schema: object) -> DataSourceReader:
        return _VoxelReader(self._made()) if self._voxels() else _Reader(self._made())


#: Formats by name, with the modules that they need beyond this package's own.
FORMATS = {
    "spool": ("voxelmill.sources.spool", ()), "zarr": ("voxelmill.sources.zarr", ()), "mat": ("voxelmill.sources.mat", ()), "tiff": ("voxelmill.sources.tiff", ()),
    "nifti": ("voxelmill.sources.nifti", ()), "jp2": ("voxelmill.sources.optional", ("glymur",)), "wkw": ("voxelmill.sources.wkw", ()),
}


def available() -> dict[str, bool]:
    """Which formats can be read here."""
    return {name: all(importlib.util.find_spec(m) for m in needs) for name, (_, needs) in FORMATS.items()}


class UnsupportedFormatError(ValueError):
    pass


def source(name: str) -> type[BlockSource]:
    if name not in FORMATS:
        raise UnsupportedFormatError(f"no such format: {name}; there are {', '.join(FORMATS)}")
    module, needs = FORMATS[name]
    for m in needs:
        if not importlib.util.find_spec(m):
            raise UnsupportedFormatError(f"{name} needs the package {m}")
    return next(c for c in vars(importlib.import_module(module)).values() if isinstance(c, type) and issubclass(c, BlockSource) and c.short == name)


def register(spark: SparkSession) -> None:
    """Make every available format known to ``spark.read.format``."""
    for name, ok in available().items():
        if ok:
            spark.dataSource.register(source(name))


def opened(spark: SparkSession, name: str, path: str, **options: object) -> tuple[DataFrame, Info]:
    """Blocks of an array, and what its headers say."""
    kind = source(name)
    spark.dataSource.register(kind)
    given = {k: str(v) for k, v in options.items() if v is not None}
    info = kind.kind(path, given).info()
    return spark.read.format(name).options(**given).load(path), info


def voxels(spark: SparkSession, name: str, path: str, **options: object) -> DataFrame:
    """Voxels of an array. Conditions on axes choose what is opened: the session is told to push them down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(source(name))
    return spark.read.format(name).options(**{k: str(v) for k, v in options.items() if v is not None}).option("form", "voxels").load(path)
