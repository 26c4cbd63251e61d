"""Arrays by ``df.write``, and boxes written into arrays that are there.

A file, a chunk or a shard, belongs to one task. Where boxes cover some of it, its task reads what is stored, puts the
boxes over it and replaces the file; of a shard, chunks that no box touches are copied as they lie, with a new index.

    laid_out(blocks, shape, chunk, shard).write.format("zarr").mode("overwrite").option("shape", "100,20,64").option("dtype", "int32").save(path)
    laid_out_for(path, blocks).write.format("zarr").mode("append").save(path)

Tasks write into a folder beside the array. When all have ended the driver moves it into place; it holds names of files, never
voxels. A job that fails leaves nothing. ``laid_out`` brings the boxes of a file to one task, in order; where two tasks
have written one file all the same, nothing is put into place. ``write_region`` replaces files task by task and needs no driver for it."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSourceArrowWriter, WriterCommitMessage

from voxelmill.operators.grid import BLOCKS, arrays, block_table
from voxelmill.operators.pyramid import cut_pieces
from voxelmill.plans.config import ArrayOptions
from voxelmill.plans.layout import layout as planned
from voxelmill.sinks.zarr import array_document
from voxelmill.sources import files
from voxelmill.sources.zarr import ABSENT, Layout, crc32c, detect, opened

Index = tuple[int, ...]


def laid_out(blocks: DataFrame, shape: Sequence[int], chunk: Sequence[int], shard: Sequence[int] | None = None) -> DataFrame:
    """Blocks of any boxes within the array, cut at its chunks and shuffled once, by file: in a task, a file's pieces
    lie together, by chunk and then by the origin of the box that they come from, so that later boxes lie over earlier ones."""
    many = [s // c for s, c in zip(shard or chunk, chunk, strict=True)]
    keys = [f"s{d}" for d in range(len(shape))]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, (o, n) in enumerate(zip(batch.column("origin").to_pylist(), batch.column("shape").to_pylist(), strict=True)):
                if len(o) != len(shape) or any(a < 0 or a + b > s for a, b, s in zip(o, n, shape, strict=True)):
                    raise ValueError(f"a box of {n} at {o} isn't within {list(shape)}")
                for at, pieces in cut_pieces([batch.slice(k, 1)], shape, chunk):
                    t = block_table(pieces)
                    cells = [int(np.ravel_multi_index([i % m for i, m in zip(x, many, strict=True)], many)) for x in at]
                    own = [*(pa.array([x[d] // many[d] for x in at], pa.int64()) for d in range(len(shape))), pa.array(cells, pa.int64()), pa.array([o] * len(at), pa.list_(pa.int64()))]
                    yield from pa.table([*own, *t.columns], [*keys, "cell", "box", *t.schema.names]).to_batches()

    pieces = blocks.select("origin", "shape", "dtype", "data").mapInArrow(cut, ", ".join(f"{k} long" for k in [*keys, "cell"]) + f", box array<long>, {BLOCKS}")
    return pieces.repartition(*keys).sortWithinPartitions(*keys, "cell", "box").select("origin", "shape", "dtype", "data")


def laid_out_for(path: str, blocks: DataFrame) -> DataFrame:
    """``laid_out`` for an array that is there."""
    a = opened(path)
    return laid_out(blocks, a.shape, a.inner or a.chunk, a.chunk if a.inner else None)


class _File:
    """A chunk or shard in the making, over what ``base`` has stored of it."""

    def __init__(self, out: Layout, base: Layout | None, index: Index) -> None:
        self.layout, self.index = out, index
        self.cell = out.inner or out.chunk
        self.old = base if base is not None and files.exists(base.file(index)) else None
        self.many = [s // c for s, c in zip(out.chunk, self.cell, strict=True)]
        self.stream = files.Stream(out.file(index))
        self.table = np.full((*self.many, 2), ABSENT, "<u8")
        self.at: Index | None = None
        self.held = np.zeros(0)
        self.done: set[Index] = set()

    def _box(self, cell: Index) -> list[tuple[int, int]]:
        origin = [(i * m + k) * c for i, m, k, c in zip(self.index, self.many, cell, self.cell, strict=True)]
        return [(o, min(o + c, s)) for o, c, s in zip(origin, self.cell, self.layout.shape, strict=True)]

    def put(self, origin: Sequence[int], a: np.ndarray) -> None:
        at = tuple(o // c % m for o, c, m in zip(origin, self.cell, self.many, strict=True))
        if at != self.at:
            self._flush()
            if at in self.done:
                raise ValueError(f"pieces of one chunk don't lie together: {list(origin)}; use laid_out")
            self.at, self.held = at, np.full(self.cell, self.layout.fill, self.layout.dtype.newbyteorder("="))
            box = self._box(at)
            if self.old is not None and a.shape != tuple(hi - lo for lo, hi in box):
                self.held[tuple(slice(0, hi - lo) for lo, hi in box)] = self.old.read(box)
        self.held[tuple(slice(o % c, o % c + n) for o, c, n in zip(origin, self.cell, a.shape, strict=True))] = a

    def _store(self, cell: Index, data: bytes) -> None:
        self.table[cell] = self.stream.write(data), len(data)

    def _flush(self) -> None:
        if self.at is None:
            return
        self.done.add(self.at)
        if (self.held != self.layout.fill).any():
            self._store(self.at, self.layout.bytes_of(self.held.astype(self.layout.dtype, copy=False)))

    def close(self) -> int:
        """The file's size; 0 if there is none, as it would hold nothing but the fill value."""
        self._flush()
        if self.layout.inner is not None and self.old is not None:
            name = self.old.file(self.index)
            table = self.old.index_of(name)
            for cell in np.ndindex(*self.many):
                if cell not in self.done and table[cell][0] != ABSENT:
                    self._store(cell, files.read(name, *(int(x) for x in table[cell])))
        if not self.stream.size:
            self.stream.drop()
            return 0
        if self.layout.inner is not None:
            index = self.table.tobytes()
            tail = index + int(crc32c(index)).to_bytes(4, "little")
            if self.layout.index_first:
                raise ValueError("shards with their index in front aren't written")
            self.stream.write(tail)
        self.stream.close()
        return self.stream.size


def stored(batches: Iterator[pa.RecordBatch], out: Layout, base: Layout | None) -> Iterator[tuple[Index, int]]:
    """Write pieces in the order of ``laid_out``: index and size of each file."""
    now: _File | None = None
    seen: set[Index] = set()
    try:
        for batch in batches:
            for origin, a in arrays(batch):
                index = tuple(o // c for o, c in zip(origin, out.chunk, strict=True))
                if now is None or index != now.index:
                    if now is not None:
                        done, now = now, None
                        yield done.index, done.close()
                    if index in seen:
                        raise ValueError(f"pieces of one file don't lie together: {list(origin)}; use laid_out")
                    seen.add(index)
                    now = _File(out, base, index)
                now.put(origin, a)
        if now is not None:
            done, now = now, None
            yield done.index, done.close()
    finally:
        if now is not None:
            now.stream.drop()


def write_region(path: str, blocks: DataFrame) -> dict:
    """Put boxes into an array that is there, later origins over earlier ones; what they don't cover stays. Files are replaced one
    by one, each as a whole. Returns how many files and bytes were written."""
    document = opened(path).document

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layout = Layout(path, *document)
        for index, size in stored(batches, layout, layout):
            if not size:
                files.delete(layout.file(index))
            yield pa.RecordBatch.from_arrays([pa.array([size], pa.int64())], ["n"])

    n, total = laid_out_for(path, blocks).mapInArrow(store, "n long").agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    return {"files": n, "bytes": total}


@dataclass
class Written(WriterCommitMessage):
    """Files of a task: index, and size (0: none any more)."""

    files: list[tuple[Index, int]]


class ZarrWriter(DataSourceArrowWriter):
    """``overwrite`` makes the array anew; else boxes go into the array that is there, or a new one if there is none.

    Options of a new array: shape and dtype; chunk, shard, compressor, zarr_version, order, dimension_separator as in ``ArrayOptions``."""

    def __init__(self, path: str, options: Mapping[str, str], overwrite: bool) -> None:
        self.path = path
        self.part = f"{path.rstrip('/')}.{uuid.uuid4().hex}.part"
        found = detect(path)
        self.into = not overwrite and found is not None
        if self.into and found[1] != "array":
            raise ValueError(f"no Zarr array: {path}")
        self.version, self.document = (found[0], found[2]) if self.into else new_document(options)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        out = Layout(self.part, self.version, self.document)
        return Written(list(stored(iterator, out, Layout(self.path, self.version, self.document) if self.into else None)))

    def commit(self, messages: list[Written | None]) -> None:
        done = [x for m in messages if m is not None for x in m.files]
        if len({index for index, _ in done}) < len(done):
            self.abort(messages)
            raise ValueError("one file was written by several tasks; use laid_out")
        if self.into:
            here, there = Layout(self.part, self.version, self.document), Layout(self.path, self.version, self.document)

            def put(x: tuple[Index, int]) -> None:
                if x[1]:
                    files.move(here.file(x[0]), there.file(x[0]))
                else:
                    files.delete(there.file(x[0]))

            with ThreadPoolExecutor(16) as pool:
                list(pool.map(put, done))
            files.delete(self.part)
            return
        files.write(f"{self.part}/{'zarr.json' if self.version == 3 else '.zarray'}", json.dumps(self.document, indent=2).encode())
        files.delete(self.path)
        files.move(self.part, self.path)

    def abort(self, messages: list[Written | None]) -> None:
        files.delete(self.part)


def new_document(options: Mapping[str, str]) -> tuple[int, dict]:
    """Format and metadata of an array from the options of a writer."""
    missing = [k for k in ("shape", "dtype") if k not in options]
    if missing:
        raise ValueError(f"a new array needs the option {' and '.join(missing)}")
    sizes = lambda k: tuple(int(x) for x in options[k].split(","))
    given: dict = {k: sizes(k) for k in ("chunk",) if k in options} | {k: options[k] for k in ("compressor", "order", "dimension_separator") if k in options}
    if "shard" in options:
        given["shard"] = options["shard"] if options["shard"] == "auto" else sizes("shard")
    o = ArrayOptions(zarr_version=int(options.get("zarr_version", 3)), fill_value=int(options.get("fill_value", 0)), **given)
    shape, dtype = sizes("shape"), options["dtype"]
    chunk, shard = planned(shape, np.dtype(dtype).itemsize, o)
    return o.zarr_version, array_document(shape, chunk, shard, dtype, o)

