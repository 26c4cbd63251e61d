"""Chunked arrays and multi-scale groups written from blocks.

A file is a chunk or, with shards, many of them; each belongs to one task, which writes it beside and
moves it into place, so tasks may be tried again. A shard is written chunk by chunk and may be of any size. Metadata are written on the driver, attributes as a
whole document each time."""

from __future__ import annotations

import hashlib
import json
import random
import time
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelmill.operators.grid import BLOCKS, arrays, block_table
from voxelmill.operators.pyramid import cut_pieces, rechunked
from voxelmill.plans.config import ArrayOptions
from voxelmill.sources import files
from voxelmill.sources.zarr import ABSENT, Layout, crc32c, detect, v2_dtype


def array_document(shape: Sequence[int], chunk: Sequence[int], shard: Sequence[int] | None, dtype: str, o: ArrayOptions) -> dict:
    """The metadata document of an array."""
    name, options = o.compressor, dict(o.compressor_opt)
    if o.zarr_version == 2:
        if name == "gzip":
            name = "zlib"
        default = {"zlib": {"level": 5}, "zstd": {"level": 5}, "bz2": {"level": 5}, "blosc": {"cname": "lz4", "clevel": 5, "shuffle": 1}}.get(name, {})
        return {
            "zarr_format": 2, "shape": list(shape), "chunks": list(chunk), "dtype": v2_dtype(dtype), "fill_value": o.fill_value, "order": o.order, "filters": None,
            "compressor": None if name == "none" else {"id": name} | default | options, "dimension_separator": o.dimension_separator,
        }
    if name == "zlib":
        name = "gzip"
    default = {"gzip": {"level": 5}, "zstd": {"level": 5, "checksum": False}, "blosc": {"cname": "lz4", "clevel": 5, "shuffle": "shuffle", "typesize": np.dtype(dtype).itemsize, "blocksize": 0}}.get(name, {})
    codecs: list[dict] = [{"name": "bytes", "configuration": {"endian": "little"}}]
    if o.order == "F" and len(shape) > 1:
        codecs.insert(0, {"name": "transpose", "configuration": {"order": list(range(len(shape)))[::-1]}})
    if name != "none":
        codecs.append({"name": name, "configuration": default | options})
    if shard is not None:
        index = [{"name": "bytes", "configuration": {"endian": "little"}}, {"name": "crc32c"}]
        codecs = [{"name": "sharding_indexed", "configuration": {"chunk_shape": list(chunk), "codecs": codecs, "index_codecs": index, "index_location": "end"}}]
    return {
        "zarr_format": 3, "node_type": "array", "shape": list(shape), "data_type": dtype, "fill_value": o.fill_value,
        "chunk_grid": {"name": "regular", "configuration": {"chunk_shape": list(shard or chunk)}},
        "chunk_key_encoding": {"name": "default", "configuration": {"separator": o.dimension_separator}}, "codecs": codecs, "attributes": {}, "storage_transformers": [],
    }


def _json(doc: dict) -> bytes:
    return json.dumps(doc, indent=2).encode()


def create_group(path: str, o: ArrayOptions, mode: str | None = None) -> None:
    """Modes: w overwrites, w- and x must not exist, a keeps what is there."""
    mode = mode or ("w" if o.overwrite else "w-")
    there = files.exists(path)
    if there and mode in ("w-", "x"):
        raise FileExistsError(path)
    if there and mode == "w":
        files.delete(path)
    if not there or mode != "a" or detect(path) is None:
        files.make_dir(path)
        if o.zarr_version == 3:
            files.write(f"{path}/zarr.json", _json({"zarr_format": 3, "node_type": "group", "attributes": {}}))
        else:
            files.write(f"{path}/.zgroup", _json({"zarr_format": 2}))


#: Seconds after which a claim counts as left by a writer that has died, and between attempts.
EXPIRED, PAUSE = 60.0, 0.02


def update_attributes(path: str, new: dict) -> None:
    """Merge into a node's attributes; the document is replaced as a whole.

    Several writers may do so at once: one claims the version that it has read, makes sure that it still stands, and puts
    the next one in its place; the others read anew and try again, so no key is lost."""
    while True:
        found = detect(path)
        if found is None:
            raise ValueError(f"no Zarr node: {path}")
        name = f"{path}/{'zarr.json' if found[0] == 3 else '.zattrs'}"
        before = files.read(name) if files.exists(name) else b""
        claim = f"{name}.{hashlib.blake2b(before, digest_size=8).hexdigest()}.claim"
        if files.claim(claim, EXPIRED):
            try:
                if (files.read(name) if files.exists(name) else b"") == before:
                    doc = json.loads(before or b"{}")
                    files.write(name, _json(doc | {"attributes": doc.get("attributes", {}) | new} if found[0] == 3 else doc | new))
                    return
            finally:
                files.delete(claim)
        time.sleep(PAUSE * (1 + random.random()))


def delete_child(path: str, name: str) -> None:
    if detect(f"{path}/{name}") is None:
        raise KeyError(name)
    files.delete(f"{path}/{name}")


def encoded(layout: Layout, a: np.ndarray) -> bytes | None:
    """The bytes of a chunk (of a shard, if there are any), None where it holds nothing but the fill value."""
    if (a == layout.fill).all():
        return None
    full = np.full(layout.inner or layout.chunk, layout.fill, layout.dtype)
    full[tuple(slice(0, n) for n in a.shape)] = a
    return layout.bytes_of(full)


class _Shard:
    """A shard being written: chunks in any order, then the index."""

    def __init__(self, layout: Layout, index: Sequence[int]) -> None:
        self.layout, self.out = layout, files.Stream(layout.file(index))
        self.table = np.full((*(s // c for s, c in zip(layout.chunk, layout.inner or layout.chunk, strict=True)), 2), ABSENT, "<u8")

    def put(self, cell: tuple[int, ...], a: np.ndarray) -> None:
        data = encoded(self.layout, a)
        if data is not None:
            self.table[cell] = self.out.write(data), len(data)

    def close(self) -> int | None:
        """Its size, None if it held nothing."""
        if not self.out.size:
            self.out.drop()
            return None
        index = self.table.tobytes()
        self.out.write(index + int(crc32c(index)).to_bytes(4, "little"))
        self.out.close()
        return self.out.size


def _sharded(blocks: DataFrame, layout: Layout, dtype: str) -> DataFrame:
    """Write blocks of any boxes as shards: n, the size of each. Blocks are cut at the chunks and shuffled
    once, by shard; a task holds one chunk at a time."""
    shape, chunk, many = layout.shape, layout.inner, [s // c for s, c in zip(layout.chunk, layout.inner, strict=True)]
    ndim = len(shape)
    keys = [f"s{d}" for d in range(ndim)]
    path, document = layout.path, layout.document

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, pieces in cut_pieces(batches, shape, chunk):
            t = block_table(pieces)
            cells = [int(np.ravel_multi_index([i % m for i, m in zip(x, many, strict=True)], many)) for x in at]
            t = pa.table([*(pa.array([x[d] // many[d] for x in at], pa.int64()) for d in range(ndim)), pa.array(cells, pa.int64()), *t.columns], [*keys, "cell", *t.schema.names])
            yield from t.to_batches()

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Layout(path, *document)
        shard = at = cell = held = None

        def flush() -> None:
            if held is not None:
                shard.put(tuple(np.unravel_index(cell, many)), held)

        for batch in batches:
            sizes = []
            where = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
            for index, number, (origin, a) in zip(where, batch.column("cell").to_pylist(), arrays(batch), strict=True):
                if (index, number) != (at, cell):
                    flush()
                    if index != at:
                        if shard is not None:
                            sizes.append(shard.close())
                        shard, at = _Shard(own, index), index
                    cell, held = number, np.full(chunk, own.fill, dtype)
                held[tuple(slice(o % c, o % c + n) for o, c, n in zip(origin, chunk, a.shape, strict=True))] = a
            yield pa.RecordBatch.from_arrays([pa.array([n for n in sizes if n is not None], pa.int64())], ["n"])
        flush()
        if shard is not None and (last := shard.close()) is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.int64())], ["n"])

    pieces = blocks.select("origin", "shape", "dtype", "data").mapInArrow(cut, ", ".join(f"{k} long" for k in [*keys, "cell"]) + f", {BLOCKS}")
    return pieces.repartition(*keys).sortWithinPartitions(*keys, "cell", "origin").mapInArrow(store, "n long")


def write_array(path: str, blocks: DataFrame, shape: Sequence[int], chunk: Sequence[int], shard: Sequence[int] | None, dtype: str, o: ArrayOptions, aligned: bool = False) -> dict:
    """Write blocks of any boxes as an array; with ``aligned`` they are its chunks' boxes already, and
    without shards nothing is shuffled. Returns how many files and bytes were written."""
    doc = array_document(shape, chunk, shard, dtype, o)
    version = o.zarr_version
    files.make_dir(path)
    cell = tuple(shard or chunk)

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layout = Layout(path, version, doc)
        for batch in batches:
            sizes = []
            for origin, a in arrays(batch):
                data = encoded(layout, a)
                if data is not None:
                    files.write(layout.file([x // c for x, c in zip(origin, cell, strict=True)]), data)
                    sizes.append(len(data))
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64())], ["n"])

    if shard is not None:
        stored = _sharded(blocks, Layout(path, version, doc), dtype)
    else:
        stored = (blocks if aligned else rechunked(blocks, shape, cell, dtype, o.fill_value)).mapInArrow(store, "n long")
    n, total = stored.agg(F.count("n"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # the metadata come last: an array without them isn't there
    files.write(f"{path}/{'zarr.json' if version == 3 else '.zarray'}", _json(doc))
    return {"files": n, "bytes": total}
