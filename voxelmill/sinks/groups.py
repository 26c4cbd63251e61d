"""Groups of stored arrays as mappings: what is in them, new children, copies of an array's layout."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np

from voxelmill.plans.config import ArrayOptions
from voxelmill.sinks import zarr as sink
from voxelmill.sources import files
from voxelmill.sources.zarr import Layout, attributes, children, detect
from voxelmill.sources.zarr import opened as array_at


class Group:
    """A group at a path. Names may be paths within it."""

    def __init__(self, path: str) -> None:
        found = detect(path)
        if found is None or found[1] != "group":
            raise KeyError(f"no group: {path}")
        self.path, self.version = path.rstrip("/"), found[0]

    @classmethod
    def create(cls, path: str, o: ArrayOptions, mode: str | None = None) -> Group:
        sink.create_group(path, o, mode)
        return cls(path)

    def __contains__(self, name: str) -> bool:
        return detect(f"{self.path}/{name}") is not None

    def keys(self) -> list[str]:
        return children(self.path)

    def __iter__(self) -> Iterator[str]:
        return iter(self.keys())

    def __len__(self) -> int:
        return len(self.keys())

    def __getitem__(self, name: str) -> Group | Layout:
        """A group, or an array's layout, which reads boxes."""
        found = detect(f"{self.path}/{name}")
        if found is None:
            raise KeyError(name)
        return Group(f"{self.path}/{name}") if found[1] == "group" else array_at(f"{self.path}/{name}")

    def __delitem__(self, name: str) -> None:
        sink.delete_child(self.path, name)

    def __setitem__(self, name: str, a: np.ndarray) -> None:
        """Store an array that fits the driver, as one chunk; large ones are written from blocks."""
        doc = sink.array_document(a.shape, [max(1, n) for n in a.shape], None, a.dtype.name, self._options())
        self._made(name, doc)
        layout = Layout(f"{self.path}/{name}", self.version, doc)
        data = sink.encoded(layout, a)
        if data is not None:
            files.write(layout.file([0] * a.ndim), data)

    def _options(self) -> ArrayOptions:
        return ArrayOptions(zarr_version=self.version)

    def _made(self, name: str, doc: dict) -> Layout:
        node = f"{self.path}/{name}"
        if detect(node) is not None:
            files.delete(node)
        files.write(f"{node}/{'zarr.json' if self.version == 3 else '.zarray'}", json.dumps(doc, indent=2).encode())
        return array_at(node)

    def create_group(self, name: str, overwrite: bool = False) -> Group:
        return Group.create(f"{self.path}/{name}", ArrayOptions(zarr_version=self.version, overwrite=overwrite))

    def create_array(self, name: str, shape: Sequence[int], dtype: str, chunk: Sequence[int], shard: Sequence[int] | None = None, o: ArrayOptions | None = None) -> Layout:
        """An empty array; regions of it are written by ``sink.write_array``."""
        return self._made(name, sink.array_document(shape, chunk, shard, dtype, o or self._options()))

    def create_array_like(self, name: str, shape: Sequence[int], base: str = "0") -> Layout:
        """An empty array of another shape, with the type, chunks, shards and codecs of ``base``."""
        found = detect(f"{self.path}/{base}")
        if found is None or found[1] != "array":
            raise KeyError(base)
        return self._made(name, found[2] | {"shape": list(shape)} | ({"attributes": {}} if self.version == 3 else {}))

    @property
    def attrs(self) -> dict:
        return attributes(self.path)

    def update(self, new: dict) -> None:
        sink.update_attributes(self.path, new)
