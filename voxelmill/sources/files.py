"""Files by path or URI: local paths, anything that pyarrow opens (hdfs, s3, gs, ...), or http and https for reading."""

from __future__ import annotations

import os
import time
import uuid

from pyarrow import fs

from voxelmill.sources import http


def located(path: str) -> tuple[fs.FileSystem, str]:
    if http.is_url(path):
        raise ValueError(f"web servers can be read, and neither listed nor written to: {path}")
    if "://" in path:
        if path.startswith("file://"):
            return fs.LocalFileSystem(), path[len("file://") :]
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), os.path.abspath(path)


def exists(path: str) -> bool:
    if http.is_url(path):
        return http.length(path) is not None
    f, p = located(path)
    return f.get_file_info(p).type != fs.FileType.NotFound


def is_dir(path: str) -> bool:
    if http.is_url(path):
        return False
    f, p = located(path)
    return f.get_file_info(p).type == fs.FileType.Directory


def read(path: str, offset: int = 0, size: int | None = None) -> bytes:
    if http.is_url(path):
        return http.read(path, offset, size)
    f, p = located(path)
    with f.open_input_file(p) as h:
        return h.read_at(h.size() - offset if size is None else size, offset)


def length(path: str) -> int:
    if http.is_url(path):
        n = http.length(path)
        if n is None:
            raise FileNotFoundError(path)
        return n
    f, p = located(path)
    return f.get_file_info(p).size


def names(path: str) -> list[str]:
    """What is in a folder, sorted."""
    f, p = located(path)
    return sorted(i.base_name for i in f.get_file_info(fs.FileSelector(p)))


def write(path: str, data: bytes) -> None:
    """Written beside and moved into place, so a reader or a second attempt never sees half a file."""
    f, p = located(path)
    f.create_dir(p.rpartition("/")[0], recursive=True)
    part = f"{p}.{uuid.uuid4().hex}.part"
    with f.open_output_stream(part) as h:
        h.write(data)
    f.move(part, p)


class Stream:
    """A file written piece by piece, beside its place until it is closed."""

    def __init__(self, path: str) -> None:
        self.fs, self.path = located(path)
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.part = f"{self.path}.{uuid.uuid4().hex}.part"
        self.file, self.size = self.fs.open_output_stream(self.part), 0

    def write(self, data: bytes) -> int:
        """Returns where the piece begins."""
        self.file.write(data)
        self.size += len(data)
        return self.size - len(data)

    def close(self) -> None:
        self.file.close()
        self.fs.move(self.part, self.path)

    def drop(self) -> None:
        self.file.close()
        self.fs.delete_file(self.part)


def delete(path: str) -> None:
    f, p = located(path)
    kind = f.get_file_info(p).type
    if kind == fs.FileType.Directory:
        f.delete_dir(p)
    elif kind != fs.FileType.NotFound:
        f.delete_file(p)


def make_dir(path: str) -> None:
    f, p = located(path)
    f.create_dir(p, recursive=True)


def move(path: str, to: str) -> None:
    """A file or folder to another place of the same store; what was there is replaced."""
    f, p = located(path)
    q = located(to)[1]
    f.create_dir(q.rpartition("/")[0], recursive=True)
    f.move(p, q)


def claim(path: str, expires: float) -> bool:
    """Make a file that isn't there; False if another has made it. One older than so many seconds is removed first.
    On local and mounted file systems exactly one of several wins; elsewhere two may that ask within one round trip."""
    f, p = located(path)
    info = f.get_file_info(p)
    if info.type != fs.FileType.NotFound:
        if info.mtime is None or time.time() - info.mtime.timestamp() < expires:
            return False
        delete(path)
    if not isinstance(f, fs.LocalFileSystem):
        with f.open_output_stream(p) as h:
            h.write(b"")
        return True
    try:
        os.close(os.open(p, os.O_CREAT | os.O_EXCL | os.O_WRONLY))
    except FileExistsError:
        return False
    return True
