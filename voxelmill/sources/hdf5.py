"""Numeric arrays of HDF5 files, among them MATLAB's of version 7.3, by byte ranges.

What is read: superblocks 0 to 3 behind any user block, object headers 1 and 2, groups by symbol tables or compact links, arrays
of integers and floats stored compact, contiguous or in chunks with a version 1 B-tree; filters deflate, shuffle and Fletcher32.
A box takes a walk down those branches of the chunk tree that can hold its chunks, so an array with
millions of chunks is never indexed in one place: each task finds its own."""

from __future__ import annotations

import itertools
import math
import struct
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np

from voxelmill.sources import files
from voxelmill.sources.blocks import Bounds

SIGNATURE = b"\x89HDF\r\n\x1a\n"
#: Message types and filters of the format (fixed values).
DATASPACE, LINK_INFO, DATATYPE, LINK, LAYOUT, FILTERS, CONTINUED, SYMBOLS = 0x01, 0x02, 0x03, 0x06, 0x08, 0x0B, 0x10, 0x11
DEFLATE, SHUFFLE, FLETCHER = 1, 2, 3
NOWHERE = (1 << 64) - 1


class UnreadableError(ValueError):
    pass


def _place(path: str) -> int | None:
    """Where the superblock is: at the start, or behind a user block of 512 bytes or a doubling of that."""
    size, at = files.length(path), 0
    while at + 8 <= size:
        if files.read(path, at, 8) == SIGNATURE:
            return at
        at = at * 2 or 512
        if at > 1 << 20:
            return None
    return None


def is_hdf5(path: str) -> bool:
    return _place(path) is not None


@dataclass(frozen=True)
class Array:
    """An array's shape and type, and where its values are."""

    shape: tuple[int, ...]
    dtype: str
    chunk: tuple[int, ...] | None = None
    #: Address of the values or of the chunk tree; values of a compact array.
    address: int = NOWHERE
    held: bytes = b""
    filters: tuple[tuple[int, tuple[int, ...]], ...] = field(default=())


class File:
    def __init__(self, path: str) -> None:
        self.path = path
        start = _place(path)
        if start is None:
            raise UnreadableError(f"no HDF5 file: {path}")
        head = files.read(path, start, 96)
        version = head[8]
        if version in (0, 1):
            offsets, lengths = head[13], head[14]
            at = 24 + 4 * (version == 1)
            self.base = struct.unpack_from("<Q", head, at)[0]
            self.root = struct.unpack_from("<Q", head, at + 40)[0]
        elif version in (2, 3):
            offsets, lengths = head[9], head[10]
            self.base, _, _, self.root = struct.unpack_from("<4Q", head, 12)
        else:
            raise UnreadableError(f"superblock {version} of {path} isn't supported")
        if (offsets, lengths) != (8, 8):
            raise UnreadableError(f"addresses of {offsets} bytes in {path} aren't supported")

    def read(self, address: int, size: int) -> bytes:
        return files.read(self.path, self.base + address, size)

    def messages(self, address: int) -> list[tuple[int, bytes]]:
        """Type and body of all messages of an object header."""
        head = self.read(address, 16)
        out: list[tuple[int, bytes]] = []
        if head[:4] == b"OHDR":
            flags, at = head[5], 6 + 16 * bool(head[5] & 32) + 4 * bool(head[5] & 16)
            width = 1 << (flags & 3)
            size = int.from_bytes(self.read(address + at, width), "little")
            blocks = [self.read(address + at + width, size)]
            skip = 4 + 2 * bool(flags & 4)
            while blocks:
                block, at = blocks.pop(0), 0
                while at + skip <= len(block):
                    kind, n = struct.unpack_from("<BH", block, at)
                    self._take(kind, block[at + skip : at + skip + n], out, blocks, True)
                    at += skip + n
            return out
        if head[0] != 1:
            raise UnreadableError(f"object header {head[0]} of {self.path} isn't supported")
        blocks = [self.read(address + 16, struct.unpack_from("<I", head, 8)[0])]
        while blocks:
            block, at = blocks.pop(0), 0
            while at + 8 <= len(block):
                kind, n = struct.unpack_from("<HH", block, at)
                self._take(kind, block[at + 8 : at + 8 + n], out, blocks, False)
                at += 8 + n
        return out

    def _take(self, kind: int, body: bytes, out: list[tuple[int, bytes]], blocks: list[bytes], new: bool) -> None:
        if kind != CONTINUED:
            out.append((kind, body))
            return
        address, size = struct.unpack_from("<QQ", body)
        # newer blocks have a mark in front and a checksum behind
        blocks.append(self.read(address + 4, size - 8) if new else self.read(address, size))

    @cached_property
    def members(self) -> dict[str, int]:
        """Names in the root group, in order, and the addresses of their headers."""
        out: dict[str, int] = {}
        for kind, body in self.messages(self.root):
            if kind == SYMBOLS:
                tree, heap = struct.unpack_from("<QQ", body)
                names = self._heap(heap)
                for at in self._symbol_nodes(tree):
                    count = struct.unpack("<H", self.read(at + 6, 2))[0]
                    entries = self.read(at + 8, 40 * count)
                    for k in range(count):
                        name, address = struct.unpack_from("<QQ", entries, 40 * k)
                        out[names[name : names.index(b"\0", name)].decode()] = address
            elif kind == LINK:
                name, address = _link(body)
                if address is not None:
                    out[name] = address
            elif kind == LINK_INFO and struct.unpack_from("<Q", body, 2 + 8 * (body[1] & 1))[0] != NOWHERE:
                raise UnreadableError(f"a group with very many links, as in {self.path}, isn't supported")
        return dict(sorted(out.items()))

    def _heap(self, address: int) -> bytes:
        size, _, data = struct.unpack_from("<QQQ", self.read(address, 32), 8)
        return self.read(data, size)

    def _symbol_nodes(self, address: int) -> Iterator[int]:
        head = self.read(address, 24)
        if head[:4] == b"SNOD":
            yield address
            return
        used = struct.unpack_from("<H", head, 6)[0]
        body = self.read(address + 24, 16 * used + 8)
        for k in range(used):
            yield from self._symbol_nodes(struct.unpack_from("<Q", body, 16 * k + 8)[0])

    def array(self, name: str) -> Array | None:
        """None if it isn't an array of integers or floats."""
        found = dict(self.messages(self.members[name]))
        if not {DATASPACE, DATATYPE, LAYOUT} <= found.keys():
            return None
        dtype = _dtype(found[DATATYPE])
        return None if dtype is None else self._layout(_dims(found[DATASPACE]), dtype, found[LAYOUT], _filters(found.get(FILTERS, b"")))

    def _layout(self, shape: tuple[int, ...], dtype: str, body: bytes, filters: tuple) -> Array:
        version, kind = body[0], body[1]
        if version not in (3, 4) or (version == 4 and kind == 2):
            raise UnreadableError(f"a layout of version {version}, class {kind}, as in {self.path}, isn't supported")
        if kind == 0:
            return Array(shape, dtype, held=body[4 : 4 + struct.unpack_from("<H", body, 2)[0]])
        if kind == 1:
            return Array(shape, dtype, address=struct.unpack_from("<Q", body, 2)[0])
        rank = body[2]
        return Array(shape, dtype, struct.unpack_from(f"<{rank - 1}I", body, 11), struct.unpack_from("<Q", body, 3)[0], filters=filters)

    def chunks(self, a: Array, bounds: Bounds) -> Iterator[tuple[tuple[int, ...], int, int, int]]:
        """Origin, filter mask, address and size of the stored chunks that meet a box."""
        lo = tuple(b // c * c for (b, _), c in zip(bounds, a.chunk or (), strict=True))
        hi = tuple(b - 1 for _, b in bounds)
        if a.address == NOWHERE or any(x > y for x, y in zip(lo, hi, strict=True)):
            return
        rank, todo = len(a.shape), [a.address]
        key = 8 + 8 * (rank + 1)
        while todo:
            address = todo.pop()
            head = self.read(address, 24)
            if head[:4] != b"TREE" or head[4] != 1:
                raise UnreadableError(f"the chunk index of {self.path} is damaged")
            level, used = head[5], struct.unpack_from("<H", head, 6)[0]
            body = self.read(address + 24, (key + 8) * used + key)
            keys = [struct.unpack_from(f"<II{rank}Q", body, (key + 8) * k) for k in range(used + 1)]
            for k in range(used):
                size, mask, *origin = keys[k]
                # chunks lie in row-major order: a branch holds those from its key to the next
                if tuple(origin) > hi or (level and tuple(keys[k + 1][2:]) < lo):
                    continue
                child = struct.unpack_from("<Q", body, (key + 8) * k + key)[0]
                if level:
                    todo.append(child)
                elif all(o < y and o + c > x for o, c, (x, y) in zip(origin, a.chunk, bounds, strict=True)):
                    yield tuple(origin), mask, child, size

    def box(self, a: Array, bounds: Bounds) -> np.ndarray:
        """Values of a box; zeros where nothing is stored."""
        out = np.zeros([hi - lo for lo, hi in bounds], np.dtype(a.dtype).newbyteorder("="))
        if not out.size:
            return out
        if a.chunk is None:
            inner = math.prod(a.shape[1:]) * np.dtype(a.dtype).itemsize
            first, last = bounds[0] if bounds else (0, 1)
            if a.held:
                data = a.held[first * inner : last * inner]
            elif a.address == NOWHERE:
                return out
            else:
                data = self.read(a.address + first * inner, (last - first) * inner)
            rows = np.frombuffer(data, a.dtype).reshape((last - first, *a.shape[1:]) if bounds else ())
            out[...] = rows[(slice(None), *(slice(lo, hi) for lo, hi in bounds[1:]))] if bounds else rows
            return out
        for origin, mask, address, size in self.chunks(a, bounds):
            block = np.frombuffer(_unfiltered(self.read(address, size), a, mask), a.dtype).reshape(a.chunk)
            lo = [max(o, x) for o, (x, _) in zip(origin, bounds, strict=True)]
            hi = [min(o + c, y) for o, c, (_, y) in zip(origin, a.chunk, bounds, strict=True)]
            out[tuple(slice(x - b, y - b) for x, y, (b, _) in zip(lo, hi, bounds, strict=True))] = block[tuple(slice(x - o, y - o) for x, y, o in zip(lo, hi, origin, strict=True))]
        return out


def _link(body: bytes) -> tuple[str, int | None]:
    flags, at = body[1], 2
    kind = 0
    if flags & 8:
        kind, at = body[at], at + 1
    at += 8 * bool(flags & 4) + bool(flags & 16)
    width = 1 << (flags & 3)
    n, at = int.from_bytes(body[at : at + width], "little"), at + width
    name, at = body[at : at + n].decode(), at + n
    return name, struct.unpack_from("<Q", body, at)[0] if kind == 0 else None


def _dims(body: bytes) -> tuple[int, ...]:
    return struct.unpack_from(f"<{body[1]}Q", body, 8 if body[0] == 1 else 4)


def _dtype(body: bytes) -> str | None:
    kind, order, size = body[0] & 15, ">" if body[1] & 1 else "<", struct.unpack_from("<I", body, 4)[0]
    if kind == 0 and size in (1, 2, 4, 8):
        return f"{order}{'i' if body[1] & 8 else 'u'}{size}"
    return f"{order}f{size}" if kind == 1 and size in (2, 4, 8) else None


def _filters(body: bytes) -> tuple[tuple[int, tuple[int, ...]], ...]:
    if not body:
        return ()
    version, n, at, out = body[0], body[1], 8 if body[0] == 1 else 2, []
    for _ in range(n):
        kind = struct.unpack_from("<H", body, at)[0]
        at += 2
        name = 0
        if version == 1 or kind >= 256:
            name, at = struct.unpack_from("<H", body, at)[0], at + 2
        values = struct.unpack_from("<HH", body, at)[1]
        at += 4 + (-(-name // 8) * 8 if version == 1 else name)
        out.append((kind, struct.unpack_from(f"<{values}I", body, at)))
        at += 4 * values + (4 if version == 1 and values % 2 else 0)
    return tuple(out)


def _unfiltered(data: bytes, a: Array, mask: int) -> bytes:
    for k, (kind, values) in reversed([*enumerate(a.filters)]):
        if mask >> k & 1:
            continue
        if kind == DEFLATE:
            data = zlib.decompress(data)
        elif kind == SHUFFLE:
            size = values[0] if values else np.dtype(a.dtype).itemsize
            whole = len(data) // size * size
            data = np.frombuffer(data[:whole], np.uint8).reshape(size, -1).T.tobytes() + data[whole:]
        elif kind == FLETCHER:
            data = data[:-4]
        else:
            raise UnreadableError(f"filter {kind} isn't supported")
    return data


# ---------------------------------------------------------------- writing


class _Writer:
    """Pieces one behind another; addresses count from the superblock."""

    def __init__(self) -> None:
        self.data = bytearray(96)

    def put(self, piece: bytes) -> int:
        self.data += b"\0" * (-len(self.data) % 8)
        self.data += piece
        return len(self.data) - len(piece)


def _message(kind: int, body: bytes) -> bytes:
    body += b"\0" * (-len(body) % 8)
    return struct.pack("<HHB3x", kind, len(body), 0) + body


def _header(messages: Sequence[bytes]) -> bytes:
    body = b"".join(messages)
    return struct.pack("<BxHII4x", 1, len(messages), 1, len(body)) + body


def _type(dtype: np.dtype) -> bytes:
    size = dtype.itemsize
    if dtype.kind in "iu":
        return struct.pack("<BBBBIHH", 0x10, 8 if dtype.kind == "i" else 0, 0, 0, size, 0, 8 * size)
    mantissa, exponent = {2: (10, 5), 4: (23, 8), 8: (52, 11)}[size]
    return struct.pack("<BBBBIHHBBBBI", 0x11, 0x20, 8 * size - 1, 0, size, 0, 8 * size, mantissa, exponent, 0, mantissa, (1 << (exponent - 1)) - 1)


def _tree(out: _Writer, entries: list[tuple[bytes, int]], end: bytes, kind: int, fan: int) -> int:
    """Entries (key, child) as a tree of nodes with at most ``fan`` children; ``end`` is the last key."""
    level = 0
    while True:
        above = []
        for k in range(0, len(entries), fan):
            some = entries[k : k + fan]
            last = entries[k + fan][0] if k + fan < len(entries) else end
            node = b"TREE" + struct.pack("<BBHQQ", kind, level, len(some), NOWHERE, NOWHERE) + b"".join(key + struct.pack("<Q", child) for key, child in some) + last
            above.append((some[0][0], out.put(node)))
        if len(above) == 1:
            return above[0][1]
        entries, level = above, level + 1


def write_hdf5(path: str, variables: dict[str, np.ndarray], chunk: Sequence[int] | None = None, shuffle: bool = True, level: int = 4, user: int = 512, fan: int = 64) -> None:
    """Numeric arrays in the root group, in chunks or contiguous, behind a user block: as MATLAB lays out version 7.3."""
    out = _Writer()
    addresses = {}
    for name, a in variables.items():
        a = np.ascontiguousarray(a, a.dtype.newbyteorder("<"))
        found = [_message(DATASPACE, struct.pack(f"<BBB5x{a.ndim}Q", 1, a.ndim, 0, *a.shape)), _message(DATATYPE, _type(a.dtype))]
        if chunk is None:
            found.append(_message(LAYOUT, struct.pack("<BBQQ", 3, 1, out.put(a.tobytes()), a.nbytes)))
        else:
            entries = []
            for index in itertools.product(*(range(-(-n // c)) for n, c in zip(a.shape, chunk, strict=True))):
                origin = [i * c for i, c in zip(index, chunk, strict=True)]
                some, full = a[tuple(slice(o, o + c) for o, c in zip(origin, chunk, strict=True))], np.zeros(chunk, a.dtype)
                full[tuple(slice(0, n) for n in some.shape)] = some
                if not full.any():
                    continue  # absent chunks hold the fill value
                data = full.tobytes()
                if shuffle:
                    data = np.frombuffer(data, np.uint8).reshape(-1, a.itemsize).T.tobytes()
                data = zlib.compress(data, level)
                entries.append((struct.pack(f"<II{a.ndim + 1}Q", len(data), 0, *origin, 0), out.put(data)))
            tree = _tree(out, entries, struct.pack(f"<II{a.ndim + 1}Q", 0, 0, *(-(-n // c) * c for n, c in zip(a.shape, chunk, strict=True)), 0), 1, fan) if entries else NOWHERE
            found.append(_message(LAYOUT, struct.pack(f"<BBBQ{a.ndim}II", 3, 2, a.ndim + 1, tree, *chunk, a.itemsize)))
            filters = [struct.pack("<HHHHII", SHUFFLE, 0, 1, 1, a.itemsize, 0)] if shuffle else []
            filters.append(struct.pack("<HHHHII", DEFLATE, 0, 1, 1, level, 0))
            found.append(_message(FILTERS, struct.pack("<BB6x", 1, len(filters)) + b"".join(filters)))
        addresses[name] = out.put(_header(found))
    names, places = bytearray(8), {}
    for name in sorted(addresses):
        places[name] = len(names)
        names += name.encode() + b"\0" * (8 - len(name.encode()) % 8)
    heap = out.put(b"HEAP" + struct.pack("<B3xQQQ", 0, len(names), NOWHERE, out.put(bytes(names))))
    ordered = sorted(addresses)
    nodes = []
    for k in range(0, len(ordered), 8):
        some = ordered[k : k + 8]
        node = b"SNOD" + struct.pack("<BxH", 1, len(some)) + b"".join(struct.pack("<QQI4x16x", places[n], addresses[n], 0) for n in some)
        nodes.append((struct.pack("<Q", places[ordered[k - 1]] if k else 0), out.put(node)))
    tree = _tree(out, nodes, struct.pack("<Q", places[ordered[-1]]), 0, 32)
    root = out.put(_header([_message(SYMBOLS, struct.pack("<QQ", tree, heap))]))
    head = SIGNATURE + struct.pack("<8BHHI4Q", 0, 0, 0, 0, 0, 8, 8, 0, 4, 16, 0, user, NOWHERE, len(out.data), NOWHERE) + struct.pack("<QQI4xQQ", 0, root, 1, tree, heap)
    out.data[: len(head)] = head
    note = b"MATLAB 7.3 MAT-file".ljust(124) + struct.pack("<H", 0x0200) + b"IM" if user else b""
    files.write(path, note.ljust(user, b"\0") + bytes(out.data))
