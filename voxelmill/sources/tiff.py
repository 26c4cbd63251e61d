"""TIFF files: grey or multi-sample pages in strips or tiles, also in 64-bit form; plain or compressed by
deflate, LZW, PackBits or Zstandard, with or without differences of neighbours."""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

from voxelmill.sources import files
from voxelmill.sources.blocks import BlockSource, Bounds, Format, Info, Part

#: Fixed values of the format: bytes of a field type, tags, sample formats.
SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8, 13: 4, 16: 8, 17: 8, 18: 8}
CODES = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 13: "I", 16: "Q", 17: "q", 18: "Q"}
WIDTH, HEIGHT, BITS, COMPRESSION, OFFSETS, SAMPLES, ROWS, COUNTS, PLANAR, PREDICTOR, FORMAT = 256, 257, 258, 259, 273, 277, 278, 279, 284, 317, 339
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS = 322, 323, 324, 325
NONE, LZW, DEFLATE, PACKBITS, OLD_DEFLATE, ZSTD = 1, 5, 8, 32773, 32946, 50000
KINDS = {1: "u", 2: "i", 3: "f"}


@dataclass(frozen=True)
class Page:
    height: int
    width: int
    samples: int
    dtype: str
    compression: int
    predictor: int
    offsets: tuple[int, ...]
    counts: tuple[int, ...]
    cell: tuple[int, int]  # rows and columns of a strip or tile

    @property
    def shape(self) -> tuple[int, ...]:
        return (self.height, self.width) + ((self.samples,) if self.samples > 1 else ())


def pages(path: str) -> list[Page]:
    """Headers only."""
    head = files.read(path, 0, 16)
    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    magic = struct.unpack_from(f"{order}H", head, 2)[0] if order else 0
    if magic not in (42, 43):
        raise ValueError(f"no TIFF file: {path}")
    big = magic == 43
    at = struct.unpack_from(f"{order}{'Q' if big else 'I'}", head, 8 if big else 4)[0]
    out = []
    while at:
        count = struct.unpack(f"{order}{'Q' if big else 'H'}", files.read(path, at, 8 if big else 2))[0]
        at += 8 if big else 2
        width, room = (20, 8) if big else (12, 4)
        table = files.read(path, at, count * width + room)
        tags: dict[int, tuple[int, ...]] = {}
        for k in range(count):
            tag, kind = struct.unpack_from(f"{order}HH", table, k * width)
            n = struct.unpack_from(f"{order}{'Q' if big else 'I'}", table, k * width + 4)[0]
            if kind not in CODES:
                continue
            size, value = SIZES[kind] * n, table[k * width + width - room : (k + 1) * width]
            if size > room:
                value = files.read(path, struct.unpack(f"{order}{'Q' if big else 'I'}", value)[0], size)
            tags[tag] = struct.unpack(f"{order}{n}{CODES[kind]}", value[:size])
        one = lambda t, d: tags.get(t, (d,))[0]  # noqa: E731, B023
        dtype = f"{order}{KINDS.get(one(FORMAT, 1), 'u')}{one(BITS, 8) // 8}"
        if one(COMPRESSION, NONE) not in (NONE, LZW, DEFLATE, PACKBITS, OLD_DEFLATE, ZSTD):
            raise ValueError(f"TIFF compression {one(COMPRESSION, NONE)} isn't supported: {path}")
        if one(PREDICTOR, 1) not in (1, 2) or one(PLANAR, 1) != 1 and one(SAMPLES, 1) > 1 or one(BITS, 8) % 8:
            raise ValueError(f"this layout of samples isn't supported: {path}")
        height, columns = one(HEIGHT, 0), one(WIDTH, 0)
        tiled = TILE_WIDTH in tags
        cell = (one(TILE_HEIGHT, 0), one(TILE_WIDTH, 0)) if tiled else (min(one(ROWS, height), height), columns)
        offsets, counts = (tags.get(t, ()) for t in ((TILE_OFFSETS, TILE_COUNTS) if tiled else (OFFSETS, COUNTS)))
        out.append(Page(height, columns, one(SAMPLES, 1), dtype, one(COMPRESSION, NONE), one(PREDICTOR, 1), offsets, counts, cell))
        at = struct.unpack(f"{order}{'Q' if big else 'I'}", table[-room:])[0]
    return out


def unpacked_bits(data: bytes) -> bytes:
    """PackBits: a count, then so many bytes, or one byte so many times."""
    out, at = bytearray(), 0
    while at < len(data):
        n = data[at]
        if n < 128:
            out += data[at + 1 : at + 2 + n]
            at += n + 2
        else:
            if n > 128:
                out += data[at + 1 : at + 2] * (257 - n)
            at += 2
    return bytes(out)


CLEAR, END = 256, 257


def lzw_codes(data: np.ndarray, at: int, many: int) -> tuple[np.ndarray, int]:
    """Up to ``many`` codes of 9 to 12 bits from a bit on, as they follow a clear code, and the bit after them.
    The n-th code's width depends on n alone; codes grow one entry before the table is full. ``data`` has three
    more bytes at its end."""
    width = np.clip(np.floor(np.log2(np.arange(258, 258 + many))).astype(np.int64) + 1, 9, 12)
    ends = at + np.cumsum(width)
    width = width[: np.searchsorted(ends, (len(data) - 3) * 8, "right")]
    first = ends[: len(width)] - width
    byte = first >> 3
    window = data[byte].astype(np.int64) << 16 | data[byte + 1].astype(np.int64) << 8 | data[byte + 2]
    return window >> (24 - (first & 7) - width) & ((1 << width) - 1), int(ends[len(width) - 1]) if len(width) else at


def lzw_bytes(code: np.ndarray) -> np.ndarray:
    """What codes between two clear codes stand for. Entry e of the table is what code e stands for and the next
    byte of the output, so a code that names it repeats a stretch of the output: every byte points at an
    earlier one, and pointers are followed to a literal by doubling."""
    literal = code < CLEAR
    if not (literal | (code - 257 <= np.arange(len(code)))).all() or not literal[:1].all():
        raise ValueError("an LZW code names an entry that isn't there")
    entry = np.where(literal, np.arange(len(code)), code - 258)
    steps, up = np.where(literal, 0, 1), entry
    while (up != up[up]).any():
        steps, up = steps + steps[up], up[up]
    size = steps + 1
    start = np.cumsum(size) - size
    source = (np.arange(int(size.sum())) + np.repeat(start[entry] - start, size)).astype(np.int32 if size.sum() < 1 << 31 else np.int64)
    while ((further := source[source]) != source).any():
        source = further
    out = np.zeros(len(source), np.uint8)
    out[start[literal]] = code[literal]
    return out[source]


def unpacked_lzw(data: bytes) -> bytes:
    """Stretches between clear codes, each unpacked as a whole."""
    padded, out, at, many = np.frombuffer(data + bytes(3), np.uint8), [], 0, 1 << 12
    while True:
        code, after = lzw_codes(padded, at, many)
        stops = np.flatnonzero((code == CLEAR) | (code == END))
        if not len(stops) and len(code) == many:
            many *= 2
            continue
        upto = int(stops[0]) if len(stops) else len(code)
        out.append(lzw_bytes(code[:upto]).tobytes())
        if not len(stops) or code[upto] == END:
            return b"".join(out)
        at, many = lzw_codes(padded, at, upto + 1)[1], 1 << 12


def _zstd(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompressobj().decompress(data)


DECODERS = {NONE: bytes, LZW: unpacked_lzw, DEFLATE: zlib.decompress, OLD_DEFLATE: zlib.decompress, PACKBITS: unpacked_bits, ZSTD: _zstd}


def read_page(path: str, p: Page) -> np.ndarray:
    out = np.zeros((p.height, p.width, p.samples), np.dtype(p.dtype).newbyteorder("="))
    (h, w), across = p.cell, -(-p.width // p.cell[1])
    first, last = (min(p.offsets), max(o + n for o, n in zip(p.offsets, p.counts, strict=True))) if p.offsets else (0, 0)
    # strips that lie next to one another are read at once
    near = files.read(path, first, last - first) if last - first <= 2 * sum(p.counts) else None
    for k, (o, n) in enumerate(zip(p.offsets, p.counts, strict=True)):
        y, x = k // across * h, k % across * w
        rows = h if p.cell[1] != p.width else min(h, p.height - y)
        data = DECODERS[p.compression](files.read(path, o, n) if near is None else near[o - first : o - first + n])
        a = np.frombuffer(data, p.dtype, rows * w * p.samples).reshape(rows, w, p.samples).astype(out.dtype)
        if p.predictor == 2:
            a = np.cumsum(a, axis=1, dtype=a.dtype)
        out[y : y + rows, x : x + w] = a[: p.height - y, : p.width - x]
    return out.reshape(p.shape)


class TiffFormat(Format):
    """Axes: page, row, column (and sample). All pages must be alike."""

    def info(self) -> Info:
        found = pages(self.path)
        if len({(p.shape, p.dtype) for p in found}) != 1:
            raise ValueError(f"pages of different sizes: {self.path}")
        return Info((len(found), *found[0].shape), np.dtype(found[0].dtype).name, {"pages": found})

    def parts(self, info: Info) -> list[Part]:
        step = max(1, (16 << 20) // max(1, int(np.prod(info.shape[1:])) * np.dtype(info.dtype).itemsize))
        return [Part((k, *[0] * (len(info.shape) - 1)), (min(step, info.shape[0] - k), *info.shape[1:])) for k in range(0, info.shape[0], step)]

    def load_box(self, info: Info, part: Part, bounds: Bounds) -> tuple[list[int], np.ndarray]:
        """Only the pages within the bounds are read."""
        lo, hi = max(part.origin[0], bounds[0][0]), min(part.origin[0] + part.shape[0], bounds[0][1])
        return super().load_box(info, Part((lo, *part.origin[1:]), (max(0, hi - lo), *part.shape[1:])), bounds)

    def load(self, info: Info, part: Part) -> np.ndarray:
        first = part.origin[0]
        return np.stack([read_page(self.path, p) for p in info.extra["pages"][first : first + part.shape[0]]])


class TiffSource(BlockSource):
    kind, short = TiffFormat, "tiff"


def packed_bits(data: bytes) -> bytes:
    """Runs of three bytes and more are counted, the rest is copied."""
    out, at = bytearray(), 0
    while at < len(data):
        n = 1
        while n < 128 and data[at + n : at + n + 1] == data[at : at + 1]:
            n += 1
        if n > 2:
            out += bytes([257 - n]) + data[at : at + 1]
            at += n
            continue
        stop = at + n
        while stop < len(data) and stop - at < 128 and not (data[stop] == data[stop - 1] == data[stop - 2]):
            stop += 1
        out += bytes([stop - at - 1]) + data[at:stop]
        at = stop
    return bytes(out)


def packed_lzw(data: bytes) -> bytes:
    held, bits, out = 0, 0, bytearray()

    def put(code: int, width: int) -> None:
        nonlocal held, bits
        held, bits = held << width | code, bits + width
        while bits >= 8:
            bits -= 8
            out.append(held >> bits)
            held &= (1 << bits) - 1

    fresh = {bytes([k]): k for k in range(256)}
    table, width, last = dict(fresh), 9, b""
    put(CLEAR, 9)
    for k in range(len(data)):
        more = last + data[k : k + 1]
        if more in table:
            last = more
            continue
        put(table[last], width)
        table[more] = len(table) + 2
        width = (len(table) + 2).bit_length()
        if len(table) + 2 >= 4094:
            put(CLEAR, 12)
            table, width = dict(fresh), 9
        last = data[k : k + 1]
    if last:
        put(table[last], width)
        width = min(12, (len(table) + 3).bit_length())
    put(END, width)
    put(0, -bits % 8)
    return bytes(out)


def _zstd_packed(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor().compress(data)


ENCODERS = {NONE: bytes, LZW: packed_lzw, DEFLATE: zlib.compress, PACKBITS: packed_bits, ZSTD: _zstd_packed}


def write_tiff(path: str, stack: np.ndarray, compression: int = NONE, predictor: int = 1, cell: tuple[int, int] | None = None) -> None:
    """Pages (page, row, column) of a numeric array, in strips of so many rows, or in tiles if a cell isn't as
    wide as the page."""
    stack = stack[None] if stack.ndim == 2 else stack
    kind = {"u": 1, "i": 2, "f": 3}[stack.dtype.kind]
    data = stack.astype(stack.dtype.newbyteorder("<"))
    (height, width), (h, w) = stack.shape[1:], cell or stack.shape[1:]
    tiled = w != width
    out = bytearray(struct.pack("<2sHI", b"II", 42, 8))
    for k, page in enumerate(data):
        pieces = []
        for y in range(0, height, h):
            for x in range(0, width, w):
                a = page[y : y + h, x : x + w]
                if tiled:
                    a = np.pad(a, ((0, h - a.shape[0]), (0, w - a.shape[1])))
                if predictor == 2:
                    a = np.diff(a, axis=1, prepend=a.dtype.type(0))
                pieces.append(ENCODERS[compression](a.astype(data.dtype).tobytes()))
        n = len(pieces)
        where, counts = (TILE_OFFSETS, TILE_COUNTS) if tiled else (OFFSETS, COUNTS)
        size = [(TILE_WIDTH, 4, w), (TILE_HEIGHT, 4, h)] if tiled else [(ROWS, 4, h)]
        tags = [(WIDTH, 4, width), (HEIGHT, 4, height), (BITS, 3, page.itemsize * 8), (COMPRESSION, 3, compression), (PREDICTOR, 3, predictor), (FORMAT, 3, kind), *size, (where, 4, None), (counts, 4, None)]
        at = len(out)
        lists = at + 2 + len(tags) * 12 + 4
        body = lists + (8 * n if n > 1 else 0)
        starts = [body + sum(map(len, pieces[:j])) for j in range(n)]
        values = {where: starts, counts: [len(x) for x in pieces]}
        places = {where: lists, counts: lists + 4 * n}
        out += struct.pack("<H", len(tags))
        for t, c, v in sorted(tags):
            out += struct.pack("<HHII", t, c, 1 if v is not None else n, v if v is not None else places[t] if n > 1 else values[t][0])
        stop = starts[-1] + len(pieces[-1])
        stop += stop % 2
        out += struct.pack("<I", stop if k + 1 < len(data) else 0)
        if n > 1:
            out += struct.pack(f"<{2 * n}I", *starts, *values[counts])
        out += b"".join(pieces)
        out += b"\0" * (stop - len(out))
    files.write(path, bytes(out))
