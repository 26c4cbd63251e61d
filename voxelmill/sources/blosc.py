"""The Blosc container (version 1), as other software writes arrays by default: blocks of bytes, shuffled by element or
bit and compressed by LZ4, Zstandard, zlib, Snappy or BloscLZ. Written are LZ4, Zstandard and zlib."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa

#: Fixed values of the format: codecs by number, flags, and when a block is split into a stream for each byte of an element.
CODECS = {0: "blosclz", 1: "lz4", 2: "snappy", 3: "zlib", 4: "zstd"}
SHUFFLED, COPIED, BITS, WHOLE = 1, 2, 4, 16
HEAD, MOST_STREAMS, LEAST_STREAM = 16, 16, 128
#: Bytes of a block that is written.
BLOCK = 1 << 18


def _unpacked(codec: str, data: bytes, size: int) -> bytes:
    if codec == "lz4":
        return pa.Codec("lz4_raw").decompress(data, size, asbytes=True)
    if codec in ("snappy", "zstd"):
        return pa.Codec(codec).decompress(data, size, asbytes=True)
    return zlib.decompress(data) if codec == "zlib" else _blosclz(data, size)


def _blosclz(data: bytes, size: int) -> bytes:
    """Runs of literals, and copies of what lies up to 8191 bytes back or, behind a mark, further."""
    out, at = bytearray(), 0
    control = data[0] & 31
    at = 1
    while True:
        if control >= 32:
            n, far = (control >> 5) - 1, (control & 31) << 8
            if n == 6:
                while True:
                    n += (more := data[at])
                    at += 1
                    if more != 255:
                        break
            low = data[at]
            at += 1
            if low == 255 and far == 31 << 8:
                back = struct.unpack_from(">H", data, at)[0] + 8191 + 1
                at += 2
            else:
                back = far + low + 1
            n += 3
            if back >= n:
                out += out[len(out) - back : len(out) - back + n]
            else:  # it overlaps what it makes
                piece = bytes(out[len(out) - back :])
                out += (piece * (n // back + 1))[:n]
        else:
            out += data[at : at + control + 1]
            at += control + 1
        if at >= len(data):
            break
        control = data[at]
        at += 1
    if len(out) != size:
        raise ValueError("a damaged block")
    return bytes(out)


def _in_order(block: bytes, flags: int, item: int) -> bytes:
    """A block's bytes before they were shuffled; what is left over at the end wasn't."""
    if flags & SHUFFLED and item > 1:
        n = len(block) // item
        return np.frombuffer(block, np.uint8, n * item).reshape(item, n).T.tobytes() + block[n * item :]
    if flags & BITS:
        n = len(block) // item // 8 * 8
        bits = np.unpackbits(np.frombuffer(block, np.uint8, n * item).reshape(item * 8, n // 8), axis=1, bitorder="little")
        return np.packbits(bits.T.reshape(n, item * 8), axis=1, bitorder="little").tobytes() + block[n * item :]
    return block


def decompress(data: bytes) -> bytes:
    _, _, flags, item, size, block, total = struct.unpack_from("<BBBBIII", data)
    if total > len(data):
        raise ValueError("a Blosc container is cut short")
    if flags & COPIED:
        return data[HEAD : HEAD + size]
    if flags >> 5 not in CODECS:
        raise ValueError(f"Blosc codec {flags >> 5} isn't known")
    codec, out = CODECS[flags >> 5], []
    starts = struct.unpack_from(f"<{-(-size // block) if size else 0}I", data, HEAD)
    for k, at in enumerate(starts):
        own = min(block, size - k * block)
        split = not flags & WHOLE and 0 < item <= MOST_STREAMS and block // item >= LEAST_STREAM and own == block
        streams, got = (item if split else 1), []
        for _ in range(streams):
            n = struct.unpack_from("<i", data, at)[0]
            piece = data[at + 4 : at + 4 + n]
            got.append(piece if n == own // streams else _unpacked(codec, piece, own // streams))
            at += 4 + n
        out.append(_in_order(b"".join(got), flags, item))
    return b"".join(out)


def compress(data: bytes, item: int = 1, cname: str = "lz4", clevel: int = 5, shuffle: int = 1) -> bytes:
    """Blocks aren't split into streams, which every reader accepts. ``shuffle``: 0 none, 1 by element, 2 by bit."""
    number = {"lz4": 1, "lz4hc": 1, "zlib": 3, "zstd": 4}.get(cname)
    if number is None:
        raise ValueError(f"Blosc with {cname} isn't written here; lz4, zlib and zstd are")
    item = item if 0 < item < 256 else 1
    flags = number << 5 | WHOLE | (SHUFFLED if shuffle == 1 and item > 1 else BITS if shuffle == 2 else 0)
    block = max(item * 8, min(len(data), BLOCK) // (item * 8) * (item * 8))
    pack = {1: lambda b: pa.Codec("lz4_raw").compress(b, asbytes=True), 3: lambda b: zlib.compress(b, clevel), 4: lambda b: pa.Codec("zstd", max(1, clevel)).compress(b, asbytes=True)}[number]
    pieces, starts, at = [], [], HEAD + 4 * -(-len(data) // block)
    for k in range(0, len(data), block):
        own = data[k : k + block]
        whole = len(own) // item * item
        if flags & SHUFFLED:
            own = np.frombuffer(own, np.uint8, whole).reshape(-1, item).T.tobytes() + own[whole:]
        elif flags & BITS:
            n = len(own) // item // 8 * 8
            bits = np.unpackbits(np.frombuffer(own, np.uint8, n * item).reshape(n, item), axis=1, bitorder="little")
            own = np.packbits(bits.T.reshape(item * 8, n), axis=1, bitorder="little").tobytes() + own[n * item :]
        packed = pack(own)
        packed = packed if len(packed) < len(own) else own
        starts.append(at)
        pieces.append(struct.pack("<i", len(packed)) + packed)
        at += 4 + len(packed)
    if at >= len(data) + HEAD:
        return struct.pack("<BBBBIII", 2, 1, flags | COPIED, item, len(data), block, len(data) + HEAD) + data
    return struct.pack("<BBBBIII", 2, 1, flags, item, len(data), block, at) + struct.pack(f"<{len(starts)}I", *starts) + b"".join(pieces)
