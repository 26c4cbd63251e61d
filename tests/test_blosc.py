"""The Blosc container: round trips, and containers put together here as other writers make them."""

import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.test_regions import CUBE, array, make
from voxelmill.sources import blosc

R = np.random.default_rng(2)
DATA = {
    "smooth": np.cumsum(R.integers(-3, 4, 200_003)).astype("<i4").tobytes(), "noise": R.bytes(70_001), "zeros": bytes(900_000), "short": b"abcdefg", "empty": b"",
    "floats": np.linspace(0, 1, 99_999).astype("<f8").tobytes(), "long": np.arange(1 << 18, dtype="<u2").tobytes() + b"xyz",
}


@pytest.mark.parametrize("data", DATA)
@pytest.mark.parametrize("cname", ["lz4", "zstd", "zlib"])
@pytest.mark.parametrize("item,shuffle", [(1, 0), (1, 2), (2, 1), (4, 1), (4, 2), (8, 1), (8, 2), (12, 1)])
def test_round_trips(data, cname, item, shuffle):
    packed = blosc.compress(DATA[data], item, cname, 5, shuffle)
    assert blosc.decompress(packed) == DATA[data] and struct.unpack_from("<I", packed, 12)[0] == len(packed)
    assert len(packed) <= len(DATA[data]) + blosc.HEAD


@pytest.mark.parametrize("codec,pack", [(1, lambda b: pa.Codec("lz4_raw").compress(b, asbytes=True)), (2, lambda b: pa.Codec("snappy").compress(b, asbytes=True)), (3, zlib.compress), (4, lambda b: pa.Codec("zstd").compress(b, asbytes=True))])
def test_blocks_split_into_streams(codec, pack):
    """A stream for each byte of an element, but not in a last block that is shorter; streams that don't shrink are kept."""
    data, item, block = DATA["smooth"][:100_000], 4, 16_384
    out, starts = b"", []
    count = -(-len(data) // block)
    for k in range(0, len(data), block):
        own = data[k : k + block]
        starts.append(16 + 4 * count + len(out))
        shuffled = np.frombuffer(own, np.uint8).reshape(-1, item).T.tobytes()
        streams = item if len(own) == block else 1
        for s in range(streams):
            piece = shuffled[s * len(own) // streams : (s + 1) * len(own) // streams]
            packed = pack(piece)
            packed = packed if len(packed) < len(piece) else piece
            out += struct.pack("<i", len(packed)) + packed
    head = struct.pack("<BBBBIII", 2, 1, codec << 5 | 1, item, len(data), block, 16 + 4 * count + len(out))
    assert blosc.decompress(head + struct.pack(f"<{count}I", *starts) + out) == data


def test_blosclz():
    """Literals, short and long copies, copies that overlap themselves, and one from far away."""
    far = R.bytes(9_000)
    data = b"\x04abcde" + bytes([2 << 5 | 0, 4])  # five literals, then four bytes from five back
    assert blosc._blosclz(data, 9) == b"abcdeabcd"
    assert blosc._blosclz(b"\x00z" + bytes([7 << 5, 10, 0]), 1 + 6 + 10 + 3) == b"z" * 20
    packed = b"".join(bytes([len(far[k : k + 32]) - 1]) + far[k : k + 32] for k in range(0, len(far), 32))
    packed += bytes([7 << 5 | 31, 255, 246, 255]) + struct.pack(">H", 8_500 - 8_192)
    assert blosc._blosclz(packed, 9_000 + 6 + 255 + 246 + 3) == far + far[500 : 500 + 510]
    with pytest.raises(ValueError, match="damaged"):
        blosc._blosclz(b"\x04abcde", 9)


def test_damaged_containers():
    packed = blosc.compress(DATA["smooth"], 4)
    with pytest.raises(ValueError, match="cut short"):
        blosc.decompress(packed[:-1])
    with pytest.raises(ValueError, match="isn't known"):
        blosc.decompress(packed[:2] + bytes([7 << 5]) + packed[3:])
    with pytest.raises(ValueError, match="isn't written"):
        blosc.compress(b"x", cname="blosclz")


@pytest.mark.parametrize("options", [{"zarr_version": 2}, {}, {"shard": (8, 20, 20)}, {"compressor_opt": {"cname": "zstd", "shuffle": "bitshuffle"}}])
def test_arrays(spark, tmp_path, options):
    make(spark, str(tmp_path / "a"), CUBE, (4, 10, 10), compressor="blosc", **options)
    assert (array(str(tmp_path / "a")) == CUBE).all()
