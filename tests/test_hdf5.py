"""HDF5 arrays by byte ranges."""

import struct
import zlib

import numpy as np
import pytest

from tests.test_pipelines import BRAIN, check
from tests.test_regions import CUBE
from voxelmill.operators import grid
from voxelmill.pipelines import psoct
from voxelmill.sources import blocks, files, hdf5, mat


@pytest.mark.parametrize("dtype", ["uint8", "int16", "uint16", "int32", "int64", "float32", "float64"])
@pytest.mark.parametrize("options", [{}, {"chunk": (5, 7, 9)}, {"chunk": (4, 4, 4), "fan": 3}, {"chunk": (24, 20, 40), "shuffle": False}, {"user": 0}])
def test_boxes(tmp_path, dtype, options):
    a = (CUBE % 120).astype(dtype)
    path = str(tmp_path / "a.mat")
    hdf5.write_hdf5(path, {"b": a[:1, :1, :1], "a": a, **{f"v{k:02d}": np.arange(k + 1, dtype=dtype).reshape(1, 1, -1) for k in range(30)}}, **options)
    assert hdf5.is_hdf5(path)
    f = hdf5.File(path)
    assert list(f.members) == ["a", "b", *(f"v{k:02d}" for k in range(30))]
    x = f.array("a")
    assert (x.shape, np.dtype(x.dtype).name) == (a.shape, dtype)
    r = np.random.default_rng(0)
    for _ in range(20):
        lo = [int(r.integers(0, n)) for n in a.shape]
        hi = [int(r.integers(o + 1, n + 1)) for o, n in zip(lo, a.shape)]
        np.testing.assert_array_equal(f.box(x, list(zip(lo, hi))), a[tuple(slice(p, q) for p, q in zip(lo, hi))])
    assert (f.box(f.array("v29"), [(0, 1), (0, 1), (0, 30)]).ravel() == np.arange(30)).all()


def test_absent_chunks_are_zeros_and_only_wanted_ones_are_walked_to(tmp_path, monkeypatch):
    a = np.zeros((64, 32, 32), np.int16)
    a[::16, 3, 5] = 7
    path = str(tmp_path / "a.mat")
    hdf5.write_hdf5(path, {"a": a, "none": a * 0}, chunk=(2, 4, 4), fan=2)
    f = hdf5.File(path)
    assert (f.box(f.array("a"), [(0, 64), (0, 32), (0, 32)]) == a).all() and not f.box(f.array("none"), [(0, 64), (0, 32), (0, 32)]).any()
    hdf5.write_hdf5(path, {"a": a + 1}, chunk=(2, 4, 4), fan=8)
    f, seen = hdf5.File(path), []
    x, read = f.array("a"), hdf5.File.read
    monkeypatch.setattr(hdf5.File, "read", lambda self, address, size: seen.append(address) or read(self, address, size))
    assert (f.box(x, [(9, 10), (0, 5), (30, 32)]) == (a + 1)[9:10, :5, 30:32]).all()
    # 2048 chunks in 293 nodes of two reads each: two chunks, and the nodes between them in the order of rows
    assert len(seen) <= 30


def test_newer_structures(tmp_path):
    """Superblock 2, object headers 2 with a continuation, compact links, filters 2, Fletcher32, a compact array; non-arrays are left out."""
    out = bytearray(48)

    def put(x):
        out.extend(x)
        return len(out) - len(x)

    def message(kind, body):
        return struct.pack("<BHB", kind, len(body), 0) + body

    def header(*messages):
        body = b"".join(messages)
        return put(b"OHDR" + struct.pack("<BBI", 2, 2, len(body)) + body + b"\0" * 4)

    data = np.arange(12, dtype="<i4").reshape(3, 4)
    packed = put(zlib.compress(data.tobytes()) + b"\1\2\3\4")
    space = message(hdf5.DATASPACE, struct.pack("<BBBB2Q", 2, 2, 0, 1, 3, 4))
    kind = message(hdf5.DATATYPE, hdf5._type(data.dtype))
    size = len(zlib.compress(data.tobytes())) + 4
    tree = put(b"TREE" + struct.pack("<BBHQQ", 1, 0, 1, hdf5.NOWHERE, hdf5.NOWHERE) + struct.pack("<II3QQ", size, 0, 0, 0, 0, packed) + struct.pack("<II3Q", 0, 0, 3, 4, 0))
    more = put(b"OCHK" + message(hdf5.LAYOUT, struct.pack("<BBBQIII", 3, 2, 3, tree, 3, 4, 4)) + message(hdf5.FILTERS, struct.pack("<BB", 2, 2) + struct.pack("<HHHI", 1, 0, 1, 6) + struct.pack("<HHH", 3, 0, 0)) + b"\0" * 4)
    a = header(space, kind, message(hdf5.CONTINUED, struct.pack("<QQ", more, len(out) - more)))
    compact = header(space, kind, message(hdf5.LAYOUT, struct.pack("<BBH", 3, 0, data.nbytes) + data.tobytes()))
    text = header(space, message(hdf5.DATATYPE, struct.pack("<BBBBI", 0x13, 0, 0, 0, 8)), message(hdf5.LAYOUT, struct.pack("<BBQQ", 3, 1, 0, 0)))
    link = lambda name, address: message(hdf5.LINK, struct.pack("<BBB", 1, 0, len(name)) + name + struct.pack("<Q", address))
    soft = message(hdf5.LINK, struct.pack("<BBBB", 1, 8, 1, 4) + b"soft" + struct.pack("<H", 1) + b"a")
    root = header(link(b"a", a), link(b"c", compact), link(b"t", text), soft)
    out[:48] = hdf5.SIGNATURE + struct.pack("<BBBB4QI", 2, 8, 8, 0, 0, hdf5.NOWHERE, len(out), root, 0)
    path = str(tmp_path / "n.h5")
    files.write(path, bytes(out))
    f = hdf5.File(path)
    assert list(f.members) == ["a", "c", "t"] and f.array("t") is None
    for name in "ac":
        assert (f.box(f.array(name), [(1, 3), (0, 3)]) == data[1:3, :3]).all()
    assert mat.MatFormat(path, {"key": "c"}).info().shape == (3, 4)
    with pytest.raises(ValueError, match="numeric"):
        mat.MatFormat(path, {"key": "t"}).info()
    with pytest.raises(hdf5.UnreadableError):
        hdf5.File(__file__)


def test_chunks_are_read_by_several_tasks(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "v.mat")
    hdf5.write_hdf5(path, {"_hidden": CUBE[:1], "volume": CUBE}, chunk=(4, 5, 8))
    df, info = blocks.opened(spark, "mat", path, maxLoad=8)
    assert info.shape == CUBE.shape and info.extra["cell"] == [8, 5, 8]
    assert df.rdd.getNumPartitions() == 60
    got = grid.unpack(df, "int32").toPandas()
    assert (CUBE[got.z, got.y, got.x] == got.v).all() and len(got) == CUBE.size
    where = blocks.voxels(spark, "mat", path, key="volume").where("z = 5 and x < 3")
    assert sorted(r["v"] for r in where.collect()) == sorted(CUBE[5, :, :3].ravel().tolist())


@pytest.mark.parametrize("chunk", [None, (32, 64, 4)])
def test_psoct_of_version_73(spark, tmp_path, chunk):
    hdf5.write_hdf5(str(tmp_path / "v.mat"), {"volume": BRAIN.transpose(2, 1, 0)}, chunk=chunk)
    w = psoct.single_volume(spark, str(tmp_path / "v.mat"), key="volume", out=str(tmp_path / "out.zarr"), chunk=(64,))
    check(w, BRAIN.transpose(2, 1, 0))
    for k in range(3):
        hdf5.write_hdf5(str(tmp_path / f"s{k}.mat"), {"a": BRAIN[k]}, chunk=None if chunk is None else (50, 60))
    w = psoct.multi_slice(spark, [str(tmp_path / f"s{k}.mat") for k in range(3)], key="a", out=str(tmp_path / "o.zarr"), chunk=(64,))
    check(w, np.stack(BRAIN[:3], -1))
