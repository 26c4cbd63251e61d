"""Comparison by digests, images in strips, attributes under several writers, inventories of very many names."""

import multiprocessing
import os
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_regions import CUBE, boxes, damage, make
from voxelmill.operators import digests, tiles
from voxelmill.pipelines import lsm
from voxelmill.plans.config import ArrayOptions
from voxelmill.sinks import extras, regions
from voxelmill.sinks import zarr as sink
from voxelmill.sources import files, zarr


def test_only_boxes_that_differ_are_read(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    other = CUBE.copy()
    other[5, 3, 7], other[23, 19, 39] = -1, -2
    make(spark, a, CUBE, (4, 10, 10))
    make(spark, b, other, (4, 10, 10), compressor="zlib")
    cells = digests.differing(digests.tree(spark, a), digests.tree(spark, b))
    assert sorted(map(tuple, cells.collect())) == [("", 8), ("", 47)]
    # 46 of 48 files of each could not be read any more
    for path in (a, b):
        assert damage(path, {"c/1/0/0", "c/5/1/3"}) == 46
    got = digests.voxels_of(cells, a, b, "zyx").drop("array").collect()
    assert sorted(map(tuple, got)) == [(5, 3, 7, CUBE[5, 3, 7], -1), (23, 19, 39, CUBE[23, 19, 39], -2)]


def test_trees_of_groups(spark, tmp_path):
    o = ArrayOptions(compressor="none")
    for name, options in (("a", {}), ("b", {"zarr_version": 2, "compressor": "zlib"})):
        sink.create_group(str(tmp_path / name), o)
        for level in range(2):
            make(spark, str(tmp_path / name / str(level)), CUBE[:: 2**level, :: 2**level, :: 2**level], (3, 4, 5), **options)
    a, b = (digests.tree(spark, str(tmp_path / n)) for n in ("a", "b"))
    # 8 * 5 * 8 boxes and 4 * 3 * 4 boxes, and their nodes up to one each
    assert sorted(map(tuple, a.groupBy("array", "level").count().collect())) == [("0", 0, 320), ("0", 1, 40), ("0", 2, 5), ("0", 3, 1), ("1", 0, 48), ("1", 1, 6), ("1", 2, 1), ("1", 3, 1)]
    assert digests.root(a) == digests.root(b) and digests.differing(a, b).collect() == []
    regions.write_region(str(tmp_path / "b" / "1"), boxes(spark, ((0, 0, 0), CUBE[:1, :1, :1] + 1)))
    assert digests.root(digests.tree(spark, str(tmp_path / "b"))) != digests.root(b)
    assert sorted(map(tuple, digests.differing(a, digests.tree(spark, str(tmp_path / "b"))).collect())) == [("1", 0)]
    make(spark, str(tmp_path / "b" / "2"), CUBE[:2, :2, :2], (2, 2, 2))
    assert ("2", 0) in map(tuple, digests.differing(a, digests.tree(spark, str(tmp_path / "b"))).collect())
    with pytest.raises(ValueError, match="different shapes"):
        digests.voxels_of(digests.differing(a, b), str(tmp_path / "a" / "0"), str(tmp_path / "b" / "1"), "zyx")


def test_nan_is_nan(spark, tmp_path):
    x = np.array([[1, np.nan], [np.nan, 4]], np.float32)
    y = np.array([[1, np.nan], [2, 4]], np.float32)
    make(spark, str(tmp_path / "a"), x, (2, 1))
    make(spark, str(tmp_path / "b"), y, (1, 2))
    assert [r["right"] for r in digests.stored_diff(spark, str(tmp_path / "a"), str(tmp_path / "b"), "yx").collect()] == [2.0]


# ---------------------------------------------------------------- images


def test_checksums_of_pieces():
    r = np.random.default_rng(0)
    for a, b in ((0, 0), (0, 7), (5, 0), (70_000, 1), (3, 200_000)):
        x, y = r.integers(0, 256, a, np.uint8).tobytes(), r.integers(0, 256, b, np.uint8).tobytes()
        assert extras.joined_adler(zlib.adler32(x), zlib.adler32(y), b) == zlib.adler32(x + y)


def _decoded(path, height, width):
    """As any decoder would: all IDAT pieces as one stream, with its checksum."""
    data, at, packed = files.read(path), 8, b""
    while at < len(data):
        n, kind = struct.unpack_from(">I4s", data, at)
        assert struct.unpack_from(">I", data, at + 8 + n)[0] == zlib.crc32(data[at + 4 : at + 8 + n])
        packed += data[at + 8 : at + 8 + n] if kind == b"IDAT" else b""
        at += 12 + n
    raw = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(height, -1)
    assert not raw[:, 0].any()
    return np.ascontiguousarray(raw[:, 1:]).view(">u2")


@pytest.mark.parametrize("rows", [None, 1, 7, 500])
def test_images_in_strips(spark, tmp_path, rows):
    path = str(tmp_path / "m.png")
    parts = [((z, y, 0), CUBE[z : z + 5, y : y + 6].astype(np.uint16)) for z in range(0, 24, 5) for y in range(0, 12, 6)]
    want = CUBE.max(0).astype(np.uint16)
    want[12:] = 0  # strips without any block are black
    extras.write_projection(path, boxes(spark, *parts), CUBE.shape, "uint16", rows)
    assert (_decoded(path, 20, 40) == want).all()
    got = np.zeros((20, 40), int)
    for y, x, v in extras.read_image(spark, path).collect():
        got[y, x] = v
    assert (got == want).all() and os.listdir(tmp_path) == ["m.png"]


# ---------------------------------------------------------------- attributes


def _write(path, first):
    for k in range(first, first + 25):
        sink.update_attributes(path, {f"k{k}": k})


@pytest.mark.parametrize("version", [2, 3])
def test_writers_at_once_lose_no_key(tmp_path, version):
    path = str(tmp_path / "g")
    sink.create_group(path, ArrayOptions(zarr_version=version))
    work = [multiprocessing.get_context("fork").Process(target=_write, args=(path, 25 * k)) for k in range(4)]
    for p in work:
        p.start()
    for p in work:
        p.join(60)
    assert zarr.attributes(path) == {f"k{k}": k for k in range(100)}
    assert not [n for n in os.listdir(path) if "claim" in n or "part" in n]


def test_claims_of_the_dead_expire(tmp_path):
    path = str(tmp_path / "c")
    assert files.claim(path, 60) and not files.claim(path, 60)
    os.utime(path, (0, 0))
    assert files.claim(path, 60) and not files.claim(path, 60)


# ---------------------------------------------------------------- inventories


def test_a_hundred_thousand_names(spark, tmp_path):
    """Listed, parsed, checked and placed in tables."""
    for y in range(400):
        for z in range(250):
            (tmp_path / f"t_y{y + 1:03d}_z{z + 1:03d}.tiff").touch()
    (tmp_path / "other.txt").touch()
    names = lsm.listing(spark, str(tmp_path), "*_y*_z*.tiff")
    t = tiles.parsed(names.withColumn("stem", F.regexp_replace("name", r"\.tiff$", "")), "stem", "multi_slice")
    t = t.withColumns({"path": F.concat_ws("/", "folder", "name"), "sz": F.lit(2).cast("long"), "sy": F.lit(64).cast("long"), "sx": F.lit(96).cast("long"), "dtype": F.lit("uint16")})
    t = tiles.bounded(t.select("name", "path", "y", "z", "sz", "sy", "sx", "dtype"))
    assert t.count() == 100_000 and lsm.check(t) == "uint16"
    v = lsm.assembled(t, "tiff", 6, "uint16")
    assert v.shape == [500, 400 * 64 - 399 * 6, 96]
