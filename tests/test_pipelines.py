"""Conversions end to end against numpy, on volumes of the sizes that the formats' own tests use."""

import json
import math

import numpy as np
import pytest

from voxelmill.pipelines import cli, df, lsm, psoct, wk
from voxelmill.sources import files, mat, nifti, spool, tiff, wkw, zarr
from voxelmill.sources.blocks import opened

BRAIN = (np.random.default_rng(4).integers(0, 900, (10, 256, 256)) + np.arange(256)[None, None]).astype(np.uint16)


def stored(path, level=0):
    a = zarr.opened(f"{path}/{level}")
    cells = np.ndindex(*(math.ceil(s / c) for s, c in zip(a.shape, a.chunk)))
    out = np.zeros(a.shape, a.dtype.newbyteorder("="))
    for i in cells:
        block = a.load(i)
        out[tuple(slice(k * c, k * c + n) for k, c, n in zip(i, a.chunk, block.shape))] = block
    return out


def pooled(a, keep=()):
    f = [1 if k in keep or n == 1 or (a.ndim == 4 and k == 0) else 2 for k, n in enumerate(a.shape)]
    a = a[tuple(slice(0, n // k * k) for n, k in zip(a.shape, f))]
    shape = [m for n, k in zip(a.shape, f) for m in (n // k, k)]
    return np.trunc(a.reshape(shape).mean(tuple(range(1, 2 * a.ndim, 2)))).astype(a.dtype)


def check(written, want, keep=()):
    assert written.shapes[0] == list(want.shape)
    assert (stored(written.path) == want).all()
    for level in range(1, len(written.shapes)):
        want = pooled(want, keep)
        assert (stored(written.path, level) == want).all(), level


@pytest.mark.parametrize("version,shard", [(2, None), (3, None), (3, (128,)), (3, "auto")])
def test_psoct_single_volume(spark, tmp_path, version, shard):
    mat.write_mat(str(tmp_path / "v.mat"), {"volume": BRAIN.transpose(2, 1, 0)})
    (tmp_path / "meta.txt").write_text("Voxel size: 3x3x2um\nModality: dBI\n")
    out = str(tmp_path / "out.zarr")
    w = psoct.single_volume(spark, str(tmp_path / "v.mat"), key="volume", meta=str(tmp_path / "meta.txt"), out=out, chunk=(64,), shard=shard, zarr_version=version)
    check(w, BRAIN.transpose(2, 1, 0))
    assert len(w.shapes) == 3
    scales = zarr.attributes(out)["multiscales"][0]["datasets"][1]["coordinateTransformations"]
    assert scales[0]["scale"] == [4.0, 6.0, 6.0] and scales[1]["translation"] == [1.0, 1.5, 1.5]
    h = nifti.load_header(out)
    assert h.shape == (10, 256, 256) and h.dtype == "uint16" and h.space_unit == "micron"
    assert json.loads(files.read(str(tmp_path / "out.json")))["PixelSize"] == [3, 3, 2]


def test_psoct_multi_slice(spark, tmp_path):
    paths = []
    for k in range(5):
        paths.append(str(tmp_path / f"slice_{k:03d}.mat"))
        mat.write_mat(paths[-1], {"a": BRAIN[k]})
    w = psoct.multi_slice(spark, paths, key="a", out=str(tmp_path / "o.zarr"), chunk=(64,), dtype="int32")
    check(w, np.stack(BRAIN[:5], -1).astype(np.int32))


def test_lsm_single_volume(spark, tmp_path):
    tiff.write_tiff(str(tmp_path / "s.tiff"), BRAIN)
    check(lsm.single_volume(spark, str(tmp_path / "s.tiff"), out=str(tmp_path / "o.zarr"), chunk=(64,), compressor="gzip"), BRAIN)


def test_lsm_mosaic(spark, tmp_path):
    data = np.random.default_rng(1).integers(0, 999, (3, 2, 5, 4, 32, 48)).astype(np.uint16)
    for z in range(5):
        for y in range(4):
            for p in range(2):
                for c in range(3):
                    tiff.write_tiff(str(tmp_path / f"in/t_z{z + 1}_y{y + 1}/t_z{z + 1}_y{y + 1}_plane{p + 1}_c{c + 1}.tiff"), data[c, p, z, y])
    want = data.transpose(0, 2, 1, 3, 4, 5).reshape(3, 10, 128, 48)
    w = lsm.mosaic(spark, str(tmp_path / "in"), out=str(tmp_path / "o.zarr"), chunk=(32,), voxel_size=(1, 2, 3))
    check(w, want)
    assert zarr.attributes(w.path)["multiscales"][0]["datasets"][0]["coordinateTransformations"][0]["scale"] == [1.0, 3.0, 2.0, 1.0]


@pytest.mark.parametrize("overlap", [0, 6, 5])
def test_lsm_multi_slice_overlap(spark, tmp_path, overlap):
    whole = BRAIN[:, : 64 * 3 - 2 * overlap, :96]
    for y in range(3):
        for z in range(5):
            a = y * (64 - overlap)
            tiff.write_tiff(str(tmp_path / f"in/t_y{y + 1:02d}_z{z + 1:02d}.tiff"), whole[2 * z : 2 * z + 2, a : a + 64])
    check(lsm.multi_slice(spark, str(tmp_path / "in"), overlap=overlap, out=str(tmp_path / "o.zarr"), chunk=(64,)), whole)


def _spools(folder, overlap=0):
    for y in range(3):
        for z in range(4):
            a = y * (64 - overlap)
            spool.write_spool(str(folder / f"t_run{y + 1:02d}_y{y + 1:02d}_z{z + 1:02d}_HR"), BRAIN[z : z + 1, a : a + 64, :], 128)


def test_lsm_spool(spark, tmp_path):
    _spools(tmp_path / "in", 10)
    w = lsm.spool(spark, str(tmp_path / "in"), overlap=10, out=str(tmp_path / "o.zarr"), chunk=(64,))
    check(w, BRAIN[:4, :172])


def test_lsm_spool_missing_and_twice(spark, tmp_path):
    _spools(tmp_path / "in")
    files.delete(str(tmp_path / "in/t_run02_y02_z02_HR"))
    with pytest.raises(ValueError, match="missing"):
        lsm.spool(spark, str(tmp_path / "in"), overlap=0, out=str(tmp_path / "a.zarr"))
    w = lsm.spool(spark, str(tmp_path / "in"), overlap=0, missing="zero", out=str(tmp_path / "b.zarr"), levels=0)
    assert not stored(w.path)[1, 64:128].any() and (stored(w.path)[1, :64] == BRAIN[1, :64]).all()
    spool.write_spool(str(tmp_path / "in/t_run09_y01_z01_HR"), BRAIN[:1, :64], 128)
    with pytest.raises(ValueError, match="twice"):
        lsm.spool(spark, str(tmp_path / "in"), overlap=0, out=str(tmp_path / "c.zarr"))


def test_lsm_strip(spark, tmp_path):
    spool.write_spool(str(tmp_path / "s_HR"), BRAIN[:1, :64], 128)
    w = lsm.strip(spark, str(tmp_path / "s_HR"), mip_image_output=str(tmp_path / "m.png"), out=str(tmp_path / "o.zarr"), levels=1, chunk=(64,))
    want = np.concatenate([BRAIN[:1, :64], np.zeros((1, 64, 256), np.uint16)])
    check(w, want)
    import struct
    import zlib

    png, at, packed = (tmp_path / "m.png").read_bytes(), 8, b""
    while at < len(png):
        n, kind = struct.unpack_from(">I4s", png, at)
        packed += png[at + 8 : at + 8 + n] if kind == b"IDAT" else b""
        at += 12 + n
    raw = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(64, -1)[:, 1:]
    assert (raw.copy().view(">u2") == want.max(0)).all()


def _levels(folder, a, count=3):
    from voxelmill.plans.config import ArrayOptions
    from voxelmill.sinks import zarr as sink

    o = ArrayOptions(compressor="none")
    sink.create_group(folder, o)
    for level in range(count):
        b = a[..., :: 2**level, :: 2**level]
        doc = sink.array_document(b.shape, b.shape, None, b.dtype.name, o)
        lay = zarr.Layout(f"{folder}/{level}", 3, doc)
        files.write(lay.file([0] * b.ndim), sink.encoded(lay, b) or b"")
        files.write(f"{folder}/{level}/zarr.json", json.dumps(doc).encode())
    return folder


def test_df_slices(spark, tmp_path):
    rgb = BRAIN[:3, :100, :90]
    one = _levels(str(tmp_path / "a"), rgb)
    w = df.single_slice(spark, one, fmt="zarr", out=str(tmp_path / "o.zarr"), chunk=(64,))
    for level in range(3):
        assert (stored(w.path, level) == rgb[:, :: 2**level, :: 2**level]).all()
    two = _levels(str(tmp_path / "b"), rgb[:, :61, :])
    w = df.multi_slice(spark, [one, two], fmt="zarr", thickness=1.5, out=str(tmp_path / "p.zarr"), chunk=(64,))
    a = stored(w.path)
    assert a.shape == (3, 2, 100, 90) and (a[:, 0] == rgb).all()
    assert (a[:, 1, 19:80] == rgb[:, :61]).all() and not a[:, 1, :19].any() and not a[:, 1, 80:].any()
    assert json.loads(files.read(str(tmp_path / "p.json")))["SliceThickness"] == 1.5


def test_wk_webknossos(spark, tmp_path):
    mask = np.zeros((3, 64, 64), np.uint8)
    mask[0, 20:30, 24:40], mask[2, 0:8, 56:64] = 1, 2
    image = _levels(str(tmp_path / "image"), BRAIN[:3, :64, :64], 3)
    from voxelmill.sinks import zarr as sink

    sink.update_attributes(image, {"multiscales": [{"name": "x"}]})
    for level in range(3):
        folder = str(tmp_path / "masks" / wk.mask_name(level))
        a = mask[:, :: 2**level, :: 2**level]
        _levels(folder + "_", a, 1)
        files.located(folder)[0].move(folder + "_/0", folder)
    w = wk.webknossos(spark, str(tmp_path / "masks"), image, '{"1": 5, "2": 6}', fmt="zarr", out=str(tmp_path / "o.zarr"))
    for level in range(3):
        want = mask[:, :: 2**level, :: 2**level]
        assert (stored(w.path, level) == np.where(want == 1, 5, np.where(want == 2, 6, 0))).all()
    assert zarr.attributes(w.path)["multiscales"] == [{"name": "x"}]


def test_wk_files(spark, tmp_path):
    mask = np.zeros((5, 70, 66), np.uint8)
    mask[0, 20:30, 24:40], mask[2, 0:8, 56:64], mask[4, 69, 0] = 1, 2, 3
    image = _levels(str(tmp_path / "image"), np.arange(5 * 70 * 66, dtype=np.int32).reshape(5, 70, 66), 2)
    for level in range(2):
        wkw.write_wkw(str(tmp_path / "masks" / wk.mask_name(level)), np.ascontiguousarray(mask[:, :: 2**level, :: 2**level]), 8, 2, wkw.RAW if level else wkw.LZ4)
    with pytest.raises(Exception, match="no new label"):
        wk.webknossos(spark, str(tmp_path / "masks"), image, '{"1": 5}', out=str(tmp_path / "p.zarr"))
    w = wk.webknossos(spark, str(tmp_path / "masks"), image, '{"1": 5, "2": 6, "3": 7}', out=str(tmp_path / "o.zarr"), max_load=16)
    assert (stored(w.path, 1) == np.array([0, 5, 6, 7])[mask[:, ::2, ::2]]).all()
    fine = stored(w.path)
    assert (fine[0, 20:30, 24:40] == 5).all() and (fine[2, 0:8, 56:64] == 6).all() and not fine[1].any()


@pytest.mark.parametrize("order", ["C", "F"])
def test_shards_are_written_chunk_by_chunk_and_read_by_range(spark, tmp_path, monkeypatch, order):
    from voxelmill.operators.grid import BLOCKS, block_table
    from voxelmill.plans.config import ArrayOptions
    from voxelmill.sinks import zarr as sink

    a = np.random.default_rng(1).integers(0, 9, (30, 41, 50)).astype(np.int32)
    a[:8, :16] = 0
    pieces = [([z, y, 0], a[z : z + 7, y : y + 13]) for z in range(0, 30, 7) for y in range(0, 41, 13)]
    blocks = spark.createDataFrame(block_table(pieces).to_pylist(), BLOCKS).repartition(5)
    path = str(tmp_path / "a")
    got = sink.write_array(path, blocks, a.shape, [4, 8, 10], [16, 16, 30], "int32", ArrayOptions(order=order, compressor="gzip"))
    layout = zarr.opened(path)
    assert got["files"] == 12 and (layout.read([(0, n) for n in a.shape]) == a).all()
    box = [(3, 21), (10, 18), (29, 50)]
    assert (layout.read(box) == a[3:21, 10:18, 29:50]).all()
    assert layout.part(4 * 4 * 8 * 10 * 4) == [8, 16, 10] or math.prod(layout.part(4 * 4 * 8 * 10 * 4)) <= 4 * 4 * 8 * 10
    read = []
    real = files.read
    monkeypatch.setattr(files, "read", lambda p, offset=0, size=None: read.append(size) or real(p, offset, size))
    assert (layout.read([(16, 17), (16, 17), (0, 1)]) == a[16:17, 16:17, :1]).all() and None not in read and sum(read) < 2000


def test_large_arrays_are_read_in_groups(tmp_path):
    from voxelmill.sources import blocks as b

    cells = b.Cells([10**7, 10**6], [100, 100], [(0, 10**7), (50, 10**6 - 50)])
    assert len(cells) == 10**9 and cells[10**9 - 1].origin == (10**7 - 100, 10**6 - 100) and cells[10**4].origin == (100, 0)
    with pytest.raises(IndexError):
        cells[10**9]
    assert len(b.Cells([5, 5], [2, 2], [(0, 0), (1, 5)])) == 0


def test_groups(tmp_path):
    from voxelmill.plans.config import ArrayOptions
    from voxelmill.sinks.groups import Group

    for version in (2, 3):
        g = Group.create(str(tmp_path / f"g{version}"), ArrayOptions(zarr_version=version, compressor="zlib"))
        g["0"] = BRAIN[:2, :8, :8]
        child = g.create_group("sub")
        child.create_array("x", [4, 4], "uint8", [2, 2], [4, 4] if version == 3 else None)
        like = g.create_array_like("1", [1, 4, 4])
        assert g.keys() == ["0", "1", "sub"] and len(g) == 3 and "sub/x" in g and "y" not in g and [*g["sub"]] == ["x"]
        assert (g["0"].read([(0, 2), (0, 8), (0, 8)]) == BRAIN[:2, :8, :8]).all()
        assert like.shape == (1, 4, 4) and like.dtype == g["0"].dtype and not g["1"].read([(0, 1), (0, 4), (0, 4)]).any()
        g.update({"a": 1})
        assert g.attrs == {"a": 1}
        del g["1"]
        assert "1" not in g
        for name in ("1", "z"):
            with pytest.raises(KeyError):
                g[name]
        with pytest.raises(KeyError):
            Group(str(tmp_path / "nothing"))


@pytest.mark.parametrize("compression", tiff.ENCODERS)
@pytest.mark.parametrize("cell", [None, (16, 16), (7, 101), (48, 32)])
def test_tiff_compressions(tmp_path, compression, cell):
    r = np.random.default_rng(2)
    for dtype in ("uint8", "uint16", "float32"):
        a = (r.integers(0, 200, (2, 37, 101)) * (r.random((2, 37, 101)) < 0.4)).astype(dtype)
        for predictor in (1, 2) if dtype != "float32" else (1,):
            tiff.write_tiff(str(tmp_path / "a.tiff"), a, compression, predictor, cell)
            assert (np.stack([tiff.read_page(str(tmp_path / "a.tiff"), p) for p in tiff.pages(str(tmp_path / "a.tiff"))]) == a).all()


def test_lzw_of_the_standard_example():
    # codes 256 7 258 8 8 258 6 6 257 of nine bits each
    assert tiff.unpacked_lzw(bytes([0x80, 0x01, 0xE0, 0x40, 0x80, 0x44, 0x08, 0x0C, 0x06, 0x80, 0x80])) == bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])
    assert tiff.unpacked_bits(bytes([0xFE, 0xAA, 0x02, 0x80, 0x00, 0x2A, 0xFD, 0xAA, 0x03, 0x80, 0x00, 0x2A, 0x22, 0xF7, 0xAA])) == bytes.fromhex("AAAAAA80002AAAAAAAAA80002A22" + "AA" * 10)


def lzw_packed(data):
    """A plain encoder: a clear code first and wherever 3,800 codes have been written."""
    bits, table, current, count = [], {bytes([k]): k for k in range(256)}, b"", 0

    def put(code):
        bits.append(format(code, f"0{min(12, max(9, (258 + count).bit_length()))}b"))

    put(256)
    for k in range(len(data)):
        longer = current + data[k : k + 1]
        if longer in table:
            current = longer
            continue
        put(table[current])
        table[longer], count, current = 257 + count + 1, count + 1, data[k : k + 1]
        if count == 3800:
            put(256)
            table, count = {bytes([k]): k for k in range(256)}, 0
    if current:
        put(table[current])
        count += 1
    put(257)
    text = "".join(bits)
    text += "0" * (-len(text) % 8)
    return int(text, 2).to_bytes(len(text) // 8, "big")


def test_lzw_there_and_back():
    r = np.random.default_rng(0)
    for data in (b"", b"a", b"a" * 100_000, r.integers(0, 256, 50_000, np.uint8).tobytes(), r.integers(0, 3, 60_000, np.uint8).tobytes(), b"abcab" * 3000):
        packed = lzw_packed(data)
        assert tiff.unpacked_lzw(packed) == data
        cut = tiff.unpacked_lzw(packed[: len(packed) // 2])
        assert data.startswith(cut)
    with pytest.raises(ValueError, match="entry"):
        tiff.unpacked_lzw(bytes([0x80, 0x00, 0x3F, 0xFF, 0xFF]))


def test_region_of_a_stored_level(spark, tmp_path):
    tiff.write_tiff(str(tmp_path / "s.tiff"), BRAIN)
    w = lsm.single_volume(spark, str(tmp_path / "s.tiff"), out=str(tmp_path / "o.zarr"), chunk=(64,), levels=0)
    blocks, _ = opened(spark, "zarr", w.path, level=0, region="2:5,...,10:70")
    rows = blocks.collect()
    assert blocks.rdd.getNumPartitions() <= 8 and len(rows) == 8 and sum(math.prod(r["shape"]) for r in rows) == 3 * 256 * 60
    for r in rows:
        a = np.frombuffer(r["data"], r["dtype"]).reshape(r["shape"])
        assert (a == BRAIN[tuple(slice(o, o + n) for o, n in zip(r["origin"], r["shape"]))]).all()


def test_command_line(spark, tmp_path):
    tiff.write_tiff(str(tmp_path / "s.tiff"), BRAIN[:, :32, :32])
    w = cli.main(["lsm", "single_volume", str(tmp_path / "s.tiff"), "--out", str(tmp_path / "o.zarr"), "--chunk", "16", "--no-nii", "--zarr-version", "2"], spark)
    check(w, BRAIN[:, :32, :32])
    assert not files.exists(f"{w.path}/nifti")
    with pytest.raises(FileExistsError):
        cli.main(["lsm", "single_volume", str(tmp_path / "s.tiff"), "--out", str(tmp_path / "o.zarr")], spark)
