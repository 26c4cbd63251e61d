"""Formulas and small functions against known values and numpy."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voxelmill.functions import metadata_text, naming, orientation, units
from voxelmill.functions.arithmetic import ceil_div, floor_div
from voxelmill.operators import compare, grid, labels, pyramid, tiles
from voxelmill.plans import config, layout, levels
from voxelmill.sources import mat, nifti, optional, zarr
from voxelmill.sources.blocks import UnsupportedFormatError, region, source


def test_division_rounds_like_python(spark):
    df = spark.createDataFrame([(a, b) for a in range(-9, 10) for b in (1, 2, 3, 7)], "a long, b long")
    for r in df.select("a", "b", floor_div("a", F.col("b")).alias("f"), ceil_div("a", F.col("b")).alias("c")).collect():
        assert r["f"] == r["a"] // r["b"] and r["c"] == -(-r["a"] // r["b"])


@pytest.mark.parametrize("shape,want", [((1000,) * 3, [1024] * 3), ((4000,) * 3, [1280] * 3), ((200, 4000, 4000), [256, 2944, 2816])])
def test_automatic_shards(shape, want):
    assert layout.layout(shape, 2, config.ArrayOptions(shard="auto")) == ([128] * 3, want)


def test_layouts():
    o = config.ArrayOptions
    assert layout.layout((3, 10, 256, 256), 8, o(no_time=True)) == ([3, 128, 128, 128], None)
    assert layout.layout((9, 3, 10, 256, 256), 8, o(chunk=(64,))) == ([1, 3, 64, 64, 64], None)
    assert layout.layout((256, 256), 2, o()) == ([128, 128], None)
    assert layout.layout((256, 256, 256), 2, o(chunk=(64, 32, 16))) == ([64, 32, 16], None)
    assert layout.reconciled((100, 100), (100, 40), (200, 100)) == ([200, 40], [200, 120])
    assert layout.doubled_shard((100, 3000, 3000), 2) == [128, 4096, 4096]
    with pytest.raises(ValueError):
        layout.layout((4, 4), 1, o(chunk=(1, 1, 1)))
    with pytest.raises(ValueError):
        o(zarr_version=2, shard=(64,))


def test_levels():
    assert levels.default_levels((10, 256, 256), (128,) * 3) == 1 and levels.default_levels((10, 256, 256), (64,) * 3) == 2
    assert levels.default_levels((10, 256, 256), (64,) * 3, skip=(1, 2)) == 0
    assert levels.level_shape((10, 7, 1), 2, skip=(0,)) == [10, 1, 1]
    body = levels.multiscales("czyx", 2, [1, 2.0, 1.0, 1.0])["multiscales"][0]
    assert body["datasets"][2]["coordinateTransformations"] == [{"type": "scale", "scale": [1.0, 8.0, 4.0, 4.0]}, {"type": "translation", "translation": [0.0, 3.0, 1.5, 1.5]}]


@settings(deadline=None, max_examples=40)
@given(st.integers(1, 5000), st.integers(1, 300))
def test_level_count_is_the_logarithm(size, chunk):
    assert levels.default_levels((size,), (chunk,)) == max(0, math.ceil(round(math.log2(-(-size // chunk)), 9)))


def test_units():
    assert units.ome_unit("um") == "micrometer" and units.ome_unit("m") == "meter" and units.ome_unit("d") == "day"
    assert units.nifti_unit("ms") == "msec" and units.nifti_unit("km") == "unknown"
    assert units.unit_scale("micron") == units.unit_scale("u") == 1e-6 and units.unit_scale("d") == 86400
    assert units.convert(2, "mm", "um") == pytest.approx(2000)
    for bad in ("year", "dam", "u", "y", "bogus"):
        with pytest.raises(ValueError):
            units.ome_unit(bad)
    with pytest.raises(ValueError):
        units.unit_scale("bogus")


def test_unknown_unit_is_an_error_in_a_column(spark):
    with pytest.raises(Exception, match="unknown unit"):
        spark.createDataFrame([("bogus",)], "u string").select(units.ome_col(F.col("u"))).collect()


def test_orientations():
    assert orientation.normalised("coronal") == "LIA" and orientation.normalised("RA") == "RAS"
    for code in map("".join, itertools.product("RL", "AP", "SI")):
        for p in map("".join, itertools.permutations(code)):
            m = np.array(orientation.affine(p, (2, 3, 4)))
            assert abs(np.linalg.det(m)) == pytest.approx(24)
            c = np.array(orientation.centred(m.tolist(), (5, 6, 7)))
            assert np.allclose(c @ [2, 2.5, 3, 1], [0, 0, 0, 1])
    with pytest.raises(ValueError):
        orientation.normalised("RRS")
    eye = np.eye(4).tolist()
    assert orientation.chosen(eye, "RAS", (2, 2, 2), (1, 1, 1), False) is eye and orientation.chosen(eye, "LPS", (2, 2, 2), (1, 1, 1), False) is not eye


SAMPLE = """Image medium: 60% TDE
Center Wavelength: 1294.84nm
Axial resolution: 4.9um
FOV: 3x3mm
Voxel size: 3x3x3um
Depth focus range: 225um
Number of focuses: 2
Slice thickness: 450um.
Number of slices: 75
Slice #:23
Modality: dBI: x
"""


def test_metadata_text(spark):
    doc = metadata_text.parse(SAMPLE)
    assert doc["SampleMedium"] == "60% 2,2' Thiodiethanol (TDE)" and doc["PixelSize"] == [3, 3, 3] and doc["SliceThickness"] == pytest.approx(450)
    assert doc["OCTModality"] == "dBI: x" and doc["SliceCount"] == 75 and doc["DepthFocusRangeUnit"] == "um"
    row = spark.createDataFrame([(SAMPLE,)], "t string").select(metadata_text.document_col(F.col("t")).alias("d")).first()["d"].asDict()
    assert {k: round(v, 6) if isinstance(v, float) else v for k, v in row.items() if v is not None} == doc | {"SliceThickness": 450.0}
    with pytest.raises(ValueError):
        metadata_text.value_unit("3 um")


GRIDS = {
    ("row-by-row", "right-down"): [[1, 2, 3], [4, 5, 6]], ("row-by-row", "left-up"): [[6, 5, 4], [3, 2, 1]], ("column-by-column", "down-left"): [[5, 3, 1], [6, 4, 2]],
    ("column-by-column", "up-right"): [[2, 4, 6], [1, 3, 5]], ("snake-by-rows", "right-up"): [[6, 5, 4], [1, 2, 3]], ("snake-by-rows", "left-down"): [[3, 2, 1], [4, 5, 6]],
    ("snake-by-columns", "down-right"): [[1, 4, 5], [2, 3, 6]], ("snake-by-columns", "up-left"): [[6, 3, 2], [5, 4, 1]],
}


@pytest.mark.parametrize("kind", GRIDS)
def test_grid_orders(spark, kind):
    row, column = naming.grid_place(F.col("id"), 3, 2, *kind)
    for r in spark.range(1, 7).select("id", row.alias("r"), column.alias("c")).collect():
        assert GRIDS[kind][r["r"]][r["c"]] == r["id"]


def test_odd_overlap_is_seamless_unless_compatible(spark):
    t = spark.createDataFrame([(1, 10), (2, 10)], "y int, s int")
    rows = {r["y"]: r for r in tiles.placed(t, "y", "s", 3).collect()}
    assert (rows[1]["lo"], rows[1]["hi"], rows[2]["start"], rows[2]["lo"]) == (0, 8, 8, 1)
    old = {r["y"]: r for r in tiles.placed(t, "y", "s", 3, compat=True).collect()}
    assert (old[1]["hi"], old[2]["start"]) == (7, 8)
    assert tiles.extent(t, "y", "s", 3).first()["total"] == 17


def test_default_names_and_stems(spark):
    df = spark.createDataFrame([("/a/b/t_y01_z02.tiff",), ("c/x.ome.zarr/",)], "p string").select(tiles.stem(F.col("p")).alias("s"))
    assert [r["s"] for r in df.collect()] == ["t_y01_z02", "x.ome"]
    assert config.default_output("/d/scan.mat", config.HeaderOptions()) == "scan.nii.zarr" and config.default_output("s/", config.HeaderOptions(nii=False)) == "s.ome.zarr"


@pytest.mark.parametrize("mode", ["mean", "median", "max", "min"])
@pytest.mark.parametrize("shape", [(5, 4, 6), (1, 7, 7), (2, 2, 2)])
def test_levels_in_both_forms(spark, mode, shape):
    a = np.random.default_rng(2).integers(-50, 50, shape).astype(np.int32)
    a[np.random.default_rng(3).random(shape) < 0.4] = 0
    f = [1 if n == 1 else 2 for n in shape]
    want = pyramid.reduce_array(a, f, mode)
    b = a[tuple(slice(0, n // k * k) for n, k in zip(shape, f))].reshape([m for n, k in zip(shape, f) for m in (n // k, k)])
    assert (want == np.trunc({"mean": np.mean, "median": np.median, "max": np.max, "min": np.min}[mode](b, axis=(1, 3, 5)))).all()
    at = np.nonzero(a)
    df = spark.createDataFrame(pd.DataFrame({"z": at[0], "y": at[1], "x": at[2], "v": a[at]}), "z long, y long, x long, v int")
    got = np.zeros(want.shape, int)
    for r in pyramid.coarsened(df, dict(zip("zyx", shape)), mode).collect():
        got[r["z"], r["y"], r["x"]] = r["v"]
    assert (got == want).all()


def test_label_errors_and_borders(spark):
    df = spark.createDataFrame([(0, 0, 0, 1), (0, 3, 5, 2), (1, 0, 0, 0)], "z int, y int, x int, v int")
    rows = {r["z"]: r for r in labels.borders(df, 10, 12).collect()}
    assert tuple(rows[0])[1:] == (0, 5, 0, 5) and tuple(rows[1])[1:] == (-1,) * 4
    with pytest.raises(Exception, match="no new label"):
        labels.remapped(df, {1: 2}).collect()
    assert labels.remapped(df, {}) is df
    large = {k: k + 1 for k in range(labels.IN_PLAN + 1)}
    assert sorted(r["v"] for r in labels.remapped(df, large).collect()) == [1, 2, 3]
    with pytest.raises(Exception, match="no new label"):
        labels.remapped(df.withColumn("v", F.col("v") + 10_000), large).collect()


def test_array_summary(spark):
    a = spark.createDataFrame([(0, 1.0), (1, float("nan")), (2, 3.0)], "x int, v double")
    b = spark.createDataFrame([(0, 1.0 + 1e-9), (1, float("nan")), (3, 3.0)], "x int, v double")
    assert tuple(compare.summary(compare.array_diff(a, b, ["x"])).first()) == (4, 2, 3.0)
    assert compare.metadata_diff({"a": {"b": 1}, "c": 2}, {"a": {"b": 2}}) == ["/a/b", "/c"]


def test_options_given_flat():
    @config.autoconfig
    def f(x: int, *, array: config.ArrayOptions, header: config.HeaderOptions) -> tuple:
        return x, array.chunk, header.nii

    assert f(1, chunk=(3,), nii=False) == (1, (3,), False)
    with pytest.raises(TypeError):
        f(1, nothing=2)


def test_writers_and_orders_that_are_known():
    assert config.ArrayOptions(driver="tensorstore").driver == "tensorstore"
    with pytest.raises(config.UnsupportedDriverError):
        config.ArrayOptions(driver="nothing")
    with pytest.raises(ValueError):
        config.ArrayOptions(order="K")


def test_verbose_logs_more(spark, tmp_path):
    import logging

    from voxelmill.pipelines import cli
    from voxelmill.sources import tiff

    tiff.write_tiff(str(tmp_path / "s.tiff"), np.ones((2, 4, 4), np.uint8))
    before = logging.getLogger().level
    try:
        for flags, level in ((["--verbose"], logging.DEBUG), (["--log-level", "error"], logging.ERROR)):
            cli.main(["lsm", "single_volume", str(tmp_path / "s.tiff"), "--out", str(tmp_path / f"{level}.zarr"), "--levels", "0", *flags], spark)
            assert logging.getLogger().level == level
    finally:
        logging.getLogger().setLevel(before)


def test_small_sides_are_broadcast_by_their_size(spark):
    """A written table's bytes are known, so the planner broadcasts a small one of its own accord, and no large one."""
    rows = spark.range(100_000).withColumn("v", F.rand(1))
    plan = lambda most: [spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most), rows.join(tiles.bounded(spark.range(3)), "id")._jdf.queryExecution().sparkPlan().toString()][1]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        assert "BroadcastHashJoin" in plan("10MB") and "BroadcastHashJoin" not in plan("100")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_regions_and_formats():
    assert region("1:3,...", (5, 6, 7)) == [(1, 3), (0, 6), (0, 7)] and region(None, (2,)) == [(0, 2)] and region("-2:", (5,)) == [(3, 5)]
    with pytest.raises(ValueError):
        region("1,2", (3, 3))
    with pytest.raises(UnsupportedFormatError):
        source("nothing")


def test_wavelet_areas_and_pixel_sizes():
    assert optional.level_shape((101, 64, 3), 2) == (26, 16, 3) and optional.level_area((0, 26), (4, 16), 2, (101, 64)) == (0, 16, 101, 64)
    assert optional.pixel_size(b"<a PixelWidth='0.5' PixelHeight='2'/>") == (0.5, 2.0) and optional.pixel_size(b"<a") == (1, 1) and optional.pixel_size(None) == (1, 1)


def test_crc_of_the_standard_test_vector():
    assert zarr.crc32c(b"123456789") == 0xE3069283


def test_mat_structs_and_keys(tmp_path):
    assert mat.chosen_key(["_x", "b"], None, "f") == "b"
    for names, key in ((["a"], "b"), (["_a"], None)):
        with pytest.raises(KeyError):
            mat.chosen_key(names, key, "f")
    mat.write_mat(str(tmp_path / "a.mat"), {"n": np.arange(6, dtype=np.int16).reshape(2, 3)}, compress=False)
    assert (mat.read_mat(str(tmp_path / "a.mat"))["n"] == [[0, 1, 2], [3, 4, 5]]).all()


def test_nifti_files(tmp_path, spark):
    from voxelmill.sources.blocks import opened

    a = np.random.default_rng(0).integers(0, 9, (4, 5, 6)).astype(np.int16)
    for name in ("a.nii", "b.nii.gz"):
        nifti.write_nifti(str(tmp_path / name), a)
        assert nifti.load_header(str(tmp_path / name)).shape == (6, 5, 4)
        r = opened(spark, "nifti", str(tmp_path / name))[0].first()
        assert (np.frombuffer(r["data"], r["dtype"]).reshape(r["shape"]) == a).all()
    with pytest.raises(ValueError):
        nifti.Header.unpacked(b"\0" * 400)


def test_missing_codecs_say_so():
    with pytest.raises(ValueError, match="unknown compressor"):
        zarr.codec("lzma")
    for name in ("zlib", "gzip", "bz2", "zstd", "blosc", "none"):
        enc, dec = zarr.codec(name)
        assert dec(enc(b"abc" * 99)) == b"abc" * 99


def test_box_reaches_the_scan(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("x"), F.col("o_custkey").alias("v"))
    plan = grid.box(df, {"x": (10, 20)})._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(o_orderkey), GreaterThanOrEqual(o_orderkey,10), LessThan(o_orderkey,20)]" in plan
    assert "o_totalprice" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_tiles_that_arrive(spark, tmp_path):
    from voxelmill.sources import tiff
    from voxelmill.streaming import ingest

    seen = []
    for k, name in enumerate(("t_y01_z01", "t_y02_z01", "notes")):
        tiff.write_tiff(str(tmp_path / f"in/{name}.tiff"), np.full((1, 4, 4), k, np.uint8))
    for _ in range(2):
        s = ingest.arriving(spark, str(tmp_path / "in"), "multi_slice")
        q = ingest.assembled(s, lambda df, n: seen.extend((r["y"], r["z"]) for r in df.collect()), str(tmp_path / "ck"))
        assert q.awaitTermination(60)
        tiff.write_tiff(str(tmp_path / "in/t_y03_z01.tiff"), np.zeros((1, 4, 4), np.uint8))
        tiff.write_tiff(str(tmp_path / "in/u_y01_z01.tiff"), np.zeros((1, 4, 4), np.uint8))
    assert sorted(seen) == [(1, 1), (2, 1), (3, 1)]


def test_last_write_wins_in_both_ways(spark):
    from voxelmill.operators import stitch

    r = np.random.default_rng(3)
    pdf = pd.DataFrame({"x": r.integers(0, 30, 300), "o": r.integers(-3, 4, 300), "v": r.integers(-(2**31), 2**31, 300)})
    want = {x: max(zip(g["o"], g["v"]))[1] for x, g in pdf.groupby("x")}
    for kind in ("int", "long"):
        df = spark.createDataFrame(pdf, f"x long, o int, v {kind}")
        got = stitch.last_wins(df, ["x"], "o")
        assert {q["x"]: q["v"] for q in got.collect()} == want
        assert ("SortAggregate" in got._jdf.queryExecution().toString()) == (kind == "long")
