"""Volumes that lack voxels: their last slice is short, a slice is missing, and there are gaps."""

import os

import duckdb
import numpy as np
import pytest

import voxelmill.queries as q
from tests import oracle
from tests.test_pipelines import stored
from tests.test_regions import boxes
from voxelmill.operators import pyramid
from voxelmill.plans.config import ArrayOptions
from voxelmill.sinks import pyramids

NAMES = [
    "convert_lsm_single_volume",
    "convert_df_single_slice",
    "convert_lsm_multi_slice",
    "convert_lsm_mosaic",
    "convert_lsm_spool",
    "convert_lsm_strip",
    "convert_psoct_multi_slice",
    "convert_psoct_single_volume",
    "convert_wk_annotation",
    "group_of_arrays",
    "nifti_roundtrip",
    "mat_first_variable",
    "mat_hdf5",
    "pack_roundtrip",
    "pyramid_blocks",
    "pyramid_one_pass",
    "pyramid_one_pass_sharded",
    "rechunk",
    "tiff_compressions",
    "wkw_region",
    "zarr_append_overlapping",
    "zarr_first_axis_fastest",
    "zarr_region_v3_sharded",
    "zarr_region_write",
    "zarr_roundtrip_v2",
    "zarr_written",
    # more
]


@pytest.fixture(scope="module")
def holed(sf_dir, tmp_path_factory):
    path = tmp_path_factory.mktemp("holed")
    for t in oracle.TABLES:
        if t != "embeddings":
            os.symlink(f"{sf_dir}/{t}.parquet", path / f"{t}.parquet")
    duckdb.sql(f"copy (select * from '{sf_dir}/embeddings.parquet' where vec_id < 193 and vec_id % 7 <> 3 and vec_id // 20 <> 4) to '{path}/embeddings.parquet' (format parquet)")
    return str(path)


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_as_sql_without_absent_voxels(spark, holed, name):
    oracle.same(q.queries()[name](spark, holed), oracle.connect(holed), q.oracle_sql()[name])


@pytest.mark.parametrize("mode", ["mean", "median", "max", "min"])
@pytest.mark.parametrize(("dtype", "absent"), [("int32", -(1 << 31)), ("uint16", 65535), ("int64", -(1 << 62)), ("float32", -1e30)])
def test_windows_leave_absent_voxels_out(mode, dtype, absent):
    r = np.random.default_rng(3)
    a = (r.random((5, 6, 8)) * 100).astype(dtype)
    a[r.random(a.shape) < 0.4] = absent
    a[:2, :2, :2] = absent
    x = np.where(a == absent, np.nan, a.astype(float))[:4].reshape(2, 2, 3, 2, 4, 2)
    x[0, :, 0, :, 0] = 0
    want = np.trunc(pyramid.NUMPY[mode](x, axis=(1, 3, 5))) if dtype != "float32" else pyramid.NUMPY[mode](x, axis=(1, 3, 5)).astype(dtype)
    want[0, 0, 0] = absent
    np.testing.assert_allclose(pyramid.reduce_array(a, [2, 2, 2], mode, absent), want, rtol=1e-6)


@pytest.mark.parametrize("shard", [None, (8, 8, 8)])
def test_levels_of_arrays_with_a_fill_value(spark, tmp_path, shard):
    """What no box covers holds the fill value on every level, in chunks that are stored in part, too."""
    a, fill = np.arange(1000, dtype=np.int32).reshape(10, 10, 10), -7
    want, path = np.full((32, 32, 32), fill, np.int32), str(tmp_path / "p")
    want[3:13, 3:13, 3:13] = a
    pyramids.write_levels(path, boxes(spark, ([3, 3, 3], a)), want.shape, [4] * 3, shard, "int32", ArrayOptions(fill_value=fill), 3, [True] * 3)
    for level in range(4):
        np.testing.assert_array_equal(stored(path, level), want)
        want = pyramid.reduce_array(want, [2] * 3, "mean", fill)
