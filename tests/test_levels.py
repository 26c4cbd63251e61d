"""Pyramids in one pass against numpy."""

import numpy as np
import pytest

from tests.test_pipelines import stored
from tests.test_regions import boxes
from voxelmill.operators.pyramid import NUMPY
from voxelmill.plans.config import ArrayOptions
from voxelmill.sinks import pyramids
from voxelmill.sources import files


def reduced(a, pooled, mode):
    f = [2 if p and n > 1 else 1 for p, n in zip(pooled, a.shape)]
    a = a[tuple(slice(0, n // k * k) for n, k in zip(a.shape, f))]
    split = a.reshape([m for n, k in zip(a.shape, f) for m in (n // k, k)])
    out = NUMPY[mode](split, axis=tuple(range(1, split.ndim, 2)))
    return (np.trunc(out) if a.dtype.kind in "iu" else out).astype(a.dtype)


CASES = [
    ((37, 50, 70), (4, 8, 8), None, 4, (1, 1, 1), "mean", "int16"), ((37, 50, 70), (4, 8, 8), None, 4, (1, 1, 1), "median", "float32"), ((16, 16, 16), (4, 4, 4), (8, 8, 8), 3, (1, 1, 1), "max", "uint8"),
    ((21, 40, 33), (2, 4, 4), (6, 4, 12), 4, (1, 1, 1), "mean", "int32"), ((3, 20, 20), (1, 4, 4), (2, 8, 8), 3, (0, 1, 1), "mean", "uint16"), ((1, 9, 40, 1), (1, 10, 8, 2), None, 5, (0, 1, 1, 1), "min", "int32"),
    ((5, 6, 7), (8, 8, 8), None, 0, (1, 1, 1), "mean", "uint8"), ((2, 3, 30, 30), (1, 3, 6, 10), (2, 3, 12, 20), 2, (0, 0, 1, 1), "mean", "int64"),
]


@pytest.mark.parametrize("carry", [None, 1, 2, 5])
@pytest.mark.parametrize("case", range(len(CASES)))
def test_levels_equal_numpy(spark, tmp_path, case, carry):
    if carry == 5 and case % 2:
        pytest.skip("half of them will do")
    shape, chunk, shard, count, pooled, mode, dtype = CASES[case]
    want = (np.random.default_rng(case).random(shape) * 200 - (100 if dtype[0] in "if" else 0)).astype(dtype)
    half = shape[-1] // 2
    parts = [([0] * len(shape), want[..., :half]), ([0] * (len(shape) - 1) + [half], want[..., half:])] if half else [([0] * len(shape), want)]
    o = ArrayOptions(zarr_version=2 if case == 1 else 3, compressor="zlib")
    path = str(tmp_path / "p")
    shapes, wrote = pyramids.write_levels(path, boxes(spark, *parts), shape, chunk, shard, dtype, o, count, [bool(p) for p in pooled], mode, carry)
    assert len(shapes) == count + 1 and sorted(wrote) == list(range(count + 1))
    for level in range(count + 1):
        got = stored(path, level)
        assert list(got.shape) == shapes[level] and got.dtype == want.dtype
        np.testing.assert_array_equal(got, want, err_msg=str(level))
        want = reduced(want, pooled, mode)
    assert not [n for k in range(count + 1) for n in files.names(f"{path}/{k}") if n.endswith(".part")]


def test_levels_of_sparse_volumes_and_later_boxes(spark, tmp_path):
    """Absent voxels are zeros, chunks without any have no file, and later boxes lie over earlier ones."""
    a, b = np.full((10, 10, 10), 7, np.int32), np.full((9, 9, 9), 90, np.int32)
    want = np.zeros((64, 64, 64), np.int32)
    want[:10, :10, :10] = a
    want[3:12, 3:12, 3:12] = b
    path = str(tmp_path / "p")
    _, wrote = pyramids.write_levels(path, boxes(spark, ([3, 3, 3], b), ([0, 0, 0], a)), want.shape, [8] * 3, None, "int32", ArrayOptions(), 3, [True] * 3)
    assert [wrote[k][0] for k in range(4)] == [8, 1, 1, 1]
    for level in range(4):
        np.testing.assert_array_equal(stored(path, level), want)
        want = reduced(want, (1, 1, 1), "mean")
    with pytest.raises(ValueError, match="even"):
        pyramids.write_levels(path, boxes(spark, ([0, 0, 0], a)), (64, 64, 64), [5] * 3, None, "int32", ArrayOptions(), 1, [True] * 3)


def test_a_task_holds_one_chunk_of_each_level():
    """Along the curve, every chunk is emitted once, and as soon as those below it have gone by."""
    shapes = pyramids.level_shapes([16, 16, 16], [True] * 3, 3)
    at = np.array(list(np.ndindex(8, 8, 8)))
    at = at[np.argsort(pyramids.morton(at, [True] * 3, 3))]
    seen, waiting = [], []
    carry = pyramids.Carry(shapes, [2] * 3, [True] * 3, "mean", "int32", lambda level, index, a: seen.append((level, index)))
    for i in at:
        carry.add(0, tuple(i), np.ones((2, 2, 2), np.int32))
        waiting.append(sum(x is not None for x in carry.at))
    carry.close()
    assert [sum(level == k for level, _ in seen) for k in range(4)] == [512, 64, 8, 1] and len(set(seen)) == 585 and max(waiting) <= 3
