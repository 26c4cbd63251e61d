"""What conditions open, what writers leave behind, and boxes over stored arrays."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, In, IsNotNull, LessThan, LessThanOrEqual, Not

from tests.test_pipelines import stored
from voxelmill.operators import grid
from voxelmill.plans.config import ArrayOptions
from voxelmill.sinks import regions
from voxelmill.sinks import zarr as sink
from voxelmill.sources import blocks, files, nifti, tiff, wkw, zarr

CUBE = np.random.default_rng(8).integers(1, 900, (24, 20, 40)).astype(np.int32)


def boxes(spark, *parts):
    """Blocks (origin, array), one partition each."""
    rows = [(list(map(int, o)), list(a.shape), a.dtype.name, np.ascontiguousarray(a).tobytes()) for o, a in parts]
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows)), grid.BLOCKS)


def make(spark, path, a, chunk, shard=None, **options):
    o = ArrayOptions(**options)
    sink.write_array(path, boxes(spark, ([0] * a.ndim, a)), a.shape, chunk, shard, a.dtype.name, o)


def array(path):
    layout = zarr.opened(path)
    return layout.read([(0, n) for n in layout.shape])


def damage(path, keep):
    """Spoil every file that isn't in ``keep``; returns how many."""
    n = 0
    for folder, _, names in os.walk(path):
        for name in names:
            full = os.path.join(folder, name)
            if os.path.relpath(full, path) not in keep and "zarr" not in name and "header" not in name:
                with open(full, "wb") as f:
                    f.write(b"spoilt")
                n += 1
    return n


WHERE = "z >= 8 and z < 12 and y <= 9 and x in (3, 17, 18)"


def wanted():
    return sorted((z, y, x, int(CUBE[z, y, x])) for z in range(8, 12) for y in range(10) for x in (3, 17, 18))


@pytest.mark.parametrize("shard", [None, (8, 20, 20)])
def test_where_opens_only_what_it_needs(spark, tmp_path, shard):
    path = str(tmp_path / "a")
    make(spark, path, CUBE, (4, 10, 10), shard)
    got = blocks.voxels(spark, "zarr", path).where(WHERE)
    # one layer of chunks, of which two hold the columns; or one of six shards
    assert damage(path, {"c/2/0/0", "c/2/0/1"} if shard is None else {"c/1/0/0"}) == (46 if shard is None else 5)
    assert sorted(map(tuple, got.collect())) == wanted()
    with pytest.raises(Exception, match="Python worker"):
        blocks.voxels(spark, "zarr", path).where("z >= 0").collect()


def _opened(reader):
    parts = reader.made.within(reader.info, reader.bounds)
    return sum(1 for g in reader.partitions() for k in range(g.first, g.last) if all(any(o <= x < o + n for x in reader.places.get(d, [o])) for d, (o, n) in enumerate(zip(parts[k].origin, parts[k].shape))))


@pytest.mark.parametrize(("filters", "left", "count"), [
    ([], 0, 48), ([EqualTo(("z",), 9)], 0, 8), ([GreaterThan(("z",), 7), LessThanOrEqual(("z",), 12)], 0, 16), ([In(("x",), (3, 39)), IsNotNull(("x",))], 0, 24),
    ([In(("x",), (3, 39)), In(("x",), (39, 40))], 0, 12), ([LessThan(("y",), 10), EqualTo(("v",), 3)], 1, 24), ([EqualTo(("z",), 9.5)], 1, 48), ([Not(EqualTo(("z",), 1))], 1, 48),
    ([EqualTo(("z",), 99)], 0, 0), ([GreaterThanOrEqual(("z",), 12), LessThan(("z",), 4)], 0, 0), ([In(("y",), ())], 0, 0),
])
def test_filters_that_are_taken(spark, tmp_path_factory, filters, left, count):
    path = str(tmp_path_factory.getbasetemp() / "pushed")
    if not os.path.exists(path):
        make(spark, path, CUBE, (4, 10, 10))
    reader = blocks._VoxelReader(zarr.ZarrFormat(path, {}))
    assert len(list(reader.pushFilters(filters))) == left
    assert _opened(reader) == count


def test_where_on_other_formats(spark, tmp_path):
    tiff.write_tiff(str(tmp_path / "a.tiff"), CUBE)
    nifti.write_nifti(str(tmp_path / "a.nii"), CUBE)
    nifti.write_nifti(str(tmp_path / "b.nii.gz"), CUBE)
    wkw.write_wkw(str(tmp_path / "w"), CUBE, 4, 2)
    damage(str(tmp_path / "w"), {"z1/y0/x0.wkw", "z1/y0/x2.wkw", "z1/y1/x0.wkw", "z1/y1/x2.wkw", "header.wkw"})
    for name, path, options in (("tiff", "a.tiff", {}), ("nifti", "a.nii", {}), ("nifti", "b.nii.gz", {}), ("wkw", "w", {"shape": "40,20,24", "maxLoad": 8})):
        df = blocks.voxels(spark, name, str(tmp_path / path), **options)
        assert sorted(map(tuple, df.where(WHERE).collect())) == wanted(), name
    # of a file that can't be read in whole, the slices that are wanted are
    raw = (tmp_path / "a.nii").read_bytes()
    (tmp_path / "a.nii").write_bytes(raw[: 352 + 12 * 800 * 4])
    assert blocks.voxels(spark, "nifti", str(tmp_path / "a.nii")).where("z = 11").count() == 800


def test_voxel_form(spark, tmp_path):
    a = np.array([[0, 5], [250, 0]], np.uint8)
    make(spark, str(tmp_path / "a"), a, (1, 2))
    df = blocks.voxels(spark, "zarr", str(tmp_path / "a"))
    assert df.dtypes == [("y", "bigint"), ("x", "bigint"), ("v", "smallint")] and df.count() == 4
    assert sorted(map(tuple, blocks.voxels(spark, "zarr", str(tmp_path / "a"), sparse="true", axes="row,col").where("row >= 0").collect())) == [(0, 1, 5), (1, 0, 250)]
    assert blocks.voxels(spark, "zarr", str(tmp_path / "a")).where("y > 5 or x = 1").count() == 2
    assert blocks.voxels(spark, "zarr", str(tmp_path / "a")).where("y is null").count() == 0
    with pytest.raises(Exception, match="form is blocks or voxels"):
        spark.read.format("zarr").option("form", "rows").load(str(tmp_path / "a"))


# ---------------------------------------------------------------- writing

OPTIONS = {"shape": "24,20,40", "dtype": "int32", "chunk": "4,10,10"}


def pieces():
    """The cube in boxes that fit no grid."""
    return [((z, y, x), CUBE[z : z + 7, y : y + 9, x : x + 16]) for z in range(0, 24, 7) for y in range(0, 20, 9) for x in range(0, 40, 16)]


def beside(tmp_path):
    return [n for n in os.listdir(tmp_path) if ".part" in n]


@pytest.mark.parametrize("options", [{}, {"shard": "8,20,20"}, {"zarr_version": "2", "compressor": "zlib"}, {"order": "F", "shard": "8,20,20"}])
def test_written_by_df_write(spark, tmp_path, options):
    spark.dataSource.register(blocks.source("zarr"))
    path, shard = str(tmp_path / "a"), [8, 20, 20] if "shard" in options else None
    df = regions.laid_out(boxes(spark, *pieces()), CUBE.shape, [4, 10, 10], shard)
    df.write.format("zarr").mode("overwrite").options(**OPTIONS, **options).save(path)
    assert (array(path) == CUBE).all() and beside(tmp_path) == []
    # anew, with less in it: nothing of the first stays
    df.where(F.col("origin")[0] < 4).write.format("zarr").mode("overwrite").options(**OPTIONS, **options).save(path)
    assert (array(path)[:4] == CUBE[:4]).all() and not array(path)[4:].any()


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    spark.dataSource.register(blocks.source("zarr"))
    path = str(tmp_path / "a")
    df = regions.laid_out(boxes(spark, *pieces()), CUBE.shape, [4, 10, 10])
    bad = df.withColumn("data", F.when(F.col("origin")[2] >= 30, F.lit(b"x")).otherwise(F.col("data")))
    with pytest.raises(Exception):  # noqa: B017
        bad.write.format("zarr").mode("overwrite").options(**OPTIONS).save(path)
    assert os.listdir(tmp_path) == []
    df.write.format("zarr").mode("overwrite").options(**OPTIONS).save(path)
    for mode in ("overwrite", "append"):
        with pytest.raises(Exception):  # noqa: B017
            bad.write.format("zarr").mode(mode).options(**OPTIONS).save(path)
        assert (array(path) == CUBE).all() and beside(tmp_path) == []


def test_pieces_of_a_file_in_two_tasks_are_refused(spark, tmp_path):
    spark.dataSource.register(blocks.source("zarr"))
    path = str(tmp_path / "a")
    for parts in ([((0, 0, 0), CUBE[:2, :10, :10]), ((2, 0, 0), CUBE[2:4, :10, :10])], [((0, 0, 0), CUBE[:4, :10, :10])] * 2):
        with pytest.raises(Exception, match="use laid_out"):
            boxes(spark, *parts).write.format("zarr").mode("overwrite").options(**OPTIONS).save(path)
        assert os.listdir(tmp_path) == []
    with pytest.raises(Exception, match="shape and dtype"):
        boxes(spark, *pieces()).write.format("zarr").mode("append").save(path)
    with pytest.raises(Exception, match="from blocks"):
        spark.range(3).write.format("zarr").mode("append").options(**OPTIONS).save(path)
    with pytest.raises(Exception, match="isn't within"):
        regions.laid_out(boxes(spark, ((20, 0, 0), CUBE[:5])), CUBE.shape, [4, 10, 10]).collect()


@pytest.mark.parametrize("how", ["append", "region"])
@pytest.mark.parametrize("options", [{"chunk": (4, 10, 10)}, {"chunk": (4, 10, 10), "shard": (8, 20, 20)}, {"chunk": (4, 10, 10), "zarr_version": 2, "compressor": "zlib", "dimension_separator": "."}, {"chunk": (5, 7, 9)}])
def test_boxes_over_a_stored_array(spark, tmp_path, how, options):
    """Overlapping tiles written in several jobs equal one stitched volume."""
    path, want = str(tmp_path / "a"), np.zeros_like(CUBE)
    make(spark, path, want, **options)
    r = np.random.default_rng(3)
    for step in range(4):
        jobs = []
        for _ in range(3):
            lo = [int(r.integers(0, n)) for n in CUBE.shape]
            size = [int(r.integers(1, n - a + 1)) for n, a in zip(CUBE.shape, lo)]
            a = r.integers(-9, 9, size).astype(np.int32) if step < 3 else np.zeros(size, np.int32)
            jobs.append((lo, a))
        for lo, a in sorted(jobs, key=lambda x: x[0]):
            want[tuple(slice(o, o + n) for o, n in zip(lo, a.shape))] = a
        df = boxes(spark, *jobs)
        if how == "region":
            regions.write_region(path, df)
        else:
            regions.laid_out_for(path, df).write.format("zarr").mode("append").save(path)
        assert (array(path) == want).all()
    assert beside(tmp_path) == []


def test_untouched_chunks_of_a_shard_are_copied_as_they_lie(spark, tmp_path):
    path = str(tmp_path / "a")
    make(spark, path, CUBE, (4, 10, 10), (24, 20, 40))
    layout = zarr.opened(path)
    name = layout.file((0, 0, 0))
    before = layout.index_of(name)
    at, n = (int(x) for x in before[5, 1, 3])
    raw = bytearray(files.read(name))
    raw[at : at + n] = b"?" * n  # would fail if it were decoded
    files.write(name, bytes(raw))
    regions.write_region(path, boxes(spark, ((1, 1, 1), CUBE[:2, :2, :2])))
    after = layout.index_of(name)
    a, m = (int(x) for x in after[5, 1, 3])
    assert files.read(name, a, m) == b"?" * n
    assert (layout.read([(0, 4), (0, 10), (0, 10)])[1:3, 1:3, 1:3] == CUBE[:2, :2, :2]).all()
    # a box of zeros over all that a shard holds leaves no file
    regions.write_region(path, boxes(spark, ((0, 0, 0), np.zeros_like(CUBE))))
    assert not files.exists(name)


def test_stored_reads_levels(spark, tmp_path):
    make(spark, str(tmp_path / "0"), CUBE, (5, 7, 9))
    assert (stored(str(tmp_path)) == CUBE).all()
