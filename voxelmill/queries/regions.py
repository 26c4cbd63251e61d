"""Parts of stored volumes: conditions that choose what is opened, arrays by ``df.write``, boxes written into arrays."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelmill.operators import digests, grid
from voxelmill.plans.config import ArrayOptions
from voxelmill.queries import query
from voxelmill.queries.formats import _stored
from voxelmill.queries.geometry import DIFFERENT
from voxelmill.queries.pyramids import ALL_LEVELS
from voxelmill.queries.views import ABSENT, SIDE, VOLUME, shape, volume
from voxelmill.sinks import pyramids, regions
from voxelmill.sinks import zarr as sink
from voxelmill.sources.blocks import opened, source, voxels
from voxelmill.sources.shared import scratch


@query(f"with {VOLUME} select z, y, x, v from vol where z >= 3 and z < 21 and y in (2, 3, 17) and x > 40 and v < 0")
def zarr_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plain condition on a sharded array: shards and chunks outside it aren't opened."""
    path, _ = _stored(spark, sf_dir, ArrayOptions(chunk=(4, 10, 16), shard=(8, 20, 32)))
    return voxels(spark, "zarr", path).where("z >= 3 and z < 21 and y in (2, 3, 17) and x > 40 and v < 0")


@query(f"with {VOLUME} select z, y, x, v from vol where x = 20 and v <> 0")
def zarr_where_plane(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One plane across an array of format 2, without its zeros."""
    path, _ = _stored(spark, sf_dir, ArrayOptions(zarr_version=2, chunk=(8, 8, 16), compressor="zlib"))
    return voxels(spark, "zarr", path, sparse="true").where(F.col("x") == 20)


@query(f"with {VOLUME} select z, y, x, v from vol")
def zarr_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sharded array by ``df.write``, from blocks that don't fit its chunks."""
    size, path = list(shape(spark, sf_dir).values()), scratch(spark)
    blocks = regions.laid_out(grid.pack(volume(spark, sf_dir), size, [5, 7, 30], "int32", fill=ABSENT), size, [4, 10, 16], [8, 20, 32])
    spark.dataSource.register(source("zarr"))
    options = {"shape": ",".join(map(str, size)), "dtype": "int32", "chunk": "4,10,16", "shard": "8,20,32", "fill_value": str(ABSENT)}
    blocks.write.format("zarr").mode("overwrite").options(**options).save(path)
    return grid.unpack(opened(spark, "zarr", path)[0], "int32", absent=ABSENT)


def _slab(vol: DataFrame, size: list[int], first: int, last: int) -> DataFrame:
    """Blocks of slices first to last - 1, on a grid of their own."""
    own = grid.shifted(vol.where((F.col("z") >= first) & (F.col("z") < last)), {"z": -first})
    blocks = grid.pack(own, [last - first, *size[1:]], [5, 7, 30], "int32", fill=ABSENT)
    return blocks.withColumn("origin", F.transform("origin", lambda o, i: o + F.when(i == 0, first).otherwise(0)))


OVERLAPPING = f"with {VOLUME}, n as (select max(vec_id) // {SIDE} + 1 as n from embeddings) select z, y, x, case when z >= n // 3 then -v else v end as v from vol, n"


@query(OVERLAPPING)
def zarr_append_overlapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two jobs of ``df.write`` into one sharded array, the second over a part of the first."""
    size, path, vol = list(shape(spark, sf_dir).values()), scratch(spark), volume(spark, sf_dir)
    spark.dataSource.register(source("zarr"))
    options = {"shape": ",".join(map(str, size)), "dtype": "int32", "chunk": "4,10,16", "shard": "8,20,32", "fill_value": str(ABSENT)}
    first = _slab(vol, size, 0, max(1, 2 * size[0] // 3))
    regions.laid_out(first, size, [4, 10, 16], [8, 20, 32]).write.format("zarr").mode("append").options(**options).save(path)
    second = _slab(vol.withColumn("v", -F.col("v")), size, size[0] // 3, size[0])
    regions.laid_out_for(path, second).write.format("zarr").mode("append").save(path)
    return grid.unpack(opened(spark, "zarr", path)[0], "int32", absent=ABSENT)


@query(OVERLAPPING)
def zarr_region_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box written over a stored array of plain chunks, which it covers in part."""
    path, size = _stored(spark, sf_dir, ArrayOptions(zarr_version=2, chunk=(8, 8, 16), compressor="zlib", fill_value=ABSENT))
    regions.write_region(path, _slab(volume(spark, sf_dir).withColumn("v", -F.col("v")), size, size[0] // 3, size[0]))
    return grid.unpack(opened(spark, "zarr", path)[0], "int32", absent=ABSENT)


def _one_pass(spark: SparkSession, sf_dir: str, chunk: list[int], shard: list[int] | None) -> DataFrame:
    size, path = list(shape(spark, sf_dir).values()), scratch(spark)
    blocks = grid.pack(volume(spark, sf_dir), size, [5, 7, 30], "int32", fill=ABSENT)
    pyramids.write_levels(path, blocks, size, chunk, shard, "int32", ArrayOptions(fill_value=ABSENT), 3, [True] * 3)
    levels = [voxels(spark, "zarr", path, level=k).where(F.col("v") != ABSENT).select(F.lit(k).alias("level"), "z", "y", "x", "v") for k in range(4)]
    return reduce(DataFrame.unionByName, levels)


@query(ALL_LEVELS)
def pyramid_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four levels written while level 0 is, chunk by chunk along a Morton curve."""
    return _one_pass(spark, sf_dir, [4, 4, 8], None)


@query(ALL_LEVELS)
def pyramid_one_pass_sharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_pass(spark, sf_dir, [2, 4, 4], [4, 12, 16])


@query(DIFFERENT)
def array_diff_by_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stored arrays of different chunks, shards and codecs: only boxes whose digests differ are read for voxels."""
    path, size = _stored(spark, sf_dir, ArrayOptions(zarr_version=2, chunk=(8, 4, 4), compressor="zlib"))
    changed = volume(spark, sf_dir).where("y > 0").withColumn("v", F.col("v") + F.when(F.col("x") % 13 == 0, 2).otherwise(0))
    other = scratch(spark)
    sink.write_array(other, grid.pack(changed, size, [8, 20, 32], "int32"), size, [4, 10, 16], [8, 20, 32], "int32", ArrayOptions(), aligned=True)
    return digests.stored_diff(spark, path, other, grid.AXES)
