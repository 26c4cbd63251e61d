"""Levels, projections and their metadata."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelmill.operators import pyramid
from voxelmill.plans import levels
from voxelmill.queries import query
from voxelmill.queries.views import EVENTS, VOLUME, events_grid, read, shape, volume

DEPTH = "(select max(vec_id) // 20 + 1 from embeddings)"


def _level_sql(value: str, where: str = "", cells: str = "z // 2 as z, y // 2 as y, x // 2 as x") -> str:
    return f"with {VOLUME} select z, y, x, {value} as v from (select {cells}, v from vol where z < {DEPTH} // 2 * 2 {where}) group by z, y, x"


@query(_level_sql("cast(trunc(avg(v)) as integer)"))
def pyramid_mean_l1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pyramid.coarsened(volume(spark, sf_dir), shape(spark, sf_dir), "mean", dense=True)


@query(_level_sql("cast(trunc(sum(v) / 8) as integer)", "and x % 3 <> 1"))
def pyramid_mean_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absent voxels are zeros."""
    return pyramid.coarsened(volume(spark, sf_dir).where("x % 3 <> 1"), shape(spark, sf_dir), "mean")


@query(_level_sql("cast(trunc(median(v)) as integer)"))
def pyramid_median_l1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pyramid.coarsened(volume(spark, sf_dir), shape(spark, sf_dir), "median", dense=True)


@query(_level_sql("max(v)"))
def pyramid_max_l1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pyramid.coarsened(volume(spark, sf_dir), shape(spark, sf_dir), "max", dense=True)


@query(_level_sql("cast(trunc(sum(v) / sqrt(count(*))) as integer)"))
def pyramid_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any aggregate of the value column can reduce."""
    return pyramid.coarsened(volume(spark, sf_dir), shape(spark, sf_dir), lambda v: F.sum(v) / F.sqrt(F.count(v)), dense=True)


@query(f"with {VOLUME} select z, y // 2 as y, x // 2 as x, cast(trunc(avg(v)) as integer) as v from vol group by 1, 2, 3")
def pyramid_skip_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pyramid.coarsened(volume(spark, sf_dir), shape(spark, sf_dir), "mean", skip=["z"], dense=True)


@query(f"""with {VOLUME}, f as (select z // 2 as z, y // 2 as y, x // 2 as x, case when (x + y) % 3 = 0 then null else v end as v from vol where z < {DEPTH} // 2 * 2)
select z, y, x, round(avg(v), 6) as v from f group by z, y, x""")
def pyramid_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    holed = volume(spark, sf_dir).withColumn("v", F.when((F.col("x") + F.col("y")) % 3 == 0, float("nan")).otherwise(F.col("v").cast("double")))
    out = pyramid.coarsened(holed, shape(spark, sf_dir), "mean", dense=True)
    return out.withColumn("v", F.round(F.when(~F.isnan("v"), F.col("v")), 6))


ALL_LEVELS = f"""with {VOLUME},
l1 as (select z, y, x, cast(trunc(avg(v)) as integer) as v from (select z // 2 as z, y // 2 as y, x // 2 as x, v from vol where z < {DEPTH} // 2 * 2) group by z, y, x),
l2 as (select z, y, x, cast(trunc(avg(v)) as integer) as v from (select z // 2 as z, y // 2 as y, x // 2 as x, v from l1 where z < {DEPTH} // 4 * 2) group by z, y, x),
l3 as (select z, y, x, cast(trunc(avg(v)) as integer) as v from (select z // 2 as z, y // 2 as y, x // 2 as x, v from l2 where z < {DEPTH} // 8 * 2 and y < 4) group by z, y, x)
select 0 as level, * from vol union all select 1, * from l1 union all select 2, * from l2 union all select 3, * from l3"""


@query(ALL_LEVELS)
def pyramid_mean_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four levels, each made from the one before, since fractions are cut off between them."""
    parts = [df.select(F.lit(level).alias("level"), "z", "y", "x", "v") for level, _, df in pyramid.levels(volume(spark, sf_dir), shape(spark, sf_dir), 3, dense=True)]
    return reduce(DataFrame.unionByName, parts)


@query(f"with {VOLUME} select y, x, max(v) as v from vol group by y, x")
def mip_z(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pyramid.projected(volume(spark, sf_dir), "z")


@query(f"""with {EVENTS}, t as (select t - (select min(t) from evt) as t, y, v from evt)
select t // 2 as t, y, cast(trunc(sum(v) / 2) as bigint) as v from t where t < (select max(t) + 1 from t) // 2 * 2 group by 1, 2""")
def time_downsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours in pairs; an hour without events counts as zero."""
    plane = events_grid(spark, sf_dir)
    t0, t1 = plane.agg(F.min("t"), F.max("t")).first()
    return pyramid.coarsened(plane.withColumn("t", F.col("t") - t0), {"t": int(t1 - t0) + 1}, "mean")


_SIZES = "select p_partkey as id, p_partkey * 37 % 5000 + 1 as sz, p_size * 64 as sy, p_partkey % 3000 + 1 as sx from part"


@query(f"""with s as ({_SIZES})
select id, cast(greatest(0, ceil(log2(ceil(sz / 128.0))), ceil(log2(ceil(sy / 128.0))), ceil(log2(ceil(sx / 128.0)))) as bigint) as levels,
  greatest(1, sz // 2) as next_z, cast(greatest(1, sy // 2) as bigint) as next_y, greatest(1, sx // 2) as next_x from s""")
def pyramid_levels_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    s = read(spark, sf_dir, "part").select(k.alias("id"), (k * 37 % 5000 + 1).alias("sz"), (F.col("p_size") * 64).cast("long").alias("sy"), (k % 3000 + 1).alias("sx"))
    return s.select("id", levels.levels_col([F.col("sz"), F.col("sy"), F.col("sx")], 128).alias("levels"), *(levels.next_size_col(F.col(f"s{a}")).alias(f"next_{a}") for a in "zyx"))


@query("""select p_partkey as id, l.level, (p_size / 4.0) * (1 << l.level) as scale, (p_size / 4.0) * ((1 << l.level) - 1) / 2 as translation
from part, (select unnest(range(0, 6)) as level) l""")
def ome_scale_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), (F.col("p_size") / 4.0).alias("s"), F.explode(F.sequence(F.lit(0), F.lit(5)).cast("array<bigint>")).alias("level"))
    scale, move = levels.transform_cols(F.col("level"), F.col("s"))
    return rows.select("id", "level", scale.cast("double").alias("scale"), move.cast("double").alias("translation"))
