"""Boxes, axes, filling, chunks and stitching."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelmill.operators import compare, grid, stitch, tiles
from voxelmill.queries import query
from voxelmill.queries.views import ABSENT, CHUNK, SIDE, TILES, VOLUME, WIDTH, events_grid, shape, volume
from voxelmill.queries.views import EVENTS as EVENTS_SQL
from voxelmill.queries.views import tiles as inventory

AXES = ["z", "y", "x"]


@query(f"with {VOLUME} select z, y, x, v from vol")
def voxelize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return volume(spark, sf_dir)


@query(f"with {VOLUME} select z - 3 as z, y - 5 as y, x - 10 as x, v from vol where z >= 3 and z < 12 and y >= 5 and y < 15 and x >= 10 and x < 50")
def slice_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.box(volume(spark, sf_dir), {"z": (3, 12), "y": (5, 15), "x": (10, 50)}, rebase=True)


@query(f"with {VOLUME} select x as z, z as y, y as x, v from vol")
def transpose_axes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.transposed(volume(spark, sf_dir), {"z": "y", "y": "x", "x": "z"}).select(*AXES, "v")


@query(f"with {VOLUME} select z, y, x, v from vol where z < 7")
def depth_crop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.depth_crop(volume(spark, sf_dir), 7)


@query(f"""with {EVENTS_SQL}, lim as (select min(t) as t0, max(t) as t1, max(y) as y1 from evt),
full_grid as (select unnest(range(0, t1 - t0 + 1)) as t, y from (select t0, t1, unnest(range(0, y1 + 1)) as y from lim))
select g.t, g.y, coalesce(e.v, 0) as v from full_grid g left join (select t - t0 as t, y, v from evt, lim) e on g.t = e.t and g.y = e.y""")
def densify_zero_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    plane = events_grid(spark, sf_dir)
    t0, t1, y1 = plane.agg(F.min("t"), F.max("t"), F.max("y")).first()
    return grid.densify(grid.shifted(plane, {"t": -int(t0)}), {"t": int(t1) - int(t0) + 1, "y": int(y1) + 1})


@query(f"""with d as (select max(vec_id) // {SIDE} + 1 as n from embeddings),
c as (select cz, cy, cx, n from (select unnest(range((n + 7) // 8)) as cz, n from d), range(3) as a(cy), range(4) as b(cx))
select cz, cy, cx, cz * 8 as z_start, least(cz * 8 + 8, n) as z_stop, cy * 8 as y_start, least(cy * 8 + 8, {SIDE}) as y_stop,
  cx * 16 as x_start, least(cx * 16 + 16, {WIDTH}) as x_stop from c""")
def chunk_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.chunk_grid(spark, shape(spark, sf_dir), CHUNK)


@query(f"""with d as (select max(vec_id) // {SIDE} + 1 as n from embeddings)
select cz, cy, cx, (least(cz * 8 + 8, n) - cz * 8) * (least(cy * 8 + 8, {SIDE}) - cy * 8) * 16 as voxels
from (select unnest(range((n + 7) // 8)) as cz, n from d), range(3) as a(cy), range(4) as b(cx)""")
def chunk_clip_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = lambda k: F.col(f"{k}_stop") - F.col(f"{k}_start")
    return grid.chunk_grid(spark, shape(spark, sf_dir), CHUNK).select("cz", "cy", "cx", (size("z") * size("y") * size("x")).alias("voxels"))


@query(f"""with {VOLUME} select z // 8 as cz, y // 8 as cy, x // 16 as cx, count(v) as n, cast(sum(v) as bigint) as total, min(v) as least, max(v) as greatest
from vol group by 1, 2, 3""")
def chunk_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.chunk_stats(volume(spark, sf_dir), CHUNK)


@query(f"with {VOLUME} select z, y, x, v from vol")
def pack_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = shape(spark, sf_dir)
    return grid.unpack(grid.pack(volume(spark, sf_dir), list(s.values()), list(CHUNK.values()), "int32", fill=ABSENT), "int32", absent=ABSENT)


@query(f"""with {VOLUME} select z, y, x, v, z // 8 as cz, y // 8 as cy, x // 16 as cx from vol
where z >= 4 and z < 9 and x >= 20 and x < 40""")
def box_on_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.box_on_chunks(grid.with_chunks(volume(spark, sf_dir), CHUNK), {"z": (4, 9), "x": (20, 40)}, CHUNK)


def _strips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The volume as four strips of sixteen columns: tile, z, y, x (within the strip), v."""
    v = volume(spark, sf_dir)
    return v.select((F.col("x") / 16).cast("int").alias("tile"), "z", "y", F.pmod("x", F.lit(16)).alias("x"), "v")


def _stitched(spark: SparkSession, sf_dir: str, overlap: int, compat: bool = False) -> DataFrame:
    strips = spark.range(4).select(F.col("id").cast("int").alias("tile"), F.lit(16).alias("size"))
    layout = tiles.placed(strips, "tile", "size", overlap, compat)
    return stitch.stitched(_strips(spark, sf_dir), layout, "tile", "x").select(*AXES, "v")


def _strips_sql(overlap: int, compat: int = 0) -> str:
    head, tail = overlap // 2, -(-overlap // 2) + compat
    return f"""with {VOLUME}, s as (select z, y, x // 16 as tile, x % 16 as x, v from vol)
select z, y, tile * (16 - {overlap}) + x as x, v from s
where x >= case when tile > 0 then {head} else 0 end and x < 16 - case when tile < 3 then {tail} else 0 end"""


@query(_strips_sql(6))
def stitch_overlap_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stitched(spark, sf_dir, 6)


@query(_strips_sql(5))
def stitch_overlap_odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stitched(spark, sf_dir, 5)


@query(_strips_sql(5, 1))
def stitch_overlap_odd_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stitched(spark, sf_dir, 5, compat=True)


@query(_strips_sql(0))
def stitch_no_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stitched(spark, sf_dir, 0)


@query(f"""with {VOLUME}, s as (select z, y, x // 16 * 10 + x % 16 as x, x // 16 as tile, v from vol)
select z, y, x, arg_max(v, tile) as v from s group by z, y, x""")
def stitch_last_write_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = _strips(spark, sf_dir).withColumn("x", F.col("tile") * 10 + F.col("x"))
    return stitch.last_wins(moved, AXES, "tile")


@query(f"""with {VOLUME} select x % 4 as c, z * 2 + y // 10 as z, y % 10 as y, x // 4 as x, v from vol""")
def mosaic_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planes of two rows of tiles and four channels, as a four-dimensional volume."""
    v = volume(spark, sf_dir)
    parts = v.select(F.pmod("x", F.lit(4)).alias("c"), "z", (F.col("y") / 10).cast("int").alias("tile"), F.pmod("y", F.lit(10)).alias("y"), (F.col("x") / 4).cast("long").alias("x"), "v")
    rows = spark.range(2).select(F.col("id").cast("int").alias("tile"), F.lit(0).alias("plane"))
    return parts.join(F.broadcast(rows), "tile").select("c", (F.col("z") * 2 + F.col("tile") + F.col("plane")).alias("z"), "y", "x", "v")


@query(f"with {VOLUME}, r as (select z, rank() over (order by 's' || lpad(cast(z * 7 % 1000 as varchar), 4, '0')) - 1 as s from (select distinct z from vol)) select y, x, v, s from vol join r using (z)")
def stack_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names repeat beyond a thousand slices; those of one name share a place."""
    name = F.concat(F.lit("s"), F.lpad((F.col("z") * 7 % 1000).cast("string"), 4, "0"))
    named = volume(spark, sf_dir).withColumn("path", name)
    return stitch.stacked(named, "path", "s", key="z").select("y", "x", "v", "s")


_CENTRE = f"""with {VOLUME}, img as (select z, y, x, v from vol where y < {SIDE} - z % 7 and x < {WIDTH} - z % 5)"""


@query(f"""{_CENTRE}, sz as (select z, max(y) + 1 as h, max(x) + 1 as w from img group by z)
select z, y + ((select max(h) from sz) - h) // 2 as y, x + ((select max(w) from sz) - w) // 2 as x, v from img join sz using (z)""")
def center_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = volume(spark, sf_dir).where(f"y < {SIDE} - z % 7 and x < {WIDTH} - z % 5")
    sizes = images.groupBy("z").agg((F.max("y") + 1).alias("h"), (F.max("x") + 1).alias("w"))
    return stitch.centred(images, sizes, "z", {"y": "h", "x": "w"}).select(*AXES, "v")


DIFFERENT = f"""with {VOLUME}, b as (select z, y, x, v + case when x % 13 = 0 then 2 else 0 end as v from vol where y > 0)
select coalesce(a.z, b.z) as z, coalesce(a.y, b.y) as y, coalesce(a.x, b.x) as x, coalesce(a.v, 0) as "left", coalesce(b.v, 0) as "right"
from vol a full outer join b on a.z = b.z and a.y = b.y and a.x = b.x where coalesce(a.v, 0) <> coalesce(b.v, 0)"""


@query(DIFFERENT)
def array_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = volume(spark, sf_dir)
    b = a.where("y > 0").withColumn("v", F.col("v") + F.when(F.col("x") % 13 == 0, 2).otherwise(0))
    return compare.array_diff(a, b, AXES).where("left <> right")


@query(f"""with {TILES}, ends as (select min(y) as y0, max(y) as y1, min(z) as z0, max(z) as z1 from tiles),
g as (select unnest(range(y0, y1 + 1)) as y, z0, z1 from ends), grid as (select y, unnest(range(z0, z1 + 1)) as z from g)
select cast(y as integer) as y, cast(z as integer) as z from grid anti join tiles using (y, z)""")
def tile_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.missing(inventory(spark, sf_dir))




@query(f"with {VOLUME} select 0 as t, 0 as c, z, y, x, v from vol")
def axes_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A volume as an array of more axes."""
    return grid.with_axes(volume(spark, sf_dir), ["t", "c"]).select("t", "c", *AXES, "v")
