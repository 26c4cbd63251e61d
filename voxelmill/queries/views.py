"""The supplied tables seen as volumes, tile inventories and metadata, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelmill.functions.arithmetic import floor_div
from voxelmill.operators.grid import voxelize

SIDE, WIDTH = 20, 64
CHUNK = {"z": 8, "y": 8, "x": 16}
#: What stands in arrays for voxels that the volume lacks; no element in thousandths comes to it.
ABSENT = -(1 << 31)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """z, y, x, v: vectors in rows of twenty, elements in thousandths."""
    rows = read(spark, sf_dir, "embeddings").select(floor_div("vec_id", SIDE).alias("z"), F.pmod("vec_id", F.lit(SIDE)).alias("y"), F.col("embedding"))
    return voxelize(rows, "embedding", "x", ["z", "y"]).withColumn("v", F.floor(F.col("v").cast("double") * 1000).cast("int"))


def depth(spark: SparkSession, sf_dir: str) -> int:
    """Slices of the volume, from the parquet statistics."""
    return int(read(spark, sf_dir, "embeddings").agg(F.max("vec_id")).first()[0]) // SIDE + 1


def shape(spark: SparkSession, sf_dir: str) -> dict[str, int]:
    return {"z": depth(spark, sf_dir), "y": SIDE, "x": WIDTH}


VOLUME = f"""
vol as (
  select z, y, x, cast(floor(cast(e as double) * 1000) as integer) as v from (
    select vec_id // {SIDE} as z, vec_id % {SIDE} as y, unnest(range(len(embedding))) as x, unnest(embedding) as e from embeddings)
)"""


def events_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """t (hour), y (user), v (sum of values in thousandths): a sparse plane."""
    rows = read(spark, sf_dir, "events").select(
        floor_div(F.unix_timestamp(F.col("ts").cast("timestamp")), 3600).alias("t"), F.col("user_id").alias("y"), F.floor(F.col("value") * 1000).cast("long").alias("v")
    )
    return rows.groupBy("t", "y").agg(F.sum("v").alias("v"))


EVENTS = """
evt as (
  select t, y, cast(sum(v) as bigint) as v from (
    select cast(floor(epoch(ts)) as bigint) // 3600 as t, user_id as y, cast(floor(value * 1000) as bigint) as v from events) group by t, y
)"""


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An inventory with duplicates, gaps and odd sizes, made of line items: y, z, sy, sz, sx, dtype, item."""
    return read(spark, sf_dir, "lineitem").select(
        F.pmod("l_orderkey", F.lit(40)).cast("int").alias("y"), (F.pmod("l_partkey", F.lit(25)) + 3).cast("int").alias("z"),
        F.when(F.col("l_quantity") > 49, 65).otherwise(64).alias("sy"), F.when(F.col("l_discount") > 0.095, 11).otherwise(10).alias("sz"), F.lit(256).alias("sx"),
        F.when(F.col("l_tax") > 0.075, "uint8").otherwise("uint16").alias("dtype"), F.col("l_orderkey").alias("item"), F.col("l_linenumber").alias("line"),
    ).where("(y + z) % 11 <> 0")


TILES = """
tiles as (
  select * from (select cast(l_orderkey % 40 as integer) as y, cast(l_partkey % 25 + 3 as integer) as z,
    case when l_quantity > 49 then 65 else 64 end as sy, case when l_discount > 0.095 then 11 else 10 end as sz, 256 as sx,
    case when l_tax > 0.075 then 'uint8' else 'uint16' end as dtype, l_orderkey as item, l_linenumber as line from lineitem) where (y + z) % 11 <> 0
)"""


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names of every supported kind, some broken: id, mosaic, multi_slice, spool, plane."""
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("s"))
    mosaic = F.format_string("%s_z%02d_y%02d%s", F.lower("s"), F.col("id") % 17, F.col("k") % 23, F.when(F.col("id") % 5 == 0, "-x").otherwise("_HR"))
    return o.select(
        "id", mosaic.alias("mosaic"), F.format_string("%s_y%d_z%03d%s", "s", F.col("k") % 23, F.col("id") % 170, F.when(F.col("id") % 3 == 0, "_A").otherwise("")).alias("multi_slice"),
        F.format_string("%s_run%d_%sy%02d_z%02d_HR", F.lower("s"), F.col("k") % 4, F.when(F.col("id") % 2 == 0, "_").otherwise(""), F.col("k") % 23, F.col("id") % 17).alias("spool"),
        F.concat(mosaic, F.format_string("_plane%03d_c%d.%s", F.col("id") % 40, F.col("k") % 4, F.when(F.col("id") % 9 == 0, "png").otherwise("tiff"))).alias("plane"),
    )


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata texts, made of parts: id, size, note."""
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("size"), F.round("p_retailprice").cast("long").alias("price"))
    return p.select(
        "id", "size",
        F.concat(
            F.lit("Image medium: 60% "), F.when(F.col("id") % 2 == 0, "TDE").otherwise("water"), F.lit("\nCenter Wavelength: "), F.col("price").cast("string"),
            F.lit(".5nm\nFOV: 3x3mm\nVoxel size: "), F.concat_ws("x", F.col("size").cast("string"), (F.col("size") + 1).cast("string"), F.lit("3")),
            F.lit("um\nNumber of focuses: 2\nSlice thickness: "), F.when(F.col("id") % 3 == 0, "0.25mm").otherwise(F.concat((F.col("size") * 10).cast("string"), F.lit("um."))),
            F.lit("\nNumber of slices: "), F.col("size").cast("string"), F.when(F.col("id") % 4 == 0, "\nModality: dBI: raw").otherwise("\nno colon here"),
        ).alias("note"),
    )


NOTES = """
notes as (
  select p_partkey as id, p_size as size, 'Image medium: 60% ' || case when p_partkey % 2 = 0 then 'TDE' else 'water' end || chr(10) || 'Center Wavelength: ' || cast(round(p_retailprice) as bigint)
    || '.5nm' || chr(10) || 'FOV: 3x3mm' || chr(10) || 'Voxel size: ' || p_size || 'x' || (p_size + 1) || 'x3um' || chr(10) || 'Number of focuses: 2' || chr(10) || 'Slice thickness: '
    || case when p_partkey % 3 = 0 then '0.25mm' else (p_size * 10) || 'um.' end || chr(10) || 'Number of slices: ' || p_size
    || case when p_partkey % 4 = 0 then chr(10) || 'Modality: dBI: raw' else chr(10) || 'no colon here' end as note from part
)"""
