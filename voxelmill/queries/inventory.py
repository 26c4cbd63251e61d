"""Tile names, checks and places."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelmill.functions import arithmetic, naming
from voxelmill.operators import tiles
from voxelmill.queries import query
from voxelmill.queries.views import TILES, names, read
from voxelmill.queries.views import tiles as inventory


#: What the names were made of, so that the SQL needs no pattern.
_FROM = "select o_orderkey as id, cast(o_custkey % 23 as integer) as y, cast(o_orderkey % 17 as integer) as z, lower(o_orderstatus) as s, o_orderstatus as big, o_custkey as k from orders"


def _parsed(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return tiles.parsed(names(spark, sf_dir), kind, kind).select("id", *tiles.PATTERNS[kind][1])


@query(f"""with n as ({_FROM}), ok as (select *, id % 5 <> 0 as ok from n)
select id, case when ok then s end as prefix, case when ok then z end as z, case when ok then y end as y, case when ok then '_HR' end as suffix from ok""")
def tile_parse_mosaic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir, "mosaic")


@query(f"""with n as ({_FROM}) select id, big as prefix, y, cast(id % 170 as integer) as z, case when id % 3 = 0 then '_A' else '' end as suffix from n""")
def tile_parse_multislice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir, "multi_slice")


@query(f"""with n as ({_FROM}) select id, s as prefix, cast(k % 4 as integer) as run, y, z, '_HR' as suffix from n""")
def tile_parse_spool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir, "spool")


@query(f"""with n as ({_FROM}) select id, cast(id % 40 as integer) as plane, cast(k % 4 as integer) as c from n where id % 9 <> 0""")
def tile_parse_plane(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = names(spark, sf_dir).withColumnRenamed("plane", "file")
    tail = F.substring(F.col("file"), F.length("mosaic") + 1, F.length("file"))
    ok = tail.rlike("^" + tiles.PLANE)
    return rows.where(ok).select("id", F.regexp_extract(tail, tiles.PLANE, 1).cast("int").alias("plane"), F.regexp_extract(tail, tiles.PLANE, 2).cast("int").alias("c"))


@query(f"""with {TILES} select 'z extent' as rule, cast(z as bigint) as at, count(distinct sz) as n from tiles group by z having count(distinct sz) > 1
union all select 'y extent', cast(y as bigint), count(distinct sy) from tiles group by y having count(distinct sy) > 1
union all select 'x extent', cast(0 as bigint), count(distinct sx) from tiles having count(distinct sx) > 1""")
def tile_shape_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.shape_conflicts(inventory(spark, sf_dir))


@query(f"with {TILES} select y, z, count(*) as n from tiles group by y, z having count(*) > 1")
def tile_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.duplicates(inventory(spark, sf_dir))


@query(f"""with {TILES}, one as (select distinct y, z, dtype from tiles)
select dtype, count(*) over (partition by dtype) as n, format('{{:03d}}/{{:03d}}', y, z) as tile from one""")
def tile_dtype_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.tiles_by_dtype(inventory(spark, sf_dir).select("y", "z", "dtype").distinct())


@query(f"with {TILES} select min(y) as least, max(y) as greatest, count(distinct y) as n from tiles")
def tile_index_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.index_stats(inventory(spark, sf_dir), "y")


@query(f"""with {TILES}, s as (select distinct y, 64 + y % 3 as size from tiles),
w as (select y, size, coalesce(sum(size - 7) over (order by y rows between unbounded preceding and 1 preceding), 0) as before,
  row_number() over (order by y) as k, count(*) over () as n from s)
select y, size, cast(case when k > 1 then 3 else 0 end as bigint) as lo, cast(size - case when k < n then 4 else 0 end as bigint) as hi,
  cast(before + case when k > 1 then 3 else 0 end as bigint) as "start" from w""")
def tile_offsets_prefix_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = inventory(spark, sf_dir).select("y", (F.lit(64) + F.col("y") % 3).alias("size")).distinct()
    return tiles.placed(sizes, "y", "size", 7)


@query(f"with {TILES}, s as (select distinct y, 64 + y % 3 as size from tiles) select cast(sum(size) - (count(*) - 1) * 30 as bigint) as total from s")
def volume_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = inventory(spark, sf_dir).select("y", (F.lit(64) + F.col("y") % 3).alias("size")).distinct()
    return tiles.extent(sizes, "y", "size", 30)


@query(f"""with {TILES}, k as (select y, z, max(item * 8 + line) as pick from tiles group by y, z)
select g.y, g.z, k.pick from (select unnest(range(0, 40)) as y) a, (select unnest(range(3, 28)) as z) b, lateral (select cast(a.y as integer) as y, cast(b.z as integer) as z) g
left join k on k.y = g.y and k.z = g.z""")
def tile_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place of the grid with the tile that was written last, null where there is none."""
    all_ = inventory(spark, sf_dir)
    last = all_.groupBy("y", "z").agg(F.max(F.col("item") * 8 + F.col("line")).alias("pick"))
    places = spark.range(40).select(F.col("id").cast("int").alias("y"), F.explode(F.sequence(F.lit(3), F.lit(27))).alias("z"))
    return places.join(last, ["y", "z"], "left")


_GRID = """with n as (select o_orderkey % 560 + 1 as n, min(o_orderkey) as k from orders group by 1)"""


@query(f"""{_GRID}, p as (select n, (n - 1) // 28 as col, (n - 1) % 28 as r from n)
select n, case when col % 2 = 1 then 27 - r else r end as "row", col as "column" from p""")
def grid_order_snake(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "orders").select((F.col("o_orderkey") % 560 + 1).alias("n")).distinct()
    row, column = naming.grid_place(F.col("n"), 20, 28)
    return n.select("n", row.alias("row"), column.alias("column"))


@query(f"""{_GRID}, p as (select n, (n - 1) // 20 as r, (n - 1) % 20 as c from n)
select n, 27 - r as "row", 19 - c as "column", (27 - r) * 270.0 as y, (19 - c) * 180.0 as x from p""")
def grid_order_raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "orders").select((F.col("o_orderkey") % 560 + 1).alias("n")).distinct()
    row, column = naming.grid_place(F.col("n"), 20, 28, "row-by-row", "left-up")
    y, x = naming.tile_position(F.col("row"), F.col("column"), 300, 200, 0.1)
    return n.select("n", row.alias("row"), column.alias("column")).select("n", "row", "column", y.cast("double").alias("y"), x.cast("double").alias("x"))


@query("""select o_orderkey as id, reverse(lpad(cast(o_orderkey as varchar), 10, '0')) || 'spool.dat' as file, o_orderkey as idx from orders""")
def spool_file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), naming.spool_name(F.col("o_orderkey")).alias("file"))
    return named.withColumn("idx", naming.spool_index(F.col("file")))


@query("""select o_orderkey as id, cast(ceil((o_custkey + 100 - o_orderkey % 50) / 128.0) as bigint) as files from orders""")
def spool_prune_background(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("id"), naming.spool_files_kept(F.col("o_custkey") + 100, F.col("o_orderkey") % 50, F.lit(128)).alias("files"))


@query("""select distinct p_size % 12 as level, case when p_size % 12 = 0 then '1' else cast(1 << (p_size % 12) as varchar) || '-' || cast(1 << (p_size % 12) as varchar) || '-1' end as folder from part""")
def mask_level_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = read(spark, sf_dir, "part").select((F.col("p_size") % 12).alias("level")).distinct()
    return levels.withColumn("folder", naming.mask_level(F.col("level")))


@query("""select p_partkey as id, 'c/' || p_partkey % 7 || '/' || p_size || '/' || p_partkey % 11 as v3, p_partkey % 7 || '.' || p_size || '.' || p_partkey % 11 as v2 from part""")
def chunk_key_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = F.array(F.col("p_partkey") % 7, F.col("p_size").cast("long"), F.col("p_partkey") % 11)
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), naming.chunk_key(index, 3).alias("v3"), naming.chunk_key(index, 2).alias("v2"))


@query("""select o_orderkey as id, lower(o_orderstatus) || '_HR' as name, '/data/' || lower(o_orderstatus) as folder from orders where o_orderkey % 5 <> 0""")
def default_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an output is called that was given no name, and names without folders and extensions."""
    t = tiles.parsed(names(spark, sf_dir), "mosaic", "mosaic").where("z is not null")
    folder = F.concat(F.lit("/data/"), tiles.stem(F.concat(F.lit("/a.b/c/"), F.col("prefix"), F.lit(".tiff"))))
    return t.select("id", tiles.default_name(t).alias("name"), folder.alias("folder"))


@query("""select o_orderkey as id, cast(floor((o_custkey - 700) / 7.0) as bigint) as down, cast(ceil((o_custkey - 700) / 7.0) as bigint) as up from orders""")
def division_both_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotients rounded down and up, of negative numbers too."""
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") - 700).alias("n"))
    return o.select("id", arithmetic.floor_div("n", 7).alias("down"), arithmetic.ceil_div("n", 7).alias("up"))
