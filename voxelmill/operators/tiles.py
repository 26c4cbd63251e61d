"""Tile inventories: one row per image tile, parsed from its name, checked and placed.

An inventory has y, z and usually sy, sz, sx (sizes) and dtype. Checks give the offending rows, so an
empty result is a pass; ``require_none`` turns one into an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxelmill.sources.shared import written

#: The name patterns of the supported acquisitions and the columns of their groups.
PATTERNS = {
    "mosaic": (r"^(\w*)_z(\d+)_y(\d+)(\w*)$", ("prefix", "z", "y", "suffix")),
    "multi_slice": (r"^(\w*)_y(\d+)_z(\d+)(\w*)$", ("prefix", "y", "z", "suffix")),
    "spool": (r"^(\w*)_run(\d+)_?_y(\d+)_z(\d+)(\w*)$", ("prefix", "run", "y", "z", "suffix")),
}
PLANE = r"_plane(\d+)_c(\d+)\.tiff?$"
_NUMBERS = {"run", "y", "z", "plane", "c"}


def bounded(df: DataFrame) -> DataFrame:
    """A table of one row per tile index or slice, written, so that what it is made from runs once and the planner, who
    then knows its bytes, may broadcast it."""
    return written(df)


def parsed(df: DataFrame, name: str, kind: str) -> DataFrame:
    """``df`` with the columns of the name pattern; names that don't match have nulls."""
    pattern, groups = PATTERNS[kind]
    got = {g: F.when(F.col(name).rlike(pattern), F.regexp_extract(name, pattern, k)) for k, g in enumerate(groups, 1)}
    return df.withColumns({g: c.cast("int") if g in _NUMBERS else c for g, c in got.items()})


def planes(df: DataFrame, name: str, parent: str) -> DataFrame:
    """plane and c of files called <parent>_plane###_c#.tiff; others are left out."""
    tail = F.substring(F.col(name), F.length(parent) + 1, F.length(name))
    ok = F.col(name).startswith(F.col(parent)) & tail.rlike("^" + PLANE)
    return df.where(ok).withColumns({"plane": F.regexp_extract(tail, PLANE, 1).cast("int"), "c": F.regexp_extract(tail, PLANE, 2).cast("int")})


def stem(path: Column) -> Column:
    """A file's name without folders and the last extension."""
    return F.regexp_replace(F.regexp_replace(path, r"/+$", ""), r"^.*/|\.[^./]*$", "")


def default_name(df: DataFrame) -> Column:
    return F.concat("prefix", "suffix")


def shape_conflicts(tiles: DataFrame) -> DataFrame:
    """Rows of one z must agree in sz, columns of one y in sy, all tiles in sx: rule, at, n (sizes)."""
    def rule(name: str, by: str | None, size: str) -> DataFrame:
        found = tiles.groupBy(F.lit(0).alias("at") if by is None else F.col(by).cast("long").alias("at")).agg(F.count_distinct(size).alias("n"))
        return found.where("n > 1").select(F.lit(name).alias("rule"), F.col("at").cast("long").alias("at"), "n")

    return rule("z extent", "z", "sz").unionByName(rule("y extent", "y", "sy")).unionByName(rule("x extent", None, "sx"))


def grid_of(tiles: DataFrame) -> DataFrame:
    """Every (y, z) between the least and greatest index."""
    ends = tiles.agg(F.min("y").alias("y0"), F.max("y").alias("y1"), F.min("z").alias("z0"), F.max("z").alias("z1")).where("y0 is not null")
    return ends.select(F.explode(F.sequence("y0", "y1")).alias("y"), "z0", "z1").select("y", F.explode(F.sequence("z0", "z1")).alias("z"))


def missing(tiles: DataFrame) -> DataFrame:
    return grid_of(tiles).join(tiles, ["y", "z"], "left_anti")


def duplicates(tiles: DataFrame) -> DataFrame:
    return tiles.groupBy("y", "z").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def dtype_groups(tiles: DataFrame) -> DataFrame:
    """How many tiles there are of each type: dtype, n."""
    return tiles.groupBy("dtype").agg(F.count(F.lit(1)).alias("n"))


def tiles_by_dtype(tiles: DataFrame) -> DataFrame:
    """The tiles of each type, a row for each: dtype, n (of the type), tile (as y/z)."""
    return tiles.join(bounded(dtype_groups(tiles)), "dtype").select("dtype", "n", F.format_string("%03d/%03d", "y", "z").alias("tile"))


def index_stats(tiles: DataFrame, axis: str) -> DataFrame:
    return tiles.agg(F.min(axis).alias("least"), F.max(axis).alias("greatest"), F.count_distinct(axis).alias("n"))


def placed(tiles: DataFrame, axis: str, size: str, overlap: int = 0, compat: bool = False) -> DataFrame:
    """Where each tile of an axis starts and what of it is kept.

    Adds start (in the volume), lo and hi (kept rows of the tile). An overlap is shared: the later tile
    loses its first half, rounded down, the earlier one the rest. ``compat`` loses one row more at an
    odd overlap and leaves it empty, for volumes that must be like ones assembled that way.

    The window runs over distinct indices of one axis, a few numbers however large the volume is."""
    sizes = tiles.groupBy(axis).agg(F.first(size).alias("_size"))
    by = Window.orderBy(axis)
    head, tail = overlap // 2, -(-overlap // 2) + (overlap % 2 if compat else 0)
    first, last = F.row_number().over(by) == 1, F.lead(axis).over(by).isNull()
    before = F.coalesce(F.sum(F.col("_size") - overlap).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    many = F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))) > 1
    lo = F.when(many & ~first, head).otherwise(0)
    out = sizes.select(axis, lo.cast("long").alias("lo"), (F.col("_size") - F.when(many & ~last, tail).otherwise(0)).cast("long").alias("hi"), (before + lo).cast("long").alias("start"))
    return tiles.join(bounded(out), axis)


def extent(tiles: DataFrame, axis: str, size: str, overlap: int = 0) -> DataFrame:
    """The volume's size on an axis: total."""
    sizes = tiles.groupBy(axis).agg(F.first(size).alias("s"))
    return sizes.agg((F.coalesce(F.sum("s"), F.lit(0)) - F.greatest(F.count("s") - 1, F.lit(0)) * overlap).alias("total"))


def require_none(found: DataFrame, what: str) -> None:
    """Raise if a check found rows; a few of them are named."""
    rows = found.limit(5).collect()
    if rows:
        raise ValueError(f"{what}: " + "; ".join(", ".join(f"{k}={v}" for k, v in r.asDict().items()) for r in rows))
