"""Names and numbers of tiles, files, chunks and masks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxelmill.functions.arithmetic import floor_div

#: Grid types, and the directions that each takes.
ROWS, COLUMNS = ("row-by-row", "snake-by-rows"), ("column-by-column", "snake-by-columns")
ROW_ORDERS, COLUMN_ORDERS = ("right-down", "left-down", "right-up", "left-up"), ("down-right", "down-left", "up-right", "up-left")


def grid_place(number: Column, columns: int, rows: int, grid: str = "snake-by-columns", order: str | None = None) -> tuple[Column, Column]:
    """Row and column of a tile, counted from 1 in the order of acquisition.

    Tiles run along lines (rows or columns); in a snake every second line runs backwards; the directions
    then mirror both axes."""
    by_rows = grid in ROWS
    order = order or ("right-down" if by_rows else "down-right")
    if order not in (ROW_ORDERS if by_rows else COLUMN_ORDERS) or grid not in (*ROWS, *COLUMNS):
        raise ValueError(f"no such grid: {grid}, {order}")
    length = columns if by_rows else rows
    line, place = floor_div(number - 1, length), F.pmod(number - 1, F.lit(length))
    if grid.startswith("snake"):
        place = F.when(line % 2 == 1, length - 1 - place).otherwise(place)
    row, column = (line, place) if by_rows else (place, line)
    if "up" in order:
        row = rows - 1 - row
    if "left" in order:
        column = columns - 1 - column
    return row.cast("long"), column.cast("long")


def tile_position(row: Column, column: Column, size_y: int, size_x: int, overlap: float = 0.0) -> tuple[Column, Column]:
    """Pixels from the grid's corner; an overlap (a share of the tile) draws tiles together."""
    return row * (size_y * (1 - overlap)), column * (size_x * (1 - overlap))


def spool_index(name: Column) -> Column:
    """The number in a spool file's name, ten digits written backwards."""
    return F.reverse(F.regexp_extract(name, r"([0-9]{10})spool\.dat$", 1)).try_cast("long")


def spool_name(index: Column) -> Column:
    return F.concat(F.reverse(F.lpad(index.cast("string"), 10, "0")), F.lit("spool.dat"))


def spool_files_kept(series: Column, background: Column, per_file: Column) -> Column:
    """How many files hold frames other than background."""
    return F.ceil((series - background) / per_file).cast("long")


def mask_level(level: Column) -> Column:
    """The folder of a mask at a level: 1, 2-2-1, 4-4-1, ..."""
    side = F.pow(F.lit(2), level).cast("long").cast("string")
    return F.when(level == 0, "1").otherwise(F.concat(side, F.lit("-"), side, F.lit("-1")))


def chunk_key(index: Column, version: int = 3, separator: str | None = None) -> Column:
    """The file of a chunk (array of indices): c/0/0/0 in version 3, 0.0.0 in version 2."""
    parts = F.array_join(index.cast("array<string>"), separator or ("/" if version == 3 else "."))
    return F.concat(F.lit("c" + (separator or "/")), parts) if version == 3 else parts


def intensity_variation(v: Column, share: Column | float, least: Column | int, greatest: Column | int) -> Column:
    """An image scaled by 1 + share and wrapped into its range: variants of test images."""
    span = greatest - least + 1
    return (F.pmod(v * (1 + share) - least, F.lit(span) if isinstance(span, int) else span) + least).cast("long")


def experiment_key(keys: Column, fiji: bool = False) -> Column:
    """Of a file's variables, the first with Experiment_Fiji, or else the last with Experiment; none is an error."""
    first = F.filter(keys, lambda k: k.contains("Experiment_Fiji"))
    last = F.filter(keys, lambda k: k.contains("Experiment"))
    found = F.get(first, F.lit(0)) if fiji else F.get(last, F.size(last) - 1)
    return F.coalesce(found, F.raise_error(F.lit("no experiment among the variables")).cast("string"))
