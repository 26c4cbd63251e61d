"""Anatomical orientation and voxel-to-world matrices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names of slicing planes, and the letter pairs of the three anatomical axes.
ALIASES = {"coronal": "LI", "axial": "LP", "sagittal": "PI"}
PAIRS = (("R", "L"), ("A", "P"), ("S", "I"))

Matrix = list[list[float]]


def normalised(orientation: str) -> str:
    """Three letters: aliases are spelled out, and a missing axis is added in the direction R, A or S."""
    code = ALIASES.get(orientation.lower(), orientation).upper()
    if len(code) == 2:
        code += next(plus for plus, minus in PAIRS if plus not in code and minus not in code)
    if len(code) != 3 or any((a in code) + (b in code) != 1 for a, b in PAIRS):
        raise ValueError(f"no orientation: {orientation!r}")
    return code


def affine(orientation: str, voxel_size: Sequence[float] = (1, 1, 1)) -> Matrix:
    """Columns are array axes, rows R, A, S; homogeneous."""
    out = [[0.0] * 4 for _ in range(4)]
    for axis, letter in enumerate(normalised(orientation)):
        row = next(k for k, pair in enumerate(PAIRS) if letter in pair)
        out[row][axis] = (1.0 if letter == PAIRS[row][0] else -1.0) * voxel_size[axis]
    out[3][3] = 1.0
    return out


def centred(matrix: Matrix, shape: Sequence[int]) -> Matrix:
    """The same with the world's origin in the middle of the volume."""
    out = [list(r) for r in matrix]
    for row in out[:3]:
        row[3] = -0.5 * sum(a * (n - 1) for a, n in zip(row[:3], shape, strict=True))
    return out


def chosen(loaded: Matrix | None, orientation: str | None, voxel_size: Sequence[float], shape: Sequence[int], center: bool) -> Matrix:
    """A loaded matrix stands only if neither an orientation (other than RAS) nor centring is asked for."""
    if loaded is not None and orientation in (None, "RAS") and not center:
        return loaded
    made = affine(orientation or "RAS", voxel_size)
    return centred(made, shape) if center else made


# ---------------------------------------------------------------- columns


def normalised_col(code: Column) -> Column:
    spelled = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for p in ALIASES.items() for x in p)), F.lower(code)), F.upper(code))
    absent = [(~spelled.contains(a) & ~spelled.contains(b), a) for a, b in PAIRS]
    extra = F.when(absent[0][0], absent[0][1]).when(absent[1][0], absent[1][1]).otherwise(absent[2][1])
    return F.when(F.length(spelled) == 2, F.concat(spelled, extra)).otherwise(spelled)


def affine_col(code: Column, voxel_size: Column) -> Column:
    """array<array<double>> of a three-letter code and an array of three sizes."""
    def entry(row: int, axis: int) -> Column:
        letter = F.substring(code, axis + 1, 1)
        plus, minus = PAIRS[row]
        return (F.when(letter == plus, 1.0).when(letter == minus, -1.0).otherwise(0.0) * voxel_size[axis]).cast("double")

    rows = [F.array(*(entry(r, a) for a in range(3)), F.lit(0.0)) for r in range(3)]
    return F.array(*rows, F.array(*(F.lit(float(k == 3)) for k in range(4))))


def centred_col(matrix: Column, shape: Column) -> Column:
    def move(row: Column) -> Column:
        terms = F.zip_with(F.slice(row, 1, 3), shape, lambda a, n: a * (n - 1))
        return F.concat(F.slice(row, 1, 3), F.array(F.lit(-0.5) * F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)))

    return F.concat(F.transform(F.slice(matrix, 1, 3), move), F.slice(matrix, 4, 1))


def chosen_col(loaded: Column, code: Column, voxel_size: Column, shape: Column, center: Column) -> Column:
    """``chosen`` for columns: ``loaded`` is null where there is no matrix, ``code`` is normalised."""
    made = affine_col(F.coalesce(code, F.lit("RAS")), voxel_size)
    stands = loaded.isNotNull() & (code.isNull() | (code == "RAS")) & ~center
    return F.when(stands, loaded).when(center, centred_col(made, shape)).otherwise(made)


def world_col(matrix: Column, point: Column) -> Column:
    """Where a voxel (array of three coordinates) is."""
    with_one = F.concat(point.cast("array<double>"), F.array(F.lit(1.0)))
    return F.transform(F.slice(matrix, 1, 3), lambda r: F.aggregate(F.zip_with(r, with_one, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x))
