"""Differences between two volumes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def array_diff(a: DataFrame, b: DataFrame, axes: Sequence[str], v: str = "v", fill: float = 0) -> DataFrame:
    """Both values of every voxel that either has; absent ones are ``fill``."""
    left, right = a.select(*axes, F.col(v).alias("left")), b.select(*axes, F.col(v).alias("right"))
    return left.join(right, list(axes), "full_outer").withColumns({c: F.coalesce(c, F.lit(fill)) for c in ("left", "right")})


def summary(diff: DataFrame, rtol: float = 1e-6, atol: float = 1e-8) -> DataFrame:
    """n, n_different (beyond the tolerances), largest difference; NaNs are equal to one another."""
    gap = F.abs(F.col("left") - F.col("right"))
    far = ~F.col("left").eqNullSafe(F.col("right")) & ~(gap <= atol + rtol * F.abs("right"))
    return diff.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(far.cast("long")), F.lit(0)).alias("n_different"), F.max(F.when(~F.isnan(gap.cast("double")), gap)).alias("largest"))


def metadata_diff(a: dict, b: dict, at: str = "") -> list[str]:
    """Paths at which two JSON documents differ."""
    if isinstance(a, dict) and isinstance(b, dict):
        return [x for k in sorted({*a, *b}) for x in (metadata_diff(a[k], b[k], f"{at}/{k}") if k in a and k in b else [f"{at}/{k}"])]
    return [] if a == b else [at or "/"]
