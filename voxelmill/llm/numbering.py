"""Gapless row numbers within a few large groups, without one task per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxelmill.llm.storage import materialise


def numbered(rows: DataFrame, group: str, fine: Column, order: list[str], name: str) -> DataFrame:
    """Number rows 0, 1, 2, ... within each value of ``group``. ``fine`` cuts a group into many parts of
    bounded number (say some thousands in all): rows are numbered within parts, and parts are placed
    behind one another by a prefix sum over their counts, which is small whatever the row count. Rows that tie
    in ``order`` are numbered in any order. Columns _part, _start and _nth, and one of that ``name``, are
    replaced."""
    rows = rows.drop("_part", "_start", "_nth", name)
    cut = materialise(rows.withColumn("_part", fine))
    window = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        cut.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_start", F.coalesce(F.sum("_rows").over(window), F.lit(0)))
        .select(group, "_part", "_start")
    )
    within = Window.partitionBy(group, "_part").orderBy(*order)
    return (
        cut.withColumn("_nth", F.row_number().over(within))
        .join(F.broadcast(starts), [group, "_part"])
        .withColumn(name, (F.col("_start") + F.col("_nth") - 1).cast("long"))
        .drop("_part", "_start", "_nth")
    )
