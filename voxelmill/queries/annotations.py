"""Masks: content boxes, levels, label maps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelmill.operators import labels
from voxelmill.queries import query
from voxelmill.queries.views import SIDE, VOLUME, WIDTH, volume

MASK = f"{VOLUME}, mask as (select z, y, x, case when v > 300 and z % 6 <> 5 then v % 7 else 0 end as v from vol)"
BOX = f"""seen as (select z, min(y) filter (v > 0) as y0, max(y) filter (v > 0) as y1, min(x) filter (v > 0) as x0, max(x) filter (v > 0) as x1 from mask group by z),
box as (select z, case when y0 is null then -1 else greatest(y0 - 1, 0) end as top, case when y0 is null then -1 else greatest({SIDE - 2} - y1, 0) end as bottom,
  case when y0 is null then -1 else greatest(x0 - 1, 0) end as "left", case when y0 is null then -1 else greatest({WIDTH - 2} - x1, 0) end as "right" from seen)"""


def _mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return volume(spark, sf_dir).withColumn("v", F.when((F.col("v") > 300) & (F.col("z") % 6 != 5), F.col("v") % 7).otherwise(0))


@query(f'with {MASK}, {BOX} select z, top, bottom, "left", "right" from box')
def bbox_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.borders(_mask(spark, sf_dir), SIDE, WIDTH)


_SCALED = ", ".join(f'case when "{k}" < 0 then "{k}" else "{k}" * 4 end as "{k}"' for k in labels.BORDERS)


@query(f"with {MASK}, {BOX} select z, {_SCALED} from box")
def bbox_scaled_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.scaled(labels.borders(_mask(spark, sf_dir), SIDE, WIDTH), 4, 1)


@query(f"""with {MASK}, {BOX} select m.z, y, x, v from mask m join box b using (z)
where top >= 0 and y between top and {SIDE - 1} - bottom and x between "left" and {WIDTH - 1} - "right" """)
def mask_in_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    mask = _mask(spark, sf_dir)
    return labels.inside(mask, labels.borders(mask, SIDE, WIDTH), SIDE, WIDTH)


@query(f"with {MASK} select z, y, x, case v when 1 then 10 when 2 then 20 when 3 then 10 else v end as v from mask")
def label_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.remapped(_mask(spark, sf_dir), {1: 10, 2: 20, 3: 10}, strict=False)


@query(f"with {MASK} select z, v, count(*) as n from mask group by z, v")
def label_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.histogram(_mask(spark, sf_dir), ("z",))


@query(f"""with {VOLUME}, mask as (select z, y, x, case when v > 300 then 1 else 0 end as l from vol)
select l as label, count(*) as n, cast(sum(v) as bigint) as total from vol join mask using (z, y, x) group by l""")
def label_image_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image values under each label of a mask on the same grid."""
    image = volume(spark, sf_dir)
    mask = image.select("z", "y", "x", F.when(F.col("v") > 300, 1).otherwise(0).alias("label"))
    return image.join(mask, ["z", "y", "x"]).groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"))
