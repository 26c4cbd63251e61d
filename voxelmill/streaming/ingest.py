"""Tiles that arrive while a microscope runs, placed as they land."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from voxelmill.operators.tiles import parsed, stem

#: What Spark's own file source gives.
FILES = "path string, modificationTime timestamp, length long, content binary"


def arriving(spark: SparkSession, folder: str, kind: str, pattern: str = "*.tiff", delay: str = "1 day") -> DataFrame:
    """A stream of tiles (path, y, z, ...) of files as they appear; of tiles that come twice within the
    watermark, the first stands."""
    files = spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", pattern).load(folder).select("path", "modificationTime", "length")
    t = parsed(files.withColumn("stem", stem(F.col("path"))), "stem", kind).where("y is not null and z is not null")
    return t.withWatermark("modificationTime", delay).dropDuplicatesWithinWatermark(["y", "z"])


def assembled(tiles: DataFrame, store: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hand each batch of new tiles to ``store`` once; a batch that is tried again has the same number."""
    return tiles.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
