"""Tables and folders in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: dict[str, SparkSession] = {}


def scratch(spark: SparkSession, kind: str = "arrays") -> str:
    """A new place in the folder that ``spark.checkpoint.dir`` names; only a session in one process may do without."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="voxelmill-")
    return f"{named}/{kind}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table that is read again: made once, its size known to the planner, safe from lost executors. Removed when
    the driver's process ends."""
    spark = df.sparkSession
    path = scratch(spark, "tables")
    if not _written:
        atexit.register(_clean)
    _written[path] = spark
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _clean() -> None:
    for path, spark in _written.items():
        try:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the JVM has ended, and what is left lies in the shared scratch folder
            return
