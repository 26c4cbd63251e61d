"""Tables and intermediate results of the text operators."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_written: dict[str, SparkSession] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` where the session names one.
    Only a session in one process, as in tests, may do without."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="voxelmill-"))
        named = spark.sparkContext.getCheckpointDir()
    return named


def scratch(spark: SparkSession) -> str:
    """A new name in the shared folder; what is written there is removed when the driver's process ends."""
    path = f"{shared_dir(spark)}/voxelmill/{uuid.uuid4().hex}"
    if not _written:
        atexit.register(_clean)
    _written[path] = spark
    return path


def materialise(df: DataFrame, rows: int | None = None, each: int = 1 << 18) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later jobs neither recompute it nor lose it
    with an executor. The files are removed when the driver's process ends, or by ``freeing``.

    Where about ``rows`` rows are known to come, at most one task for ``each`` of them writes, so small
    tables of narrow rows don't become a file for every shuffle partition."""
    path = scratch(df.sparkSession)
    (df if rows is None else df.coalesce(max(1, -(-rows // each)))).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def freeing(*keep: DataFrame) -> Iterator[list[DataFrame]]:
    """Remove, at the end, all tables written within, but for those that are put into the list given."""
    before, kept = {*_written}, list(keep)
    yield kept
    held = [f for df in kept for f in df.inputFiles()]
    for path in [p for p in _written if p not in before]:
        if not any(f"/{path.rpartition('/')[2]}/" in f for f in held):
            _remove(path)


def _remove(path: str) -> None:
    spark = _written.pop(path)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _clean() -> None:
    for path in [*_written]:
        try:
            _remove(path)
        except Exception:  # the JVM has ended, and what is left lies in the shared scratch folder
            return
