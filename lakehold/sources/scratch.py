"""Scratch tables in the shared folder that the session names in spark.checkpoint.dir.

A scratch table cuts lineage like ``checkpoint()``, but is columnar, so readers prune columns.
Every executor can read it, and it survives a lost executor. The tables of a Python process go
when that process ends.
"""
from __future__ import annotations

import atexit
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from lakehold.session import ensure_checkpoint_dir

_made: list[tuple[SparkSession, str]] = []


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path in the shared folder; removed when the Python process ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


# Spark's own switch: shuffle files of an execution go when it ends, not when the driver collects garbage
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock, _inside = threading.Lock(), {}


@contextmanager
def shuffles_end(spark: SparkSession):
    """Within the block, an execution's shuffle files are removed at its end. The session's value comes
    back when the last of the blocks that run side by side is left."""
    with _lock:
        n, before = _inside.get(spark, (0, spark.conf.get(CLEANUP, None)))
        _inside[spark] = n + 1, before
        if before is not None:
            spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            n, before = _inside.pop(spark)
            if n > 1:
                _inside[spark] = n - 1, before
            elif before is not None:
                spark.conf.set(CLEANUP, before)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back. What was shuffled for it is
    not needed any more and goes."""
    spark = df.sparkSession
    path = new_path(spark, name)
    with shuffles_end(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@atexit.register
def _sweep() -> None:
    for spark, path in _made:
        sc = spark.sparkContext
        if sc._jsc is not None and sc._gateway is not None:
            target = sc._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)
