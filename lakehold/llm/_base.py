"""Helpers that several of the operators share."""
from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "1000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def total_bytes(df: DataFrame, column: str) -> int:
    """Bytes of all values of a text or binary column."""
    return df.agg(F.sum(F.octet_length(column)).alias("n")).first()["n"] or 0


def parts(n_bytes: int, per_part: int) -> int:
    return max(1, -(-int(n_bytes) // per_part))


def give_back() -> None:
    """Return what a task has freed to the system: Python workers live on and share the executor's memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def mapped(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[dict]], schema: str) -> DataFrame:
    """``mapInArrow`` for functions that yield dicts of column -> list.

    Record batches of long texts are kept small, unless the session says otherwise.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out = to_arrow_schema(StructType.fromDDL(schema))
    if df.sparkSession.conf.get(BATCH, None) is None:
        df.sparkSession.conf.set(BATCH, BATCH_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in fn(batches):
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type)
                 for f, c in zip(out, columns.values(), strict=True)], schema=out)
        give_back()

    return df.mapInArrow(run, schema)


def slices(batches: Iterable[pa.RecordBatch], column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that one slice holds about ``most_bytes`` of a text column, one row at least."""
    import pyarrow.compute as pc

    for batch in batches:
        lengths = pc.binary_length(batch.column(column)).to_pylist()
        start = size = 0
        for i, n in enumerate(lengths):
            size += n or 0
            if size >= most_bytes:
                yield batch.slice(start, i + 1 - start)
                start, size = i + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not use."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name += "_"
    return name
