"""Silver shaping of valid rows: drop control columns, keep-first dedup, date
normalisation, personal-data policy. One narrow projection; dedup only adds a join when
the contract does not already guarantee a unique, non-null key."""
from __future__ import annotations

from pyspark.sql import DataFrame

from lakehold.contracts import Contract
from lakehold.functions.dates import lenient_timestamp
from lakehold.functions.privacy import apply_pii
from lakehold.operators.keys import dedup_keep_first


def drop_control(df: DataFrame) -> DataFrame:
    """Drop every column whose name starts with ``_``."""
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def normalise_dates(df: DataFrame, c: Contract) -> DataFrame:
    """Declared date columns become TIMESTAMP_NTZ in place; unparsable -> null, row kept."""
    cols = {col: lenient_timestamp(df, col, fmt) for col, fmt in c.date_formats.items()
            if col in df.columns}
    return df.withColumns(cols) if cols else df


def to_silver(valid: DataFrame, c: Contract, salt: str | None = None,
              force_dedup: bool = False) -> DataFrame:
    key = c.key
    if key and key in valid.columns and (force_dedup or not c.dedup_is_noop()):
        valid = dedup_keep_first(valid, key, [o for o in c.order_by if o in valid.columns])
    out = drop_control(valid)
    out = normalise_dates(out, c)
    return apply_pii(out, c, salt)
