"""Lenient date handling: unparsable text becomes null, the row is kept."""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# datetime pattern letters -> the exact text shape they accept (fixed-width fields)
_PATTERN_SHAPES = {"yyyy": r"\d{4}", "MM": r"\d{2}", "dd": r"\d{2}", "HH": r"\d{2}",
                   "mm": r"\d{2}", "ss": r"\d{2}"}


def _shape_regex(fmt: str) -> str | None:
    """Regex for a fixed-width pattern such as ``yyyy-MM-dd'T'HH:mm:ss``; None if the
    pattern uses anything else."""
    out, i = "^", 0
    while i < len(fmt):
        if fmt[i] == "'":
            j = fmt.index("'", i + 1)
            out += re.escape(fmt[i + 1:j])
            i = j + 1
            continue
        for tok, rx in _PATTERN_SHAPES.items():
            if fmt.startswith(tok, i):
                out += rx
                i += len(tok)
                break
        else:
            if fmt[i].isalpha():
                return None
            out += re.escape(fmt[i])
            i += 1
    return out + "$"


def lenient_timestamp(df: DataFrame, column: str, fmt: str | None) -> Column:
    """``column`` as TIMESTAMP_NTZ. Text must have the shape of ``fmt`` (never a bare cast,
    which would accept partial dates such as ``2024``) and a valid calendar value;
    otherwise null. Parsing goes straight to TIMESTAMP_NTZ, so the session time zone
    (and its daylight-saving gaps) plays no part."""
    dtype = df.schema[column].dataType
    c = F.col(column)
    if isinstance(dtype, T.TimestampNTZType):
        return c
    if isinstance(dtype, T.DateType):
        return c.cast("timestamp_ntz")
    if isinstance(dtype, T.TimestampType):
        return c.cast("timestamp_ntz")
    text = c.cast("string")
    shape = _shape_regex(fmt) if fmt else None
    if shape is not None and not any(t in fmt for t in ("HH", "mm", "ss")):
        # a date-only pattern also takes a full ISO date-time (CSV exports write those);
        # partial dates such as 2024 or 2024-01 still do not parse
        shape = shape[:-1] + r"([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?)?$"
    if shape is None:
        if fmt is None:
            return text.try_cast("timestamp_ntz")
        return F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz")
    iso = F.regexp_replace(text, "T", " ")
    return F.when(text.rlike(shape), iso.try_cast("timestamp_ntz"))


def ntz_seconds(c: Column) -> Column:
    """Seconds since 1970-01-01 of a TIMESTAMP_NTZ wall-clock value, without a time zone."""
    return (F.unix_date(F.to_date(c)).cast("long") * 86400 + F.hour(c) * 3600
            + F.minute(c) * 60 + F.second(c))


def month_text(c: Column) -> Column:
    """Year-month label ``yyyy-MM`` of a TIMESTAMP_NTZ; formatting it would go through the session's
    time zone."""
    return F.substring(c.cast("string"), 1, 7)


def as_of_literal(value) -> Column:
    """Reference instant for ``not_future`` as a TIMESTAMP_NTZ literal (fixed for the run,
    so recomputing a lost partition gives the same answer)."""
    if value is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return F.lit(str(value)).cast("timestamp_ntz")
