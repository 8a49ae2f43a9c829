"""Row-level quality rules as Column expressions. ``True`` means the row breaks the rule.

Stateless rules are plain expressions fused into one projection (one codegen pass).
``unique`` and ``fk`` need other rows and are built in ``lakehold.operators.keys``.
New kinds register here by name.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakehold.contracts import Contract, Rule
from lakehold.functions.dates import as_of_literal, lenient_timestamp

_FLOAT_TYPES = (T.FloatType, T.DoubleType)


def _is_float(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, _FLOAT_TYPES)


def not_null(df: DataFrame, c: Contract, rule: Rule, as_of) -> Column:
    col = F.col(rule.column)
    flag = col.isNull()
    if _is_float(df, rule.column):
        flag = flag | F.isnan(col)
    return flag


def in_set(df: DataFrame, c: Contract, rule: Rule, as_of) -> Column:
    col = F.col(rule.column)
    return col.isNotNull() & ~col.isin(list(rule.param))


def in_range(df: DataFrame, c: Contract, rule: Rule, as_of) -> Column:
    lo, hi = rule.param
    # non-numeric text and NaN pass; bounds inclusive
    v = F.col(rule.column).try_cast("double")
    return v.isNotNull() & ~F.isnan(v) & ((v < F.lit(float(lo))) | (v > F.lit(float(hi))))


def regex(df: DataFrame, c: Contract, rule: Rule, as_of) -> Column:
    col = F.col(rule.column)
    # match anchored at the start only; Unicode classes and \n-only line ends, as in Python
    pattern = "(?Ud)^(?:" + str(rule.param) + ")"
    return col.isNotNull() & ~col.cast("string").rlike(pattern)


def not_future(df: DataFrame, c: Contract, rule: Rule, as_of) -> Column:
    ts = lenient_timestamp(df, rule.column, c.date_formats.get(rule.column))
    return ts.isNotNull() & (ts > as_of_literal(as_of))


STATELESS: dict[str, Callable[..., Column]] = {
    "not_null": not_null,
    "in_set": in_set,
    "in_range": in_range,
    "regex": regex,
    "not_future": not_future,
}

KEYED = ("unique", "fk")


def register_rule(kind: str, fn: Callable[..., Column]) -> None:
    """Extension point: add a stateless rule ``fn(df, contract, rule, as_of) -> Column``
    (``True`` = the row breaks the rule). Contracts may then use ``kind``."""
    from lakehold import contracts
    if kind in KEYED:
        raise ValueError(f"{kind!r} is a built-in keyed rule")
    STATELESS[kind] = fn
    if kind not in contracts.RULE_KINDS:
        contracts.RULE_KINDS = contracts.RULE_KINDS + (kind,)


def as_of_for(as_of, dataset: str):
    """``as_of`` may be one instant or a mapping dataset -> instant."""
    if isinstance(as_of, dict):
        return as_of.get(dataset, as_of.get("*"))
    return as_of
