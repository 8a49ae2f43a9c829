"""Table profiles, schema drift and the catalogue summary.

The profile of a table has rows, null share and exact distinct non-null values per column. Each
column is a plan of its own: a narrow scan of that column and a count per value -- partially
aggregated per task, so a hot value costs one row per task -- all of them one union. Columns known
to be unique skip the shuffle. ``exact=False`` swaps in HyperLogLog, in one pass over all columns.

``profile_state`` is the mergeable form: per run and column the rows, the values and an HLL sketch of the
values. States of several runs add up to the profile of all their rows (``merge_states``), so a new run
reads its own rows only. Rows and null shares are exact; distinct values are estimates whose relative
standard error is about 1.04 / sqrt(2 ** LG_K), 0.8 %.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakehold.contracts import CONTRACTS, Contract
from lakehold.operators.quality import round_half_up

LG_K = 14  # registers of a sketch, as a power of two: at most 16 KB a column and run
STATE_SCHEMA = "run_id string, layer string, dataset string, column string, rows long, filled long, sketch binary"
PROFILE_SCHEMA = "layer string, dataset string, column string, rows long, null_pct double, n_distinct long"

# bookkeeping columns (arrival position, provenance) are not profiled
INTERNAL = ("_ordinal", "_file", "_block", "_arrival_run", "_drain", "_origin_run", "_origin_drain", "_origin_ordinal", "_modified", "run_id")


def _value(df: DataFrame, name: str):
    """A column as profiled: NaN counts as missing, nested values compare as JSON."""
    c, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(c), c)
    return F.to_json(c) if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)) else c


def profile(df: DataFrame, layer: str, dataset: str, exact: bool = True,
            known_unique: tuple = (), only: Callable[[str], DataFrame] | None = None) -> DataFrame:
    """Profile rows of ``df``, one per column, also of an empty table. ``known_unique`` names columns
    whose non-null values are distinct by construction (a Silver key that passed ``unique``).
    ``only(column)`` gives the same rows with that column alone, where that is cheaper than ``df``."""
    cols = [c for c in df.columns if c not in INTERNAL]
    wide_aggs = [F.count(F.lit(1)).alias("rows")]
    wide = [c for c in cols if not exact or c in known_unique]
    for i, c in enumerate(wide):
        v = _value(df, c)
        wide_aggs += [F.count(v).alias(f"n{i}"), (F.count(v) if c in known_unique else F.approx_count_distinct(v)).alias(f"d{i}")]
    parts = []
    if wide:
        rows = [F.struct(F.lit(c).alias("column"), F.col("rows"), F.col(f"n{i}").alias("filled"), F.col(f"d{i}").alias("n_distinct"))
                for i, c in enumerate(wide)]
        parts.append(df.agg(*wide_aggs).select(F.explode(F.array(*rows)).alias("p")).select("p.*"))
    for c in cols:
        if c not in wide:
            rows_of = only(c) if only else df
            counts = rows_of.groupBy(_value(rows_of, c).alias("v")).agg(F.count(F.lit(1)).alias("cnt"))
            parts.append(counts.agg(
                F.coalesce(F.sum("cnt"), F.lit(0)).alias("rows"),
                F.coalesce(F.sum(F.when(F.col("v").isNotNull(), F.col("cnt"))), F.lit(0)).alias("filled"),
                F.count("v").alias("n_distinct")).select(F.lit(c).alias("column"), "*"))
    long = parts[0]
    for part in parts[1:]:
        long = long.unionByName(part)
    null_pct = F.when(F.col("rows") == 0, F.lit(0.0)).otherwise((F.col("rows") - F.col("filled")) / F.col("rows"))
    return long.select(F.lit(layer).alias("layer"), F.lit(dataset).alias("dataset"), "column",
                       F.col("rows").cast("long").alias("rows"),
                       round_half_up(null_pct, 4).alias("null_pct"),
                       F.col("n_distinct").cast("long").alias("n_distinct"))


def _sketched(df: DataFrame, name: str) -> Column:
    """A column's values as sketches take them: whole numbers as long, all else as text that is never
    empty (sketches pass over empty values) and does not depend on the session's time zone."""
    v, kind = _value(df, name), df.schema[name].dataType
    if isinstance(kind, T.IntegralType):
        return v.cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(v)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        v = v + F.lit(0.0)  # one zero
    return F.concat(F.lit("="), F.hex(v) if isinstance(kind, T.BinaryType) else v.cast("string"))


def profile_state(df: DataFrame, layer: str, dataset: str, run: Column) -> DataFrame:
    """Mergeable profile of every run in ``df`` (see STATE_SCHEMA), in one pass: per run a row for each column,
    and one without a column that counts the run's rows. A table without rows has no state."""
    cols = [c for c in df.columns if c not in INTERNAL]
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(cols):
        aggs += [F.count(_value(df, c)).alias(f"n{i}"), F.hll_sketch_agg(_sketched(df, c), LG_K).alias(f"s{i}")]
    each = [F.struct(F.lit(None).cast("string").alias("column"), F.col("rows").alias("filled"), F.lit(None).cast("binary").alias("sketch"))]
    each += [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("filled"), F.col(f"s{i}").alias("sketch")) for i, c in enumerate(cols)]
    return df.groupBy(run.cast("string").alias("run_id")).agg(*aggs).select(
        "run_id", F.lit(layer).alias("layer"), F.lit(dataset).alias("dataset"), "rows", F.explode(F.array(*each)).alias("p")).select(
        "run_id", "layer", "dataset", "p.column", "rows", "p.filled", "p.sketch")


def merge_states(states: DataFrame) -> DataFrame:
    """The profile (see PROFILE_SCHEMA) of all rows behind ``states``. A column that some runs lack is null in their rows."""
    merged = states.groupBy("layer", "dataset", "column").agg(
        F.sum("rows").alias("rows"), F.sum("filled").alias("filled"), F.hll_union_agg("sketch").alias("sketch"))
    table = Window.partitionBy("layer", "dataset")  # a row per column
    total = F.max(F.when(F.col("column").isNull(), F.col("rows"))).over(table)
    return merged.withColumn("rows", total).where("column is not null").select(
        "layer", "dataset", "column", "rows",
        round_half_up((F.col("rows") - F.col("filled")) / F.col("rows"), 4).alias("null_pct"),
        F.hll_sketch_estimate("sketch").alias("n_distinct"))


def drift_items(tables: dict[str, DataFrame], contracts: dict[str, Contract] | None = None) -> list[tuple[str, str, str]]:
    """Contract columns absent from the table (``missing``) and table columns absent from
    the contract (``unexpected``); control columns (``_``) ignored. Read from schemas only."""
    contracts = contracts or CONTRACTS
    rows = []
    for ds, df in tables.items():
        expected = set(contracts[ds].column_names)
        present = {c for c in df.columns if not c.startswith("_") and c != "run_id"}
        rows += [(ds, "missing", c) for c in sorted(expected - present)]
        rows += [(ds, "unexpected", c) for c in sorted(present - expected)]
    return rows


def schema_drift(tables: dict[str, DataFrame], contracts: dict[str, Contract] | None = None) -> DataFrame | None:
    """dataset, kind, column and the rows concerned: those without a missing column's value, those
    with a value in an unexpected one. None where there is no drift."""
    out = None
    for ds, df in tables.items():
        items = [(kind, c) for d, kind, c in drift_items({ds: df}, contracts)]
        if not items:
            continue
        aggs = [(F.count(F.lit(1)) if kind == "missing" else F.count(F.col(f"`{c}`"))).alias(f"n{i}") for i, (kind, c) in enumerate(items)]
        rows = [F.struct(F.lit(ds).alias("dataset"), F.lit(kind).alias("kind"), F.lit(c).alias("column"), F.col(f"n{i}").alias("n_rows"))
                for i, (kind, c) in enumerate(items)]
        part = df.agg(*aggs).select(F.explode(F.array(*rows)).alias("d")).select("d.*")
        out = part if out is None else out.unionByName(part)
    return out


META = ("domain", "owner", "origin", "format", "frequency")


def catalog_summary(tables: dict[str, DataFrame], contracts: dict[str, Contract] | None = None) -> DataFrame:
    """Per dataset: governance facts of its contract, the columns of its table (from the schema) and
    its rows (one count). A dataset without a table has neither."""
    contracts = contracts or CONTRACTS
    spark = next(iter(tables.values())).sparkSession
    out = None
    for name, c in contracts.items():
        facts = [F.lit(name).alias("dataset"), *[F.lit(c.about.get(k, "")).alias(k) for k in META]]
        df = tables.get(name)
        rows = (df.agg(F.count(F.lit(1)).alias("n_rows")) if df is not None
                else spark.range(1).select(F.lit(0).cast("long").alias("n_rows")))
        part = rows.select(*facts, F.lit(len(df.columns) if df is not None else 0).cast("long").alias("n_columns"), "n_rows")
        out = part if out is None else out.unionByName(part)
    return out


def catalog_columns(spark: SparkSession, contracts: dict[str, Contract] | None = None,
                    dataset: str | None = None) -> DataFrame:
    """Column dictionary from the contracts: dataset, column, type, personal data flag and the
    dataset's governance facts; optionally only one dataset."""
    contracts = contracts or CONTRACTS
    facts = (*META, "latency")
    rows = [(c.name, col, t, col in c.pii, *[c.about.get(k, "") for k in facts])
            for c in contracts.values() for col, t in c.columns]
    df = spark.createDataFrame(rows, "dataset string, column string, type string, pii boolean, "
                               + ", ".join(f"{k} string" for k in facts))
    return df.where(F.col("dataset") == dataset) if dataset else df
