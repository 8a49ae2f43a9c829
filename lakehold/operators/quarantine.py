"""Quarantine: rows that broke a rule, kept with the rules they broke; listing, pending
batches, and re-checking quarantined rows against the current rules."""
from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehold.contracts import Contract
from lakehold.operators import quality as Q
from lakehold.operators.joins import Marks, join_keyset, key_set
from lakehold.operators.keys import DRAIN, arrival_order, drain_of, order_struct, with_duplicate_flag
from lakehold.operators.silver import drop_control


def quarantine_rows(fl: Q.Flagged, reason: str, run_id: str, at: str) -> DataFrame:
    """Sink shape: the input row (control columns included) + ``_reason``,
    ``_failed_rules`` (array<string>), ``_quarantined_at``, ``run_id``. ``_bronze_run_id``, ``_drain`` (streams)
    and ``_ordinal`` say which row of which Bronze run it was at first."""
    data = [c for c in fl.data_columns() if c not in ("run_id", "_bronze_run_id", "_arrival_run")]
    origin = next((F.col(c) for c in ("_bronze_run_id", "_arrival_run", "run_id") if c in fl.df.columns),
                  F.lit(None).cast("string"))
    return fl.invalid().select(*data, origin.alias("_bronze_run_id"), F.lit(reason).alias("_reason"),
                               F.col(Q.FAILED), F.lit(at).alias("_quarantined_at"),
                               F.lit(run_id).alias("run_id"))


def quarantine_view(fl: Q.Flagged, reason: str) -> DataFrame:
    """Uniform view over all datasets: dataset, row_key, failed_rules (text), reason."""
    key = fl.contract.row_key
    return fl.invalid().select(
        F.lit(fl.contract.name).alias("dataset"), F.col(key).cast("string").alias("row_key"),
        F.array_join(F.col(Q.FAILED), ",").alias("failed_rules"), F.lit(reason).alias("reason"))


def listing(quarantined: DataFrame, dataset: str) -> DataFrame:
    """Per dataset: rows, batches (runs), distinct reasons and failed rules (sorted text).
    ``collect_set`` holds distinct reasons/rule names only, a small bounded set."""
    return quarantined.groupBy(F.lit(dataset).alias("dataset")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("run_id").alias("n_batches"),
        F.array_join(F.array_sort(F.collect_set("_reason")), ",").alias("reasons"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set(Q.FAILED)))), ",")
        .alias("rules"))


def batches(quarantined: DataFrame, dataset: str) -> DataFrame:
    return (quarantined.groupBy(F.lit(dataset).alias("dataset"), "run_id")
            .agg(F.count(F.lit(1)).alias("n_rows")))


def pending(batch_df: DataFrame, ledger: DataFrame) -> DataFrame:
    """Quarantine batches not yet reprocessed (anti-join with the ledger)."""
    return batch_df.join(ledger.select("dataset", "run_id"), ["dataset", "run_id"], "left_anti")


def recheck(quarantined: DataFrame, bronze: DataFrame, c: Contract, refs: dict, as_of,
            only: Callable[[set], DataFrame] | None = None, repeated: tuple[DataFrame, Marks] | None = None) -> Q.Flagged:
    """Re-validate quarantined rows under the current rules. ``only(columns)`` gives the rows of ``bronze``
    with those columns alone, where that is cheaper. ``repeated`` are its ``repeated_keys``, where it is one run
    without micro-batches and they are known: the other keys need not be sought there.

    - Equal data rows, from one run or several, are one candidate, of the latest run that
      quarantined it.
    - ``unique`` is judged within that run's Bronze snapshot: a candidate passes if one of its
      copies is the first row of its key there, so a later duplicate never comes back just because
      its earlier twin is not in quarantine.
    - fk uses the Bronze reference tables.
    """
    data = [x for x in bronze.columns if not x.startswith("_") and x != "run_id"]
    run = F.coalesce(F.col("_bronze_run_id"), F.lit("")) if "_bronze_run_id" in quarantined.columns else F.lit("")
    place = F.col("_ordinal") if "_ordinal" in quarantined.columns else F.lit(None).cast("long")
    copies = quarantined.select(*data, run.alias("_bronze_run_id"), drain_of(quarantined).alias(DRAIN), place.alias("_ordinal"))
    key = c.key
    if key is None:
        sides = [copies.withColumn("_first", F.lit(True))]
    elif repeated is not None:
        dups, marks = repeated
        marked = marks.on(copies, key)
        met = with_duplicate_flag(marked.where("_may").drop("_may"), key, ["_ordinal"], "_later", dups=dups.drop("_slot"))
        sides = [met.withColumn("_first", ~F.col("_later")).drop("_later"), marked.where("not _may").drop("_may").withColumn("_first", F.lit(True))]
    else:
        # the first row per key and run in Bronze, for the candidates' keys only
        asked = key_set(copies.select(F.col(key).alias("_ck")).where("_ck is not null").distinct())
        of_run = F.col("run_id") if "run_id" in bronze.columns else F.lit("")
        order = arrival_order(bronze, c.order_by)
        least = F.min(F.struct(order_struct(order).alias("o"), drain_of(bronze).alias("d")))
        places = only({key, *order, "run_id", DRAIN} & set(bronze.columns)) if only else bronze
        rows = join_keyset(places, asked, lambda b, k: b[key] == k["_ck"], "left_semi")
        firsts = rows.groupBy(F.col(key).alias("_ck"), of_run.alias("_cr")).agg(least.alias("_m")).select(
            "_ck", "_cr", F.struct(F.col("_m.d").alias("d"), F.col("_m.o._ordinal").alias("n")).alias("_cf"))
        copies = copies.join(key_set(firsts), (F.col(key) == F.col("_ck")) & (F.col("_bronze_run_id") == F.col("_cr")), "left")
        sides = [copies.withColumn("_first", F.col(key).isNull() | F.coalesce((F.col("_cf.d") == F.col(DRAIN)) & (F.col("_cf.n") == F.col("_ordinal")), F.lit(False)))]
    latest = F.max(F.struct("_bronze_run_id", "_first", DRAIN, (-F.col("_ordinal")).alias("_back")))
    # equal rows have one key, so they are all on one side of the marks; rows that met their key need no second shuffle
    cand = reduce(DataFrame.unionByName, [side.groupBy(*data).agg(latest.alias("_pick")) for side in sides]).select(
        *data, F.nullif(F.col("_pick._bronze_run_id"), F.lit("")).alias("_bronze_run_id"),
        F.col(f"_pick.{DRAIN}").alias(DRAIN), (-F.col("_pick._back")).alias("_ordinal"), F.col("_pick._first").alias("_first"))
    # candidates hold the values of the quarantined rows: their orphans are sought there, without making candidates again
    fl = Q.flag(cand, c, refs, as_of, {r.kind for r in c.rules} - {"unique"}, only=lambda columns: quarantined.select(*columns))
    df = fl.df
    for i, r in enumerate(c.rules):
        if r.kind == "unique":
            df = df.withColumn(fl.flag_cols[i], ~F.col("_first"))
    return fl.on(df.withColumn(Q.FAILED, Q.failed_array(df, fl.flag_cols, fl.rules)).drop("_first"))


def merge_into_bronze(bronze: DataFrame, returned: DataFrame, key: str | None = None, repeated: Marks | None = None) -> DataFrame:
    """Bronze rows (control columns dropped) plus returned rows, whole-row distinct.

    ``repeated`` marks the values of ``key`` that several rows of ``bronze`` have. Where they are known, a row whose
    key is neither one of them nor null nor returned has no equal, and is not moved to meet one. ``bronze`` and
    ``returned`` are read twice then and should be written tables."""
    rows, back = drop_control(bronze.drop("run_id")), drop_control(returned)
    if key is None or repeated is None:
        return rows.unionByName(back).distinct()
    marked = Marks.over(back.where(F.col(key).isNotNull()), key).on(repeated.on(rows, key, "_several"), key, "_back")
    alone = ~F.col("_several") & ~F.col("_back") & F.col(key).isNotNull()
    met = drop_control(marked.where(~alone)).unionByName(back).distinct()
    return met.unionByName(drop_control(marked.where(alone)))
