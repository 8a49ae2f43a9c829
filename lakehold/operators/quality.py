"""Contract validation: per-row rule flags, rule and dataset reports, quality gate.

Every rule looks at the whole input, not at rows left by earlier rules. A row is
invalid when any rule flags it; valid + invalid is a partition of the input.
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakehold.contracts import CORRUPT_RULE, MISSING_COLUMN_DETAIL, QUALITY_GATE_MIN_PASS_RATE, Contract, Rule
from lakehold.functions.rules import KEYED, STATELESS, as_of_for
from lakehold.operators.joins import key_set
from lakehold.operators.keys import arrival_order, duplicate_keys, first_rows, orphan_keys, repeated_keys, with_duplicate_flag, with_fk_flag, with_position, with_slot

FAILED = "_failed_rules"


@dataclass
class Flagged:
    """Input rows plus one boolean column per rule and ``_failed_rules`` (array<string>)."""
    df: DataFrame
    contract: Contract
    rules: tuple
    flag_cols: list
    missing: frozenset   # indexes of rules whose column is absent
    repeated: dict = field(default_factory=dict)   # of a stored table: column -> its repeated keys and marks over them

    def valid(self) -> DataFrame:
        return self.df.where(F.size(F.col(FAILED)) == 0)

    def invalid(self) -> DataFrame:
        return self.df.where(F.size(F.col(FAILED)) > 0)

    def data_columns(self) -> list[str]:
        return [c for c in self.df.columns if c not in self.flag_cols and c != FAILED]

    def public_columns(self) -> list[str]:
        """Data columns without the control columns."""
        return [c for c in self.data_columns() if not c.startswith("_")]

    def on(self, df: DataFrame) -> Flagged:
        """The same flags over another copy of the rows."""
        return Flagged(df, self.contract, self.rules, self.flag_cols, self.missing, self.repeated)


def failed_array(df: DataFrame, flag_cols: list, rules: tuple):
    names = [F.when(F.col(n), F.lit(r.name)) for n, r in zip(flag_cols, rules)]
    if "_corrupt_record" in df.columns:
        names.append(F.when(F.col("_corrupt_record").isNotNull(), F.lit(CORRUPT_RULE)))
    return F.filter(F.array(*names), lambda x: x.isNotNull())


def flag(df: DataFrame, c: Contract, refs: dict | None = None, as_of=None, kinds: set | None = None,
         only: Callable[[set], DataFrame] | None = None, which: Callable[[Rule], bool] | None = None,
         stored: bool = False) -> Flagged:
    """Evaluate the rules of ``c`` on ``df``. ``refs`` maps dataset -> DataFrame for fk rules;
    ``as_of`` is the instant for ``not_future`` (one value or dataset -> value). ``kinds`` limits the
    work to rules of these kinds, ``which`` to those it holds for; the others count as passed. ``only(columns)`` gives the same rows, at the
    same places, with those columns alone, where that is cheaper than ``df``; key sets are made from it. ``stored`` says that
    these come from a written table, cheap to read again: rows whose key surely comes once then move nowhere to learn it.

    Key sets are only built for the keyed rules asked for; without any, the flags are one projection
    of the scan."""
    from lakehold.plans.parallel import run_all

    refs = refs or {}
    as_of = as_of_for(as_of, c.name)
    flag_cols = [f"_rule_{i}" for i in range(len(c.rules))]
    missing = frozenset(i for i, r in enumerate(c.rules) if r.column not in df.columns)
    asked = [i for i, r in enumerate(c.rules) if (kinds is None or r.kind in kinds) and (which is None or which(r))]
    df = with_position(df) if any(c.rules[i].kind == "unique" for i in asked) else df
    order = arrival_order(df, c.order_by)
    narrow = lambda columns: with_position(only(columns)) if only else df

    sets = {}
    for i in asked:
        r = c.rules[i]
        if i in missing:
            continue
        if r.kind == "unique" and stored:
            sets[i] = lambda r=r: repeated_keys(narrow, r.column, order)
        elif r.kind == "unique":
            sets[i] = lambda r=r: key_set(with_slot(duplicate_keys(narrow({r.column, *order}), r.column, order)))
        elif r.kind == "fk" and (ref := refs.get(r.param[0])) is not None and r.param[1] in ref.columns:
            sets[i] = lambda r=r, ref=ref: key_set(with_slot(orphan_keys(narrow({r.column}), r.column, ref, r.param[1])))
    sets = dict(zip(sets, run_all(list(sets.values()))))   # independent of each other

    stateless = {}
    for i, r in enumerate(c.rules):
        name = flag_cols[i]
        if i not in asked:
            stateless[name] = F.lit(False)
        elif i in missing:
            stateless[name] = F.lit(True)
        elif r.kind not in KEYED:
            stateless[name] = F.coalesce(STATELESS[r.kind](df, c, r, as_of), F.lit(False))
    # before the joins with key sets: where these shuffle, a flag moves in place of the columns it was made of
    out = df.withColumns(stateless) if stateless else df
    for i, r in enumerate(c.rules):
        if i in asked and i not in missing and r.kind == "unique":
            dups, marks = sets[i] if stored else (sets[i], None)
            out = with_duplicate_flag(out, r.column, order, flag_cols[i], dups=dups, marks=marks)
        elif i in asked and i not in missing and r.kind == "fk":
            out = with_fk_flag(out, r.column, sets.get(i), flag_cols[i], (c.row_key, "_ordinal"))
    repeated = {c.rules[i].column: sets[i] for i in sets if stored and c.rules[i].kind == "unique"}
    return Flagged(out.withColumn(FAILED, failed_array(out, flag_cols, c.rules)), c, c.rules, flag_cols, missing, repeated)


def valid_rows(df: DataFrame, c: Contract, refs: dict, as_of, only: Callable[[set], DataFrame], later: Callable[[DataFrame], DataFrame],
               late: set) -> DataFrame:
    """``flag(...).valid()`` where no row has to be told why it fails, and some columns come from a join that
    grows with the data. ``df`` lacks the columns ``late``, which ``later`` adds to its rows (and drops its link).

    Every rule still looks at the whole input. A row is moved once to meet its key, and only the first of a key,
    if it breaks no other rule, goes on into the join."""
    key = c.key
    if key is None or key in late or late & set(c.order_by):
        raise ValueError(f"{c.name}: rows of a key are ordered by columns that come later")
    early = flag(df, c, refs, as_of, only=only, which=lambda r: r.kind != "unique" and r.column not in late)
    rows = early.df.select(*df.columns, (F.size(F.col(FAILED)) == 0).alias("_passes"))
    firsts = first_rows(rows, key, arrival_order(df, c.order_by)).where("_passes").drop("_passes")
    whole = flag(later(firsts), c, refs, as_of, only=only, which=lambda r: r.column in late)
    return whole.valid().select(*whole.data_columns())


def _rule_detail(fl: Flagged, i: int, r: Rule) -> str:
    return MISSING_COLUMN_DETAIL if i in fl.missing else r.detail


def summary_counts(fl: Flagged) -> DataFrame:
    """One pass over the flagged rows: total, invalid rows, failures per rule."""
    aggs = [F.count(F.lit(1)).alias("n"),
            F.count_if(F.size(F.col(FAILED)) > 0).alias("n_invalid")]
    aggs += [F.count_if(F.col(n)).alias(n) for n in fl.flag_cols]
    return fl.df.agg(*aggs)


def rule_report(fl: Flagged, counts: DataFrame | None = None) -> DataFrame:
    """One row per rule: dataset, rule, column, passed, failed, detail. A rule on a missing
    column reports 0 passed and every row failed."""
    counts = counts if counts is not None else summary_counts(fl)
    rows = []
    for i, r in enumerate(fl.rules):
        failed = F.col("n") if i in fl.missing else F.col(fl.flag_cols[i])
        rows.append(F.struct(F.lit(i).alias("rule_index"), F.lit(r.kind).alias("rule"),
                             F.lit(r.column).alias("column"),
                             (F.col("n") - failed).cast("long").alias("passed"),
                             failed.cast("long").alias("failed"),
                             F.lit(_rule_detail(fl, i, r)).alias("detail")))
    return (counts.select(F.explode(F.array(*rows)).alias("r"))
            .select(F.lit(fl.contract.name).alias("dataset"), "r.*"))


def dataset_report(fl: Flagged, counts: DataFrame | None = None) -> DataFrame:
    """dataset, total_rows, invalid_rows, pass_rate (1.0 when empty), pass_rate_4dp, passed."""
    counts = counts if counts is not None else summary_counts(fl)
    all_pass = F.lit(True)
    for i, n in enumerate(fl.flag_cols):
        failed = F.col("n") if i in fl.missing else F.col(n)
        all_pass = all_pass & (failed == 0)
    return report_of(fl.contract.name, counts, all_pass)


def report_of(dataset: str, counts: DataFrame, all_pass: Column) -> DataFrame:
    """``dataset_report`` from rows (n) and invalid rows (n_invalid)."""
    rate = F.when(F.col("n") == 0, F.lit(1.0)).otherwise(
        (F.col("n") - F.col("n_invalid")).cast("double") / F.col("n"))
    return counts.select(
        F.lit(dataset).alias("dataset"),
        F.col("n").cast("long").alias("total_rows"),
        F.col("n_invalid").cast("long").alias("invalid_rows"),
        rate.alias("pass_rate"),
        round_half_up(rate, 4).alias("pass_rate_4dp"),
        all_pass.alias("passed"))


def round_half_up(c, digits: int):
    """floor(x * 10^d + 0.5) / 10^d: the same double in Spark and in the SQL oracle."""
    scale = float(10 ** digits)
    return F.floor(c * scale + F.lit(0.5)) / F.lit(scale)


def quality_gate(dataset_reports: DataFrame, threshold: float = QUALITY_GATE_MIN_PASS_RATE) -> DataFrame:
    """worst_rate (1.0 without datasets), threshold, gate_ok (strict ``<`` blocks), n_datasets."""
    worst = F.coalesce(F.min("pass_rate"), F.lit(1.0))
    return dataset_reports.agg(
        worst.alias("worst_rate"),
        F.lit(float(threshold)).alias("threshold"),
        (worst >= F.lit(float(threshold))).alias("gate_ok"),
        F.count(F.lit(1)).alias("n_datasets"))
