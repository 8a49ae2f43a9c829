"""Run history derived from the given tables: each month of a dated dataset is replayed as
one incremental batch run (rows that arrived that month). Quality per run comes from the
same contract flags, so the history -- and the monitoring operators over it (run history,
alerts, volume drift, health, lineage) -- is computed by Spark from the data and grows
with it. Rows without a parsable date form one ``undated`` run; none is dropped.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakehold.contracts import ALL_DATASETS, BATCH_DATASETS, QUALITY_GATE_MIN_PASS_RATE
from lakehold.functions.dates import lenient_timestamp, month_text
from lakehold.operators import monitor as M
from lakehold.operators import quality as Q
from lakehold.plans.derived import Chain
from lakehold.sources.scratch import materialise
from lakehold.sources.testdata import CONTRACTS, LATE

# dataset -> date column that assigns a row to a monthly run; books have none: one undated run
REPLAY_DATE = {"readers": "signup_date", "loans": "loan_date", "ratings": "rating_date", "access_events": "event_ts"}


def monthly_counts(ch: Chain, dataset: str) -> DataFrame:
    """Per monthly run: rows and invalid rows. One aggregation over the flagged table; or, where columns come
    from a growing join, one over all rows without it and one over the valid rows."""
    c = CONTRACTS[dataset]
    col = REPLAY_DATE.get(dataset)

    def monthly(df: DataFrame, n: Column, bad: Column) -> DataFrame:
        ts = lenient_timestamp(df, col, c.date_formats.get(col)) if col else F.lit(None).cast("timestamp_ntz")
        month = F.coalesce(month_text(ts), F.lit("undated"))
        run_ts = F.coalesce(F.concat(F.add_months(F.trunc(ts, "month"), 1).cast("string"), F.lit("T00:00:00")),
                            F.lit("9999-12-31T00:00:00"))
        return df.groupBy(month.alias("month"), run_ts.alias("ts")).agg(n.alias("n"), bad.alias("n_bad"))

    if dataset not in LATE:
        return monthly(ch.flagged(dataset).df, F.count(F.lit(1)), F.count_if(F.size(F.col(Q.FAILED)) > 0))
    # a row per month, written: all rows are counted apart from the flags
    total = materialise(monthly(ch.weighted(dataset, {col}), F.sum("_times"), F.sum("_times")), "months")
    parts = total.unionByName(monthly(ch.valid(dataset), F.lit(0).cast("long"), -F.count(F.lit(1))))
    return parts.groupBy("month", "ts").agg(F.sum("n").alias("n"), F.sum("n_bad").alias("n_bad"))


def replay_runs(ch: Chain, datasets=ALL_DATASETS, gate: float = QUALITY_GATE_MIN_PASS_RATE) -> DataFrame:
    """Run records (``monitor.RUN_SCHEMA`` shape) for the monthly replay of every dataset."""
    ch.pass_all(datasets)
    out = None
    for dataset in datasets:
        part = _replay_dataset(ch, dataset, gate)
        out = part if out is None else out.unionByName(part)
    return out


def _replay_dataset(ch: Chain, dataset: str, gate: float) -> DataFrame:
    m = monthly_counts(ch, dataset)
    rate = (F.col("n") - F.col("n_bad")) / F.col("n")
    rate4 = Q.round_half_up(rate, 4)
    stage = lambda rows_out, q, qbad, inv: F.struct(
        F.col("n").cast("long").alias("rows_in"), rows_out.cast("long").alias("rows_out"),
        F.lit(None).cast("double").alias("duration_s"), q.alias("quality_rate"),
        qbad.cast("long").alias("quarantined"), inv.cast("long").alias("invalid_detected"))
    ingest = "ingest_batch" if dataset in BATCH_DATASETS else "ingest_stream"
    stages = F.create_map(
        F.lit(ingest), stage(F.col("n"), F.lit(None).cast("double"), F.lit(0), F.col("n_bad")),
        F.lit("silver"), stage(F.col("n") - F.col("n_bad"), rate4, F.col("n_bad"), F.col("n_bad")))
    ok = rate >= F.lit(gate)
    run_id = F.concat(F.lit(f"{dataset}-"), F.col("month"))
    gate_alert = F.struct(run_id.alias("run_id"), F.col("ts"), F.lit("CRITICAL").alias("severity"),
                          F.concat(F.lit("pass rate "), F.format_string("%.4f", rate4), F.lit(f" is below the gate of {gate}")).alias("message"),
                          F.create_map(F.lit("dataset"), F.lit(dataset)).alias("context"))
    none = F.array().cast("array<struct<run_id:string,ts:string,severity:string,message:string,context:map<string,string>>>")
    return m.select(run_id.alias("run_id"), "ts",
                    F.when(ok, F.lit(M.SUCCESS)).otherwise(F.lit(M.BLOCKED)).alias("status"),
                    F.lit(None).cast("double").alias("duration_s"),
                    F.create_map(F.lit("source"), F.lit(dataset)).alias("config"),
                    stages.alias("stages"), F.when(ok, none).otherwise(F.array(gate_alert)).alias("alerts"))


def replay_lineage(ch: Chain, datasets=ALL_DATASETS) -> DataFrame:
    """Lineage edges of every monthly run: raw -> bronze (rows) and bronze -> silver (valid)."""
    ch.pass_all(datasets)
    out = None
    for ds in datasets:
        m = monthly_counts(ch, ds)
        run_id = F.concat(F.lit(f"{ds}-"), F.col("month"))
        ingest = "ingest_batch" if ds in BATCH_DATASETS else "event_consumer"
        edge = lambda source, target, process, rows, seq: F.struct(
            F.lit(f"{source}/{ds}").alias("source"), F.lit(f"{target}/{ds}").alias("target"), F.lit(process).alias("process"),
            rows.cast("long").alias("rows"), F.lit(seq).cast("long").alias("seq"))
        # both edges of a run come from one row, so the flags are evaluated once
        edges = F.array(edge("raw", "bronze", ingest, F.col("n"), 0), edge("bronze", "silver", "silver", F.col("n") - F.col("n_bad"), 1))
        part = m.select("ts", run_id.alias("run_id"), F.explode(edges).alias("e")).select(
            "e.source", "e.target", "e.process", "e.rows", "ts", "run_id", "e.seq")
        out = part if out is None else out.unionByName(part)
    return out
