"""Run history, alerts, volume drift, health classification and lineage -- all as
DataFrame operations over the run-record table (one row per run, stage metrics in a
map, alerts in an array)."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakehold.functions.dates import ntz_seconds
from lakehold.contracts import (FRESHNESS_MAX_HOURS, QUALITY_ALERT_PASS_RATE,
                                QUALITY_GATE_MIN_PASS_RATE, VOLUME_DRIFT_TOLERANCE)

SUCCESS = "success"
BLOCKED = "blocked_quality_gate"
FAILED = "failed"

STAGE = T.StructType([
    T.StructField("rows_in", T.LongType()), T.StructField("rows_out", T.LongType()),
    T.StructField("duration_s", T.DoubleType()), T.StructField("quality_rate", T.DoubleType()),
    T.StructField("quarantined", T.LongType()), T.StructField("invalid_detected", T.LongType())])
ALERT = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("ts", T.StringType()),
    T.StructField("severity", T.StringType()), T.StructField("message", T.StringType()),
    T.StructField("context", T.MapType(T.StringType(), T.StringType()))])
RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("ts", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("duration_s", T.DoubleType()),
    T.StructField("config", T.MapType(T.StringType(), T.StringType())),
    T.StructField("stages", T.MapType(T.StringType(), STAGE)),
    T.StructField("alerts", T.ArrayType(ALERT))])
LINEAGE_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("target", T.StringType()),
    T.StructField("process", T.StringType()), T.StructField("rows", T.LongType()),
    T.StructField("ts", T.StringType()), T.StructField("run_id", T.StringType()),
    T.StructField("seq", T.LongType())])

SEVERITY = {"ok": 0, "alert": 1, "critical": 2}


def run_history(runs: DataFrame, stage: str = "silver") -> DataFrame:
    """Flat view: run_id, ts, status, duration_s, quality_rate and quarantined of ``stage``,
    number of alerts."""
    st = F.col("stages")[stage]
    return runs.select("run_id", "ts", "status", "duration_s",
                       st["rows_in"].alias("rows_in"),
                       st["quality_rate"].alias("quality_rate"),
                       st["quarantined"].alias("quarantined"),
                       F.size(F.coalesce(F.col("alerts"), F.array())).cast("long").alias("n_alerts"))


def alert_history(runs: DataFrame) -> DataFrame:
    """All alerts of all runs, one row each."""
    return (runs.select(F.explode("alerts").alias("a"))
            .select("a.run_id", "a.ts", "a.severity", "a.message"))


def last_runs(runs: DataFrame, n: int) -> DataFrame:
    """The ``n`` most recent runs (top-k, no global sort of the history)."""
    return runs.orderBy(F.desc("ts"), F.desc("run_id")).limit(n)


def _source():
    """What a run covers: the replayed dataset, or null for runs over all datasets."""
    return F.col("config")["source"]


def volume_drift(runs: DataFrame, stages: tuple = ("ingest_batch", "ingest_stream", "silver"),
                 tolerance: float = VOLUME_DRIFT_TOLERANCE) -> DataFrame:
    """Each run's ``rows_out`` of every stage against the last earlier *successful* run's:
    drift = |now - prev| / prev, warn when drift > tolerance; no previous value or 0 -> no check.

    The window runs over one source's history of one stage: one row per run."""
    w = Window.partitionBy("source", "stage").orderBy("ts", "run_id").rowsBetween(Window.unboundedPreceding, -1)
    per_stage = [F.struct(F.lit(s).alias("stage"), F.col("stages")[s]["rows_out"].alias("rows")) for s in stages]
    base = runs.select("run_id", "ts", "status", _source().alias("source"), F.explode(F.array(*per_stage)).alias("s")).select(
        "run_id", "ts", "status", "source", "s.stage", "s.rows").where("rows is not null")
    prev = F.last(F.when(F.col("status") == SUCCESS, F.col("rows")), ignorenulls=True).over(w)
    base = base.withColumn("prev_rows", prev)
    drift = F.when(F.col("prev_rows").isNull() | (F.col("prev_rows") == 0), F.lit(None).cast("double")) \
        .otherwise(F.abs(F.col("rows") - F.col("prev_rows")) / F.col("prev_rows"))
    return base.select("run_id", "ts", "status", "stage", "rows", "prev_rows", drift.alias("drift"),
                       F.coalesce(drift > F.lit(tolerance), F.lit(False)).alias("warn"))


def _status_rank(c):
    return F.when(c == "critical", 2).when(c == "alert", 1).otherwise(0)


def run_health(runs: DataFrame, gold_ok: bool | None = None, missing_tables: dict[str, list] | None = None,
               as_of_ts: str | None = None, gate: float = QUALITY_GATE_MIN_PASS_RATE,
               alert_rate: float = QUALITY_ALERT_PASS_RATE,
               max_age_hours: float = FRESHNESS_MAX_HOURS, stage: str = "silver") -> DataFrame:
    """Health items per run, as seen when the run is checked:
    last status (critical unless success), freshness (age at ``as_of_ts`` -- or at the next
    run's start -- above ``max_age_hours`` -> alert), quality (rate < gate -> critical,
    < alert_rate -> alert), Gold reachable, and each layer's tables present (``missing_tables``:
    layer -> tables that are not) when given; overall is the worst item."""
    ts = F.col("ts").try_cast("timestamp_ntz")
    nxt = F.lead(ts).over(Window.partitionBy(_source()).orderBy("ts", "run_id"))
    check_at = F.lit(as_of_ts).try_cast("timestamp_ntz") if as_of_ts else F.coalesce(nxt, ts)
    age_h = (ntz_seconds(check_at) - ntz_seconds(ts)) / 3600.0
    rate = F.col("stages")[stage]["quality_rate"]
    status_item = F.when(F.col("status") == SUCCESS, "ok").otherwise("critical")
    fresh_item = F.when(age_h > max_age_hours, "alert").otherwise("ok")
    quality_item = (F.when(rate.isNull(), "ok").when(rate < gate, "critical")
                    .when(rate < alert_rate, "alert").otherwise("ok"))
    items = [status_item.alias("last_run"), fresh_item.alias("freshness"),
             quality_item.alias("quality")]
    if gold_ok is not None:
        items.append(F.lit("ok" if gold_ok else "critical").alias("gold"))
    for layer, missing in (missing_tables or {}).items():
        items.append(F.lit("alert" if missing else "ok").alias(layer))
    out = runs.select("run_id", "ts", "status", age_h.alias("age_hours"),
                      rate.alias("quality_rate"), *items)
    names = [i for i in ("last_run", "freshness", "quality", "gold", *(missing_tables or {})) if i in out.columns]
    worst = F.greatest(*[_status_rank(F.col(n)) for n in names])
    overall = F.when(worst == 2, "critical").when(worst == 1, "alert").otherwise("ok")
    return out.withColumn("overall", overall)


def lineage_latest(edges: DataFrame) -> DataFrame:
    """Latest edge per (source, target); ties by write sequence. Partitioned by the pair,
    so each group is the edge history of one pair."""
    w = Window.partitionBy("source", "target").orderBy(F.desc("ts"), F.desc("run_id"), F.desc("seq"))
    return (edges.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
            .select("source", "target", "process", "rows", "ts", "run_id"))
