"""Pipeline jobs over a ``Lake``: batch ingest, Silver (validate, quarantine, mask), quality
gate, Gold, governance, run record. Each stage is lazy DataFrame plans ended by writes.

Stage hand-over goes through written tables (Bronze, flagged rows, Silver), so a lost executor only
recomputes a partition of the current stage. Rows are flagged once, into a scratch table of the
shared folder; the report, Silver and quarantine are read from there. A run's partitions are
replaced when the run is repeated.
"""
from __future__ import annotations

import datetime as _dt
import hashlib
import time
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakehold.contracts import (ALL_DATASETS, BATCH_DATASETS, CONTRACTS,
                                QUALITY_GATE_MIN_PASS_RATE, REPROCESS_REASON, REPROCESS_SOURCE,
                                SILVER_REASON, VOLUME_DRIFT_TOLERANCE)
from lakehold.operators import gold as G
from lakehold.operators import monitor as M
from lakehold.operators import profile as P
from lakehold.operators import quality as Q
from lakehold.operators import quarantine as QR
from lakehold.operators.joins import join_keyset, key_set
from lakehold.operators.keys import DRAIN, drain_of
from lakehold.operators.silver import to_silver
from lakehold.plans.parallel import run_all, wrap
from lakehold.session import sized_shuffles
from lakehold.sources.lake import Lake, TableMissing, new_run_id
from lakehold.sources.scratch import materialise

REPROCESS_SUFFIX = "_rp"


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def _iso(t: _dt.datetime) -> str:
    return t.isoformat(timespec="seconds")


@dataclass
class Run:
    """State of one run: identity, parameters and what it recorded."""
    spark: SparkSession
    lake: Lake
    run_id: str = ""
    ts: str = ""
    as_of: object = None                  # instant or dataset -> instant for not_future
    gate_threshold: float = QUALITY_GATE_MIN_PASS_RATE
    salt: str | None = None
    contracts: dict = field(default_factory=lambda: CONTRACTS)
    flagged: dict = field(default_factory=dict)   # dataset -> flagged rows of this run's own Bronze
    stages: dict = field(default_factory=dict)
    alerts: list = field(default_factory=list)
    edges: list = field(default_factory=list)
    started: float = field(default_factory=time.time)

    def __post_init__(self):
        now = _now()
        self.run_id = self.run_id or new_run_id(now)
        self.ts = self.ts or _iso(now)
        if self.as_of is None:
            self.as_of = self.ts.replace("T", " ")   # "now", fixed once for the run

    def stage(self, name, rows_in=0, rows_out=0, duration_s=0.0, quality_rate=None,
              quarantined=0, invalid_detected=None):
        self.stages[name] = {"rows_in": int(rows_in), "rows_out": int(rows_out),
                             "duration_s": round(float(duration_s), 3),
                             "quality_rate": quality_rate, "quarantined": int(quarantined),
                             "invalid_detected": invalid_detected}

    def alert(self, severity: str, message: str, **context):
        """Appended to the alert log at once: a run that dies later has still raised it."""
        raised = {"run_id": self.run_id, "ts": _iso(_now()), "severity": severity, "message": message,
                  "context": {k: str(v) for k, v in context.items()}}
        self.alerts.append(raised)
        self.lake.append_json("logs", "alerts", self.spark.createDataFrame([raised], M.ALERT))

    def edge(self, source: str, target: str, process: str, rows: int):
        self.edges.append((source, target, process, int(rows), _iso(_now()), self.run_id,
                           len(self.edges)))


# ---- ingest ----------------------------------------------------------------------------

def _flag_bronze(run: Run, ds: str, bronze: DataFrame, refs: dict) -> Q.Flagged:
    """Rows of one dataset flagged against its contract, written once."""
    fl = Q.flag(bronze, run.contracts[ds], refs, run.as_of)
    return fl.on(materialise(fl.df, f"flagged-{ds}"))


def _report(fl: Q.Flagged) -> dict:
    """Rows, invalid rows, pass rate (1.0 without rows) and failures per rule of a flagged table."""
    counts = Q.summary_counts(fl).first()
    n, bad = counts["n"], counts["n_invalid"]
    return {"rows_in": n, "quarantined": bad, "pass_rate": 1.0 if n == 0 else (n - bad) / n,
            "rules": [{"rule": r.kind, "column": r.column, "failed": int(n if i in fl.missing else counts[fl.flag_cols[i]])}
                      for i, r in enumerate(fl.rules)]}


def ingest_batch(run: Run, sources: dict[str, DataFrame]) -> dict[str, int]:
    """Land each batch source in Bronze as this run's partition, then report its quality against
    the references as they came. The flagged rows are kept for Silver."""
    t0 = time.time()
    lake = run.lake
    names = [n for n in BATCH_DATASETS if n in sources]
    counts = dict(zip(names, run_all([
        (lambda n=n: lake.write_bronze(sources[n], n, f"raw/{n}", run.run_id, run.ts)) for n in names])))
    refs = {n: lake.read_bronze(n, bronze_runs_for_silver(lake, n)) for n in BATCH_DATASETS if lake.bronze_runs(n)}
    with sized_shuffles(run.spark, sum(lake.bytes_of("bronze", n, [run.run_id]) for n in names)):
        run.flagged.update(zip(names, run_all([
            (lambda n=n: _flag_bronze(run, n, read_bronze_for_silver(lake, n), refs)) for n in names])))
        reports = dict(zip(names, run_all([(lambda n=n: _report(run.flagged[n])) for n in names])))
    for name in names:
        run.edge(f"raw/{name}", f"bronze/{name}", "ingest_batch", counts[name])
        if not counts[name]:
            run.alert("WARN", "a batch source came without rows", dataset=name)
    total = sum(counts.values())
    run.stage("ingest_batch", total, total, time.time() - t0,
              round(min((r["pass_rate"] for r in reports.values()), default=1.0), 4),
              invalid_detected=sum(r["quarantined"] for r in reports.values()))
    check_volume_drift(run, "ingest_batch", total)
    return counts


def ingest_events(run: Run, events: DataFrame, source: str = "file") -> int:
    """Land one drain of events in Bronze (batch form of the streaming path)."""
    t0 = time.time()
    n = run.lake.write_bronze(events, "access_events", source, run.run_id, run.ts)
    if n == 0:
        run.alert("WARN", "the event queue was empty", dataset="access_events")
    run.edge("stream/access_events", "bronze/access_events", "event_consumer", n)
    run.stage("ingest_stream", n, n, time.time() - t0)
    check_volume_drift(run, "ingest_stream", n)
    return n


def drain_event_queue(run: Run, source_dir: str, archive_dir: str | None = None) -> int:
    """Streaming drain of the event file queue into this run's Bronze partition."""
    from lakehold.streaming.events import drain_events
    t0 = time.time()
    res = drain_events(run.spark, run.lake, source_dir, archive_dir, run_id=run.run_id, contract=run.contracts["access_events"])
    n, m = res["rows"], res["metrics"]
    if n == 0:
        run.alert("WARN", "the event queue was empty", dataset="access_events")
    else:
        run.edge("stream/access_events", "bronze/access_events", "event_consumer", n)
    bad = max(m.get("not_null:event_id", 0), m.get("in_set:event_type", 0))
    run.stage("ingest_stream", n, n, time.time() - t0,
              None if n == 0 else round(1 - bad / n, 4), 0, m.get("malformed", 0))
    return n


def check_volume_drift(run: Run, stage: str, rows: int,
                       tolerance: float = VOLUME_DRIFT_TOLERANCE) -> None:
    """Compare with the last successful run's output of ``stage`` in the run history."""
    hist = run.lake.read_json("logs", "runs", M.RUN_SCHEMA)
    prev = (hist.where((F.col("status") == M.SUCCESS) & F.col("stages")[stage].isNotNull())
            .orderBy(F.desc("ts"), F.desc("run_id")).limit(1)
            .select(F.col("stages")[stage]["rows_out"].alias("r")).collect())
    if not prev or not prev[0]["r"]:
        return
    before = prev[0]["r"]
    drift = abs(rows - before) / before
    if drift > tolerance:
        run.alert("WARN", f"rows of stage {stage} moved by {drift:.0%}", stage=stage, rows=rows, before=before)


# ---- silver ------------------------------------------------------------------------------

def bronze_runs_for_silver(lake: Lake, name: str) -> list[str]:
    """Runs a Silver build reads: the latest ingest run plus rows returned by reprocessing
    since the previous ingest run (not yet promoted by an ingest run)."""
    runs = lake.bronze_runs(name)
    ingest = [r for r in runs if not r.endswith(REPROCESS_SUFFIX)]
    if not ingest:
        return list(runs)
    since = ingest[-2] if len(ingest) > 1 else ""
    return [ingest[-1]] + [r for r in runs if r.endswith(REPROCESS_SUFFIX) and r > since]


def read_bronze_for_silver(lake: Lake, name: str) -> DataFrame:
    """Bronze input of Silver. A returned row replaces its original when both are read
    (anti-join on the original's run and position); rows keep their arrival position (original
    run, position) for keep-first."""
    runs = bronze_runs_for_silver(lake, name)
    df = lake.read_bronze(name, runs)
    if "_origin_run" not in df.columns:
        return df.withColumn("_arrival_run", F.col("run_id"))
    # a row that two reprocessing runs returned comes back once
    at = F.coalesce(F.col("_origin_drain"), F.lit("")) if "_origin_drain" in df.columns else F.lit("")
    df = df.withColumn("_origin_drain", at)
    own = df.where(F.col("_origin_run").isNull())
    back = df.where(F.col("_origin_run").isNotNull())
    origin = ["_origin_run", "_origin_drain", "_origin_ordinal"]
    latest = back.groupBy(*origin).agg(F.max("run_id").alias("run_id"))
    back = back.join(latest, [*origin, "run_id"], "left_semi")
    returned = key_set(back.select(F.col("_origin_run").alias("_xr"), F.col("_origin_drain").alias("_xd"), F.col("_origin_ordinal").alias("_xo")))
    own = own.withColumn("_own_drain", drain_of(own))
    kept = join_keyset(own, returned, lambda big, keys: (big["run_id"] == keys["_xr"]) & (big["_own_drain"] == keys["_xd"])
                       & (big["_ordinal"] == keys["_xo"]), "left_anti").drop("_own_drain")
    place = {DRAIN: F.when(F.col("_origin_run").isNotNull(), F.col("_origin_drain")).otherwise(F.col(DRAIN))} if DRAIN in df.columns else {}
    return kept.unionByName(back).withColumns({
        "_arrival_run": F.coalesce(F.col("_origin_run"), F.col("run_id")), **place,
        "_ordinal": F.coalesce(F.col("_origin_ordinal"), F.col("_ordinal"))}).drop("_origin_drain")


def _silver_dataset(run: Run, ds: str, refs: dict) -> dict:
    """Validate one dataset's Bronze input, write Silver and quarantine, both from the flagged rows."""
    lake, c = run.lake, run.contracts[ds]
    fl = run.flagged.get(ds) or _flag_bronze(run, ds, read_bronze_for_silver(lake, ds), refs)
    report = _report(fl)
    silver = to_silver(fl.valid().select(*fl.data_columns()), c, run.salt)
    writes = [lambda: lake.write(silver, "silver", ds)]
    if report["quarantined"]:
        writes.append(lambda: lake.write_quarantine(QR.quarantine_rows(fl, SILVER_REASON, run.run_id, run.ts), ds, run.run_id))
    run_all(writes)
    n_out = lake.read("silver", ds).count()
    run.edge(f"bronze/{ds}", f"silver/{ds}", "silver", n_out)
    return {**report, "rows_out": n_out}


def silver_job(run: Run, datasets=ALL_DATASETS) -> dict:
    """Silver for every dataset with Bronze input (datasets processed concurrently), then
    the quality gate: worst pass rate strictly below the threshold blocks Gold."""
    t0 = time.time()
    lake = run.lake
    present = [d for d in datasets if lake.bronze_runs(d)]
    refs = {n: lake.read_bronze(n, bronze_runs_for_silver(lake, n)) for n in BATCH_DATASETS if lake.bronze_runs(n)}
    with sized_shuffles(run.spark, sum(lake.bytes_of("bronze", d, bronze_runs_for_silver(lake, d)) for d in present)):
        outs = run_all([(lambda d=d: _silver_dataset(run, d, refs)) for d in present])
    result = {"datasets": dict(zip(present, outs)), "gate_ok": True}
    worst = min((d["pass_rate"] for d in result["datasets"].values()), default=1.0)
    result["worst_rate"] = worst
    if worst < run.gate_threshold:
        result["gate_ok"] = False
        run.alert("CRITICAL", f"gold not built: pass rate {worst:.2%} is below the gate of {run.gate_threshold:.2%}",
                  rate=worst, gate=run.gate_threshold)
    d = result["datasets"].values()
    run.stage("silver", sum(x["rows_in"] for x in d), sum(x["rows_out"] for x in d),
              time.time() - t0, round(worst, 4), sum(x["quarantined"] for x in d),
              sum(x["quarantined"] for x in d))
    return result


# ---- gold -----------------------------------------------------------------------------------

def gold_job(run: Run) -> dict[str, int]:
    """Six Gold tables + kpis from Silver. A table whose inputs are missing is skipped."""
    t0 = time.time()
    lake = run.lake
    silver = {d: lake.read("silver", d) for d in ALL_DATASETS if lake.has_rows_of("silver", d)}
    if not silver:
        raise TableMissing("no Silver table to build Gold from")
    tables = G.gold_tables(silver)

    def build(name):
        lake.write(tables[name], "gold", name)
        return lake.read("gold", name).count()

    with sized_shuffles(run.spark, sum(lake.bytes_of("silver", d) for d in silver)):
        produced = dict(zip(tables, run_all([(lambda n=n: build(n)) for n in tables])))
    for name in tables:
        run.edge("silver/*", f"gold/{name}", "gold", produced[name])
    for name in G.GOLD_QUERIES:
        if name not in produced:
            run.alert("WARN", "a Gold table was left out for want of its Silver tables", table=name)
    run.stage("gold", 0, sum(produced.values()), time.time() - t0)
    return produced


def rebuild_gold(spark: SparkSession, lake: Lake) -> bool:
    """Recovery: rebuild Gold from Silver; False when no Silver table exists."""
    if not any(lake.has_rows_of("silver", d) for d in ALL_DATASETS):
        return False
    run = Run(spark, lake)
    gold_job(run)
    run.alert("INFO", "Gold was built again from Silver")
    return True


# ---- governance ----------------------------------------------------------------------------

def _profile_layer(run: Run, layer: str, exact: bool) -> list:
    lake = run.lake
    parts, tables = [], {}
    for ds in ALL_DATASETS:
        if not (lake.bronze_runs(ds) if layer == "bronze" else lake.has_rows_of(layer, ds)):
            continue
        df = (lake.read_bronze(ds, bronze_runs_for_silver(lake, ds)).drop("run_id")
              if layer == "bronze" else lake.read("silver", ds))
        tables[ds] = df
        c = run.contracts[ds]
        # Silver keys passed not_null + unique: distinct = rows
        uniq = (c.key,) if layer == "silver" and c.key and c.dedup_is_noop() else ()
        if layer == "bronze" and not exact:
            profile_runs(run, [ds])
            of_runs = F.col("run_id").isin(bronze_runs_for_silver(lake, ds))
            parts.append(P.merge_states(read_profile_states(lake, ds).where(of_runs)))
        else:
            parts.append(P.profile(df, layer, ds, exact, known_unique=uniq))
    prof = None
    for p in parts:
        prof = p if prof is None else prof.unionByName(p)
    if prof is not None:
        # one partition directory per layer, so the two layers are written independently
        lake.write(prof.drop("layer"), "catalog", f"profile/layer={layer}")
    return list(tables.items())


def _state_batches(lake: Lake, ds: str) -> DataFrame | None:
    base = lake.path("catalog", f"profile_state/{ds}")
    paths = [f"{base}/batch={b}" for b in lake.list_partitions("catalog", f"profile_state/{ds}", "batch")]
    reader = lake.spark.read.schema(P.STATE_SCHEMA + ", batch string").option("basePath", base)
    return reader.parquet(*paths) if paths else None


def profile_runs(run: Run, datasets=ALL_DATASETS) -> None:
    """Profile states of this run's Bronze partitions, and of runs that have none yet: one pass over those
    partitions only. A repeated run replaces its own. (One name per run comes to the driver.)"""
    lake = run.lake
    for ds in datasets:
        states = _state_batches(lake, ds)
        known = set() if states is None else {
            r["run_id"] for r in states.where(F.col("batch") != run.run_id).select("run_id").distinct().collect()}
        todo = [r for r in lake.bronze_runs(ds) if r == run.run_id or r not in known]
        if todo:
            rows = lake.read_bronze(ds, todo)
            lake.put_partition(P.profile_state(rows, "bronze", ds, F.col("run_id")), "catalog", f"profile_state/{ds}", f"batch={run.run_id}")


def read_profile_states(lake: Lake, ds: str) -> DataFrame:
    """The state of each profiled Bronze run of a dataset: its own, else the last that a later run made up for."""
    states = _state_batches(lake, ds)
    if states is None:
        raise TableMissing(f"no profile state of {ds} yet")
    last = F.max_by("batch", F.struct(F.col("batch") == F.col("run_id"), F.col("batch")))
    return states.join(states.groupBy("run_id").agg(last.alias("batch")), ["run_id", "batch"], "left_semi").drop("batch")


def read_merged_profile(lake: Lake, datasets=ALL_DATASETS) -> DataFrame:
    """Profile of all Bronze rows of the profiled runs, from their states alone."""
    out = None
    for ds in datasets:
        if lake.list_partitions("catalog", f"profile_state/{ds}", "batch"):
            part = P.merge_states(read_profile_states(lake, ds))
            out = part if out is None else out.unionByName(part)
    if out is None:
        raise TableMissing("no profile state yet")
    return out


def governance_bronze(run: Run, exact: bool = True) -> None:
    """Profile of this run's Bronze input and schema drift against the contracts."""
    t0 = time.time()
    tables = dict(_profile_layer(run, "bronze", exact))
    for ds in tables:
        drift = {kind: ",".join(c for _, k, c in P.drift_items({ds: tables[ds]}, run.contracts) if k == kind)
                 for kind in ("missing", "unexpected")}
        if any(drift.values()):
            run.alert("WARN", f"schema drift in {ds}", dataset=ds, **drift)
    run.stage("governance_bronze", duration_s=time.time() - t0)


def governance_silver(run: Run, exact: bool = True) -> None:
    """Profile of Silver and the column dictionary."""
    t0 = time.time()
    _profile_layer(run, "silver", exact)
    run.lake.write(P.catalog_columns(run.spark, run.contracts), "catalog", "columns")
    run.stage("governance_silver", duration_s=time.time() - t0)


def governance(run: Run, exact: bool = True) -> DataFrame:
    """Profile Bronze (this run's batches) and Silver, schema drift of Bronze, catalogue."""
    run_all([lambda: governance_bronze(run, exact), lambda: governance_silver(run, exact)])
    return read_profile(run.lake)


def read_profile(lake: Lake) -> DataFrame:
    """Long-form profile: layer, dataset, column, rows, null_pct, n_distinct."""
    out = None
    for layer in ("bronze", "silver"):
        if lake.exists("catalog", f"profile/layer={layer}"):
            part = lake.read("catalog", f"profile/layer={layer}").withColumn("layer", F.lit(layer)).select(
                "layer", "dataset", "column", "rows", "null_pct", "n_distinct")
            out = part if out is None else out.unionByName(part)
    if out is None:
        raise TableMissing("no profile yet")
    return out


# ---- run record ---------------------------------------------------------------------------------

def finish(run: Run, status: str, config: dict | None = None) -> dict:
    record = {"run_id": run.run_id, "ts": run.ts, "status": status,
              "duration_s": round(time.time() - run.started, 3),
              "config": {k: str(v) for k, v in (config or {}).items()},
              "stages": run.stages, "alerts": run.alerts}
    spark, lake = run.spark, run.lake
    tasks = [lambda: lake.append_json("logs", "runs", spark.createDataFrame([record], M.RUN_SCHEMA))]
    if run.edges:
        tasks.append(lambda: lake.append_json("logs", "lineage",
                                              spark.createDataFrame(run.edges, M.LINEAGE_SCHEMA)))
    run_all(tasks)
    lake.compact_log("logs", "runs", M.RUN_SCHEMA)
    lake.compact_log("logs", "lineage", M.LINEAGE_SCHEMA)
    return record


def run_pipeline(spark: SparkSession, lake: Lake, sources: dict[str, DataFrame] | None,
                 events: DataFrame | None = None, as_of=None,
                 gate_threshold: float = QUALITY_GATE_MIN_PASS_RATE, salt: str | None = None,
                 profile_exact: bool = True, event_dir: str | None = None,
                 event_archive: str | None = None, contracts: dict | None = None) -> dict:
    """Full run: ingest -> Silver -> gate -> Gold -> governance -> run record.
    A failed gate leaves Gold as it was (Silver is written); status ``blocked_quality_gate``."""
    from concurrent.futures import ThreadPoolExecutor
    run = Run(spark, lake, as_of=as_of, gate_threshold=gate_threshold, salt=salt, contracts=contracts or CONTRACTS)
    config = {"format": lake.fmt, "gate_threshold": gate_threshold}
    pool = ThreadPoolExecutor(max_workers=2)
    try:
        if sources:
            ingest_batch(run, sources)
        if events is not None:
            ingest_events(run, events)
        if event_dir is not None:
            drain_event_queue(run, event_dir, event_archive)
        # Bronze profiling only reads Bronze: it overlaps with the Silver stage
        bronze_gov = pool.submit(wrap(lambda: governance_bronze(run, profile_exact)))
        res = silver_job(run)
        silver_gov = pool.submit(wrap(lambda: governance_silver(run, profile_exact)))
        status, gold = M.BLOCKED, None
        if res["gate_ok"]:
            gold = gold_job(run)      # overlaps with Silver profiling
            status = M.SUCCESS
        bronze_gov.result()
        silver_gov.result()
        rec = finish(run, status, config)
        out = {"status": status, "run_id": run.run_id, "silver": res, "record": rec}
        if gold is not None:
            out["gold"] = gold
        return out
    except Exception as exc:  # the run is recorded as failed, then the error propagates
        run.alert("CRITICAL", f"the run ended early: {exc}", error=type(exc).__name__)
        finish(run, M.FAILED, config)
        raise
    finally:
        pool.shutdown(wait=True)


# ---- reprocess quarantine -----------------------------------------------------------------------

def reprocess(spark: SparkSession, lake: Lake, dataset: str, as_of=None, contracts: dict | None = None) -> dict:
    """Re-check pending quarantine batches of ``dataset`` under the current rules with the
    Bronze tables as references. Rows that pass are appended to Bronze as their own run
    (``_source = reprocess``); rows that still fail go back to quarantine with a new reason;
    handled batches are recorded in the ledger.

    The run id comes from the batches and the latest ingest run, and every write replaces that run's
    partition: a run that died half-way is repeated without returning a row twice."""
    c = (contracts or CONTRACTS)[dataset]
    nothing = {"returned": 0, "still_invalid": 0, "batches": []}
    if not lake.list_partitions("quarantine", dataset):
        return nothing
    q = lake.read_quarantine(dataset)
    pending = key_set(QR.pending(QR.batches(q, dataset), lake.read_ledger()).select("run_id"))
    batch_ids = sorted(r["run_id"] for r in pending.collect())   # one per run
    if not batch_ids:
        return nothing
    ingested = [r for r in lake.bronze_runs(dataset) if not r.endswith(REPROCESS_SUFFIX)]
    mark = hashlib.sha256("|".join(batch_ids).encode()).hexdigest()[:8]
    run = Run(spark, lake, run_id=f"{ingested[-1] if ingested else new_run_id()}_{mark}{REPROCESS_SUFFIX}", as_of=as_of)
    with sized_shuffles(spark, lake.bytes_of("quarantine", dataset) + lake.bytes_of("bronze", dataset)):
        q = q.join(pending, "run_id", "left_semi")
        bronze = lake.read_bronze(dataset, ingested or None)
        refs = {n: lake.read_bronze(n, bronze_runs_for_silver(lake, n)) for n in BATCH_DATASETS if lake.bronze_runs(n)}
        fl = QR.recheck(q, bronze, c, refs, run.as_of)
        fl = fl.on(materialise(fl.df, f"recheck-{dataset}"))
        counts = Q.summary_counts(fl).first()
        n, n_bad = counts["n"], counts["n_invalid"]
        if n - n_bad:
            returned = fl.valid().select(*fl.public_columns(), F.col("_bronze_run_id").alias("_origin_run"),
                                         F.nullif(F.col(DRAIN), F.lit("")).alias("_origin_drain"), F.col("_ordinal").alias("_origin_ordinal"))
            lake.write_bronze(returned, dataset, REPROCESS_SOURCE, run.run_id, run.ts)
            run.edge(f"quarantine/{dataset}", f"bronze/{dataset}", "reprocess", n - n_bad)
        if n_bad:
            lake.write_quarantine(QR.quarantine_rows(fl, REPROCESS_REASON, run.run_id, run.ts), dataset, run.run_id)
    lake.record_processed(dataset, batch_ids, run.run_id, run.ts)
    if run.edges:
        lake.append_json("logs", "lineage", spark.createDataFrame(run.edges, M.LINEAGE_SCHEMA))
    return {"returned": int(n - n_bad), "still_invalid": int(n_bad), "batches": batch_ids,
            "run_id": run.run_id}


# ---- history ----------------------------------------------------------------------------------

def history(spark: SparkSession, lake: Lake, limit: int = 50) -> DataFrame:
    """The last ``limit`` run records, newest first; unparsable lines are dropped first."""
    return M.last_runs(lake.read_json("logs", "runs", M.RUN_SCHEMA), limit)


def alerts(spark: SparkSession, lake: Lake) -> DataFrame:
    return lake.read_json("logs", "alerts", M.ALERT)


# ---- health ----------------------------------------------------------------------------------

def health(spark: SparkSession, lake: Lake, as_of_ts: str | None = None, record: bool = True) -> dict:
    """Health of the latest run: items (name, status) and the overall worst status. A
    result other than ``ok`` is appended to the alert log (CRITICAL or WARN)."""
    out = _health(spark, lake, as_of_ts)
    if record and out["overall"] != "ok":
        bad = {k: v for k, v in out["items"].items() if v != "ok"}
        raised = {"run_id": "health-check", "ts": _iso(_now()), "severity": "CRITICAL" if out["overall"] == "critical" else "WARN",
                  "message": "health check: " + ", ".join(f"{k} {v}" for k, v in bad.items()), "context": bad}
        lake.append_json("logs", "alerts", spark.createDataFrame([raised], M.ALERT))
    return out


def monitor(spark: SparkSession, lake: Lake, recover: bool = True) -> dict:
    """Health check; when anything is wrong and ``recover`` is set, rebuild Gold from Silver and
    check again."""
    first = health(spark, lake)
    if recover and first["overall"] != "ok":
        rebuilt = rebuild_gold(spark, lake)
        return {"before": first, "recovered": rebuilt, "after": health(spark, lake)}
    return {"before": first, "recovered": False, "after": first}


def _gold_readable(lake: Lake) -> bool:
    """Whether Gold's headline table can be read through; any fault of it counts as no."""
    try:
        return len(lake.read("gold", "kpis").collect()) > 0   # five rows
    except (TableMissing, PySparkException, Py4JJavaError):
        return False


def _health(spark: SparkSession, lake: Lake, as_of_ts: str | None = None) -> dict:
    runs = lake.read_json("logs", "runs", M.RUN_SCHEMA)
    gold_ok = _gold_readable(lake)
    missing = {"bronze": [d for d in ALL_DATASETS if not lake.bronze_runs(d)],
               "silver": [d for d in ALL_DATASETS if not lake.has_rows_of("silver", d)]}
    named = [f"{layer}/{d}" for layer, tables in missing.items() for d in tables]
    rows = M.run_health(M.last_runs(runs, 1), gold_ok, missing, as_of_ts or _iso(_now())).collect()
    if not rows:
        return {"overall": "critical", "items": {"pipeline": "critical", "gold": "ok" if gold_ok else "critical"},
                "missing": named}
    r = rows[0].asDict()
    items = {k: r[k] for k in ("last_run", "freshness", "quality", "gold", *missing)}
    return {"overall": r["overall"], "items": items, "missing": named, "run_id": r["run_id"]}
