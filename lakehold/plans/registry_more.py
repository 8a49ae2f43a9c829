"""Registered queries, part two: profile, drift, catalogue, quarantine lifecycle,
reprocessing and monitoring (over the monthly replay of the given tables)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehold.contracts import ALL_DATASETS, QUALITY_GATE_MIN_PASS_RATE, REPROCESS_REASON, SILVER_REASON
from lakehold.operators import monitor as M
from lakehold.operators import profile as P
from lakehold.operators import quarantine as QR
from lakehold.plans import oracle as O
from lakehold.plans import replay as RP
from lakehold.plans.derived import Chain
from lakehold.plans.parallel import run_all
from lakehold.plans.registry import RUN_TS, _union, query
from lakehold.sources import testdata as td
from lakehold.sources.scratch import materialise
from lakehold.sources.testdata import CONTRACTS

BATCH_1 = "batch-0001"   # Silver quarantine of the replayed run
BATCH_2 = "batch-0002"   # re-quarantine by the reprocess run

# ---- profile, drift, catalogue -------------------------------------------------------------

PROFILE_COLUMNS = {
    ("bronze", "readers", "a_readers"): ["reader_id", "name", "email", "city", "signup_date"],
    ("bronze", "books", "a_books"): ["book_id", "title", "author", "genre", "year"],
    ("bronze", "loans", "a_loans"): ["loan_id", "reader_id", "book_id", "loan_date", "l_suppkey",
                                     "l_extendedprice", "l_quantity"],
    ("bronze", "ratings", "a_ratings"): ["rating_id", "reader_id", "book_id", "rating", "rating_date",
                                         "l_suppkey", "l_extendedprice"],
    ("bronze", "access_events", "a_events"): ["event_id", "reader_id", "event_type", "book_id", "event_ts",
                                              "props"],
    ("silver", "readers", "s_readers"): ["reader_id", "email", "city", "signup_date", "name_pseudo"],
    ("silver", "books", "s_books"): ["book_id", "title", "author", "genre", "year"],
    ("silver", "loans", "s_loans"): ["loan_id", "reader_id", "book_id", "loan_date", "l_suppkey",
                                     "l_extendedprice", "l_quantity"],
    ("silver", "ratings", "s_ratings"): ["rating_id", "reader_id", "book_id", "rating", "rating_date",
                                         "l_suppkey", "l_extendedprice"],
    ("silver", "access_events", "s_events"): ["event_id", "reader_id", "event_type", "book_id", "event_ts",
                                              "props"],
}


def _profile_body(layers=("bronze", "silver")) -> str:
    parts = []
    for (layer, ds, cte), cols in PROFILE_COLUMNS.items():
        if layer not in layers:
            continue
        for c in cols:
            parts.append(
                f"SELECT '{layer}' AS layer, '{ds}' AS dataset, '{c}' AS \"column\", count(*) AS rows, "
                f"floor(CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / count(*) * 10000 + 0.5) / 10000 "
                f"AS null_pct, count(DISTINCT {c}) AS n_distinct FROM {cte}")
    return "\nUNION ALL\n".join(parts)


def _bronze_profile(ch: Chain, ds: str):
    """Every column from a scan of its own, where the rows lie."""
    return P.profile(ch.raw(ds), "bronze", ds, only=lambda c: ch.raw(ds, {c}))


def _profiles(ch: Chain):
    """Bronze is read where it lies; Silver, which has to be made here, is written once and read from there."""
    ch.pass_all()
    silver = run_all([lambda ds=ds: materialise(ch.silver(ds), "profile") for ds in ALL_DATASETS])
    frames = []
    for ds, made in zip(ALL_DATASETS, silver, strict=True):
        c = CONTRACTS[ds]
        unique = (c.key,) if c.key and c.dedup_is_noop() else ()
        frames.append(_bronze_profile(ch, ds))
        frames.append(P.profile(made, "silver", ds, known_unique=unique))
    return _union(frames)


@query("profile_columns", O.with_chain(_profile_body()))
def profile_columns(spark, sf_dir):
    return _profiles(Chain(spark, sf_dir))


# the runs of a source: months of arrival, as far as its rows have a date
RUN_OF = {"loans": "substr(CAST(loan_date AS STRING), 1, 7)", "ratings": "substr(CAST(rating_date AS STRING), 1, 7)",
          "access_events": "substr(CAST(event_ts AS STRING), 1, 7)", "readers": "substr(signup_date, 1, 4)", "books": "CAST(year AS STRING)"}
ERRORS = 5  # standard errors of the sketches that an estimate may be off


def _merged_sql() -> str:
    parts = []
    for (layer, ds, cte), cols in PROFILE_COLUMNS.items():
        if layer == "bronze":
            n_runs = f"(SELECT count(DISTINCT coalesce({RUN_OF[ds].replace('STRING', 'VARCHAR')}, '-')) FROM {cte})"
            parts += [f"SELECT '{ds}' AS dataset, '{c}' AS \"column\", {n_runs} AS n_runs, count(*) AS rows, "
                      f"floor(CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / count(*) * 10000 + 0.5) / 10000 AS null_pct, "
                      f"count(DISTINCT {c}) AS n_distinct, true AS estimate_holds FROM {cte}" for c in cols]
    return "\nUNION ALL\n".join(parts)


@query("profile_merged", O.with_chain(_merged_sql()))
def profile_merged(spark, sf_dir):
    """Bronze profiles merged from the states of single runs, beside the exact count of distinct values."""
    ch = Chain(spark, sf_dir)
    states = materialise(_union(P.profile_state(ch.raw(ds), "bronze", ds, F.expr(RUN_OF[ds])) for ds in ALL_DATASETS), "states")
    n_runs = states.where("column is null").groupBy("dataset").agg(F.count(F.lit(1)).alias("n_runs"))
    exact = _union(_bronze_profile(ch, ds) for ds in ALL_DATASETS).select("dataset", "column", F.col("n_distinct").alias("exact"))
    bound = F.greatest(F.lit(1.0), F.col("exact") * (ERRORS * 1.04 / 2 ** (P.LG_K / 2)))
    return P.merge_states(states).join(n_runs, "dataset").join(exact, ["dataset", "column"]).select(
        "dataset", "column", "n_runs", "rows", "null_pct", F.col("exact").alias("n_distinct"),
        (F.abs(F.col("n_distinct") - F.col("exact")) <= bound).alias("estimate_holds"))


def _drift_sql() -> str:
    parts = []
    for (layer, ds, cte), cols in PROFILE_COLUMNS.items():
        if layer == "bronze":
            declared = set(CONTRACTS[ds].column_names)
            parts += [f"SELECT '{ds}' AS dataset, 'missing' AS kind, '{c}' AS \"column\", count(*) AS n_rows FROM {cte}"
                      for c in sorted(declared - set(cols))]
            parts += [f"SELECT '{ds}', 'unexpected', '{c}', count({c}) FROM {cte}" for c in sorted(set(cols) - declared)]
    return "\nUNION ALL\n".join(parts)


@query("schema_drift", O.with_chain(_drift_sql()))
def schema_drift(spark, sf_dir):
    """Contract against delivered columns of every source table, with the rows concerned."""
    ch = Chain(spark, sf_dir)
    return P.schema_drift({ds: ch.raw(ds) for ds in ALL_DATASETS}, CONTRACTS)


def _catalog_sql() -> str:
    parts = []
    for (layer, ds, cte), cols in PROFILE_COLUMNS.items():
        if layer == "silver":
            facts = ", ".join(f"'{CONTRACTS[ds].about[k]}' AS {k}" for k in P.META)
            parts.append(f"SELECT '{ds}' AS dataset, {facts}, CAST({len(cols)} AS BIGINT) AS n_columns, count(*) AS n_rows FROM {cte}")
    return "\nUNION ALL\n".join(parts)


@query("catalog_summary", O.with_chain(_catalog_sql()))
def catalog_summary(spark, sf_dir):
    ch = Chain(spark, sf_dir)
    ch.pass_all()
    return P.catalog_summary({ds: ch.silver(ds) for ds in ALL_DATASETS}, CONTRACTS)


# ---- quarantine lifecycle and reprocessing ---------------------------------------------------

LATER = "2002-01-01 00:00:00"


def _quarantined(ch: Chain) -> dict:
    """The rows that the replayed run quarantines, of every dataset; written, so that flags are evaluated once.
    So are the lines: they are flagged, quarantined, re-checked and merged."""
    ch.store_lines()
    ch.flag_all()
    rows = run_all([lambda ds=ds: materialise(QR.quarantine_rows(ch.flagged(ds), SILVER_REASON, BATCH_1, RUN_TS), "quarantined")
                    for ds in ALL_DATASETS])
    return dict(zip(ALL_DATASETS, rows, strict=True))


def _rechecked(ch: Chain, quarantined: dict) -> dict:
    again = run_all([lambda ds=ds, q=q: QR.recheck(q, ch.raw(ds), CONTRACTS[ds], ch.refs, td.LATER_AS_OF,
                                                     only=lambda columns: ch.raw(ds, columns),
                                                     repeated=ch.flagged(ds).repeated.get(CONTRACTS[ds].key))
                     for ds, q in quarantined.items()])
    return dict(zip(quarantined, again, strict=True))


def _reprocessed(ch: Chain) -> dict:
    """Rows of every dataset quarantined by the replayed run, re-checked with a later ``as_of``."""
    return _rechecked(ch, _quarantined(ch))


def _quarantine_tables(ch: Chain) -> dict:
    first = _quarantined(ch)
    return {ds: first[ds].unionByName(QR.quarantine_rows(fl, REPROCESS_REASON, BATCH_2, RUN_TS), allowMissingColumns=True)
            for ds, fl in _rechecked(ch, first).items()}


def _data_columns(ds: str) -> str:
    return ", ".join(PROFILE_COLUMNS["bronze", ds, next(c for _, d, c in PROFILE_COLUMNS if d == ds)])


def _recheck_sql() -> str:
    """Per dataset: one candidate of equal quarantined rows, flagged again with the later instant."""
    parts = []
    for ds, cte, key, rules in O.RULES:
        columns = _data_columns(ds)
        again = []
        for i, (kind, _, _) in enumerate(rules):
            if kind == "unique":
                again.append(f"{key} IS NOT NULL AND min(rk) > 1 AS r{i}")
            elif ds == "loans" and kind == "not_future":
                again.append(f"coalesce(loan_date > TIMESTAMP '{LATER}', false) AS r{i}")
            else:
                again.append(f"bool_or(r{i}) AS r{i}")
        parts.append(f"c_{ds} AS (SELECT {columns}, {', '.join(again)} FROM {cte} WHERE {O.any_failed(len(rules))} GROUP BY {columns})")
    return ",\n".join(parts)


RECHECK_SQL = _recheck_sql()


def _chain_plus(extra: str, body: str) -> str:
    return ("WITH " + O.ADAPTERS + "," + O.flags() + "," + O.silver() + "," + extra + "\n" + body)


def _each(select) -> str:
    """``select(dataset, cte, key, rules)`` of every dataset's candidates, united."""
    return "\nUNION ALL\n".join(select(ds, f"c_{ds}", key, rules) for ds, _, key, rules in O.RULES)


STILL_INVALID = _each(lambda ds, cte, key, rules: (
    f"SELECT '{ds}' AS dataset, CAST({key} AS VARCHAR) AS row_key, {O.failed_rules_sql(rules)} AS failed_rules, "
    f"'{REPROCESS_REASON}' AS reason FROM {cte} WHERE {O.any_failed(len(rules))}"))
Q_ALL_SQL = RECHECK_SQL + f""",
q_all AS (
  SELECT dataset, row_key, failed_rules, reason, '{BATCH_1}' AS run_id FROM (
    {O.quarantine_rows_body(SILVER_REASON)}) s
  UNION ALL
  SELECT dataset, row_key, failed_rules, reason, '{BATCH_2}' FROM (
    {STILL_INVALID}) t)"""


@query("reprocess_valid", _chain_plus(RECHECK_SQL, _each(lambda ds, cte, key, rules: (
    f"SELECT '{ds}' AS dataset, CAST({key} AS VARCHAR) AS row_key FROM {cte} WHERE NOT {O.any_failed(len(rules))}"))))
def reprocess_valid(spark, sf_dir):
    return _union(fl.valid().select(F.lit(ds).alias("dataset"), F.col(CONTRACTS[ds].row_key).cast("string").alias("row_key"))
                  for ds, fl in _reprocessed(Chain(spark, sf_dir)).items())


@query("reprocess_invalid", _chain_plus(RECHECK_SQL, STILL_INVALID))
def reprocess_invalid(spark, sf_dir):
    return _union(QR.quarantine_view(fl, REPROCESS_REASON) for fl in _reprocessed(Chain(spark, sf_dir)).values())


def _merge_sql(ds: str, cte: str, key: str, rules) -> str:
    columns, bronze = _data_columns(ds), next(c for layer, d, c in PROFILE_COLUMNS if (layer, d) == ("bronze", ds))
    return (f"SELECT '{ds}' AS dataset, CAST({key} AS VARCHAR) AS row_key, count(*) AS n_rows FROM (SELECT {columns} FROM {bronze} UNION "
            f"SELECT {columns} FROM {cte} WHERE NOT {O.any_failed(len(rules))}) u GROUP BY {key}")


@query("reprocess_merge", _chain_plus(RECHECK_SQL, _each(_merge_sql)))
def reprocess_merge(spark, sf_dir):
    """Bronze after the returned rows were merged: different rows per key."""
    ch = Chain(spark, sf_dir)
    again = _reprocessed(ch)

    def merged(ds: str) -> DataFrame:
        returned, key = again[ds].valid().select(*again[ds].public_columns()), CONTRACTS[ds].key
        _, marks = ch.flagged(ds).repeated.get(key, (None, None))
        return QR.merge_into_bronze(ch.raw(ds), returned if marks is None else materialise(returned, "returned"), key, marks)

    frames = run_all([lambda ds=ds: merged(ds) for ds in ALL_DATASETS])
    return _union(rows.groupBy(F.col(CONTRACTS[ds].row_key).alias("row_key")).agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(ds).alias("dataset"), F.col("row_key").cast("string").alias("row_key"), "n_rows") for ds, rows in zip(ALL_DATASETS, frames, strict=True))


@query("quarantine_listing", _chain_plus(Q_ALL_SQL, """
SELECT q.dataset, count(*) AS n_rows, count(DISTINCT run_id) AS n_batches,
  string_agg(DISTINCT reason, ',' ORDER BY reason) AS reasons, r.rules
FROM q_all q JOIN (SELECT dataset, string_agg(DISTINCT rule, ',' ORDER BY rule) AS rules
                   FROM (SELECT dataset, unnest(string_split(failed_rules, ',')) AS rule FROM q_all) u
                   GROUP BY dataset) r ON r.dataset = q.dataset
GROUP BY q.dataset, r.rules"""))
def quarantine_listing(spark, sf_dir):
    tables = _quarantine_tables(Chain(spark, sf_dir))
    return _union(QR.listing(df, ds) for ds, df in tables.items())


@query("quarantine_pending", _chain_plus(Q_ALL_SQL, f"""
SELECT dataset, run_id, count(*) AS n_rows FROM q_all
WHERE NOT (dataset IN ('loans', 'books') AND run_id = '{BATCH_1}') GROUP BY dataset, run_id"""))
def quarantine_pending(spark, sf_dir):
    tables = _quarantine_tables(Chain(spark, sf_dir))
    batches = _union(QR.batches(df, ds) for ds, df in tables.items())
    # the reprocess run handled two batches of the first run
    ledger = spark.createDataFrame([(ds, BATCH_1, BATCH_2, RUN_TS) for ds in ("loans", "books")], "dataset string, run_id string, "
                                   "processed_by string, processed_at string")
    return QR.pending(batches, ledger)


# ---- monitoring over the monthly replay -----------------------------------------------------

GATE = QUALITY_GATE_MIN_PASS_RATE


def _month_sql(ds: str, cte: str, ts_expr: str, n_rules: int) -> str:
    return (f"SELECT '{ds}' AS ds, coalesce(strftime({ts_expr}, '%Y-%m'), 'undated') AS month, "
            f"coalesce(strftime(date_trunc('month', {ts_expr}) + INTERVAL 1 MONTH, '%Y-%m-%dT%H:%M:%S'), "
            f"'9999-12-31T00:00:00') AS ts, count(*) AS n, count(*) FILTER (WHERE {O.any_failed(n_rules)}) AS n_bad "
            f"FROM {cte} GROUP BY 1, 2, 3")


MONTHS_SQL = "\n  UNION ALL ".join((
    _month_sql("readers", "f_readers", "try_strptime(signup_date, '%Y-%m-%d')", 5),
    _month_sql("books", "f_books", "CAST(NULL AS TIMESTAMP)", 5), _month_sql("loans", "f_loans", "loan_date", 5),
    _month_sql("ratings", "f_ratings", "rating_date", 5), _month_sql("access_events", "f_events", "event_ts", 2)))
RUNS_SQL = f"""
rm AS ({MONTHS_SQL}),
runs AS (SELECT ds || '-' || month AS run_id, ds, ts, n, n_bad, CAST(n - n_bad AS DOUBLE) / n AS rate,
  floor(CAST(n - n_bad AS DOUBLE) / n * 10000 + 0.5) / 10000 AS rate4,
  CASE WHEN CAST(n - n_bad AS DOUBLE) / n >= {GATE} THEN 'success' ELSE 'blocked_quality_gate' END AS status
  FROM rm)"""


def _runs(spark, sf_dir):
    return RP.replay_runs(Chain(spark, sf_dir))


@query("run_history", _chain_plus(RUNS_SQL, """
SELECT run_id, ts, status, n AS rows_in, rate4 AS quality_rate, n_bad AS quarantined,
  CAST(CASE WHEN status = 'success' THEN 0 ELSE 1 END AS BIGINT) AS n_alerts FROM runs"""))
def run_history(spark, sf_dir):
    return M.run_history(_runs(spark, sf_dir)).drop("duration_s")


@query("alert_history", _chain_plus(RUNS_SQL, f"""
SELECT run_id, ts, 'CRITICAL' AS severity,
  'pass rate ' || printf('%.4f', rate4) || ' is below the gate of {GATE}' AS message
FROM runs WHERE status <> 'success'"""))
def alert_history(spark, sf_dir):
    return M.alert_history(_runs(spark, sf_dir))


@query("volume_drift", _chain_plus(RUNS_SQL, """,
st AS (SELECT run_id, ds, ts, status, CASE WHEN ds = 'access_events' THEN 'ingest_stream' ELSE 'ingest_batch' END AS stage, n AS rows FROM runs
  UNION ALL SELECT run_id, ds, ts, status, 'silver', n - n_bad FROM runs),
d AS (SELECT *,
  last_value(CASE WHEN status = 'success' THEN rows END IGNORE NULLS)
    OVER (PARTITION BY ds, stage ORDER BY ts, run_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_rows FROM st)
SELECT run_id, ts, status, stage, rows, prev_rows,
  CASE WHEN prev_rows IS NULL OR prev_rows = 0 THEN NULL ELSE abs(rows - prev_rows) / CAST(prev_rows AS DOUBLE) END AS drift,
  coalesce(CASE WHEN prev_rows IS NULL OR prev_rows = 0 THEN NULL
                ELSE abs(rows - prev_rows) / CAST(prev_rows AS DOUBLE) > 0.5 END, false) AS warn
FROM d"""))
def volume_drift(spark, sf_dir):
    return M.volume_drift(_runs(spark, sf_dir))


@query("run_health", _chain_plus(RUNS_SQL, f""",
h AS (SELECT *, (epoch(coalesce(lead(CAST(ts AS TIMESTAMP)) OVER (PARTITION BY ds ORDER BY ts, run_id), CAST(ts AS TIMESTAMP)))
                 - epoch(CAST(ts AS TIMESTAMP))) / 3600.0 AS age_hours FROM runs),
i AS (SELECT run_id, ts, status, age_hours, rate4 AS quality_rate,
  CASE WHEN status = 'success' THEN 'ok' ELSE 'critical' END AS last_run,
  CASE WHEN age_hours > 26.0 THEN 'alert' ELSE 'ok' END AS freshness,
  CASE WHEN rate4 IS NULL THEN 'ok' WHEN rate4 < {GATE} THEN 'critical' WHEN rate4 < 0.99 THEN 'alert'
       ELSE 'ok' END AS quality FROM h)
SELECT *, CASE greatest(CASE last_run WHEN 'critical' THEN 2 WHEN 'alert' THEN 1 ELSE 0 END,
                        CASE freshness WHEN 'critical' THEN 2 WHEN 'alert' THEN 1 ELSE 0 END,
                        CASE quality WHEN 'critical' THEN 2 WHEN 'alert' THEN 1 ELSE 0 END)
          WHEN 2 THEN 'critical' WHEN 1 THEN 'alert' ELSE 'ok' END AS overall FROM i"""))
def run_health(spark, sf_dir):
    return M.run_health(_runs(spark, sf_dir))


LINEAGE_SQL = f"""
mm AS ({MONTHS_SQL}),
edges AS (
  SELECT 'raw/' || ds AS source, 'bronze/' || ds AS target,
         CASE WHEN ds = 'access_events' THEN 'event_consumer' ELSE 'ingest_batch' END AS process, n AS rows, ts,
         ds || '-' || month AS run_id, 0 AS seq FROM mm
  UNION ALL
  SELECT 'bronze/' || ds, 'silver/' || ds, 'silver', n - n_bad, ts, ds || '-' || month, 1 FROM mm)"""


@query("lineage_latest", _chain_plus(LINEAGE_SQL, """
SELECT source, target, process, rows, ts, run_id FROM (
  SELECT *, row_number() OVER (PARTITION BY source, target ORDER BY ts DESC, run_id DESC, seq DESC) AS rn
  FROM edges) e WHERE rn = 1"""))
def lineage_latest(spark, sf_dir):
    return M.lineage_latest(RP.replay_lineage(Chain(spark, sf_dir)))


# ---- streaming ---------------------------------------------------------------------------------

@query("stream_events_by_type",
       "SELECT event_type, count(*) AS total FROM events GROUP BY event_type")
def stream_events_by_type(spark, sf_dir):
    """T5: the events table consumed as a stream, stateful count per type (complete mode)."""
    from lakehold.streaming.events import stream_counts_by_type
    return stream_counts_by_type(spark, f"{sf_dir.rstrip('/')}/events.parquet")
