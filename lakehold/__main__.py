"""Command line: ``python -m lakehold <command> --lake ROOT ...`` (or through spark-submit).

  run        ingest raw CSVs (<lake>/raw/<dataset>.csv) and the event queue, Silver, gate,
             Gold, governance; exit code 0 for success or a blocked gate, 1 on failure
  reprocess  re-check the pending quarantine batches of one dataset
  listing    quarantine listing per dataset
  health     health of the latest run (``--recover`` rebuilds Gold from Silver when down)
"""
from __future__ import annotations

import argparse
import json
import sys


def _session(master: str | None):
    from lakehold import session
    if master:
        return session.build(master=master)
    from pyspark.sql import SparkSession
    spark = SparkSession.builder.appName("lakehold").getOrCreate()
    session.configure(spark)
    session.ensure_checkpoint_dir(spark)
    return spark


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="lakehold")
    p.add_argument("command", choices=["run", "reprocess", "listing", "health"])
    p.add_argument("dataset", nargs="?")
    p.add_argument("--lake", required=True, help="lake root (local path or Hadoop URI)")
    p.add_argument("--master", default=None)
    p.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    p.add_argument("--event-dir", default=None, help="event queue directory (JSON lines)")
    p.add_argument("--event-archive", default=None)
    p.add_argument("--gate", type=float, default=None, help="minimum pass rate (default 0.95)")
    p.add_argument("--as-of", default=None, help="instant for not_future (default: run start)")
    p.add_argument("--recover", action="store_true")
    a = p.parse_args(argv)

    from lakehold.contracts import BATCH_DATASETS, CONTRACTS, QUALITY_GATE_MIN_PASS_RATE
    from lakehold.operators import monitor as M
    from lakehold.operators import quarantine as QR
    from lakehold.plans import jobs as J
    from lakehold.sources.lake import Lake

    spark = _session(a.master)
    lake = Lake(spark, a.lake, a.format)

    if a.command == "run":
        # a malformed line keeps its text in _corrupt_record through Bronze into quarantine
        sources = {ds: lake.read_raw_csv(ds, CONTRACTS[ds].spark_schema())
                   for ds in BATCH_DATASETS if lake.exists("raw", f"{ds}.csv")}
        try:
            res = J.run_pipeline(spark, lake, sources, None, as_of=a.as_of,
                                 gate_threshold=QUALITY_GATE_MIN_PASS_RATE if a.gate is None else a.gate,
                                 event_dir=a.event_dir, event_archive=a.event_archive)
        except Exception as exc:  # recorded as a failed run by the job
            print(json.dumps({"status": M.FAILED, "error": str(exc)}))
            return 1
        print(json.dumps({"status": res["status"], "run_id": res["run_id"],
                          "worst_rate": res["silver"]["worst_rate"]}))
        return 0
    if a.command == "reprocess":
        if a.dataset not in CONTRACTS:
            p.error(f"unknown dataset {a.dataset!r}")
        print(json.dumps(J.reprocess(spark, lake, a.dataset, as_of=a.as_of)))
        return 0
    if a.command == "listing":
        rows = []
        for ds in CONTRACTS:
            if lake.list_partitions("quarantine", ds):
                rows += [r.asDict() for r in QR.listing(lake.read_quarantine(ds), ds).collect()]
        print(json.dumps(rows))
        return 0
    out = J.monitor(spark, lake, recover=a.recover)
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
