"""Benchmark: headline queries and the full job on $BENCH_SF_DIR.

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}. ``value`` is the
full job (ingest -> Silver -> gate -> Gold -> governance, with writes), median of
$BENCH_REPEAT runs on a warm session. Each query is forced with the ``noop`` sink (the
whole plan runs, nothing is collected to the driver).
"""
from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))

HEADLINE = ["top_books", "usage_by_genre", "rating_by_book", "rating_distribution", "loans_by_month",
            "events_by_type", "kpis", "quality_rule_report", "quality_dataset_report", "quality_gate",
            "quarantine_rows", "silver_loans", "silver_readers", "profile_columns", "volume_drift",
            "reprocess_valid"]


def _sf_label(path: str) -> str:
    base = os.path.basename(path.rstrip("/"))
    return base[2:] if base.startswith("sf") else base


def main() -> None:
    from lakehold import session
    from lakehold.functions.privacy import TEST_SALT
    from lakehold.plans import jobs as J
    from lakehold.plans.registry import queries
    from lakehold.sources import testdata as td
    from lakehold.sources.lake import Lake

    spark = session.build(master=f"local[{CPUS}]", shuffle_partitions=int(CPUS) * 2, app="lakehold-bench")
    qs = queries()

    def run_pipeline(sf_dir, gate=None):
        root = tempfile.mkdtemp(prefix="lakehold-bench-")
        lake = Lake(spark, root)
        src = td.load_all(spark, sf_dir)
        events = src.pop("access_events")
        kw = {"contracts": td.CONTRACTS, "salt": TEST_SALT} | ({} if gate is None else {"gate_threshold": gate})
        t = time.time()
        res = J.run_pipeline(spark, lake, src, events, as_of=td.AS_OF, **kw)
        return time.time() - t, res["status"]

    # warm-up: JIT, class loading, file listing caches
    run_pipeline("/root/testdata/sf0.001")
    for name in HEADLINE[:3]:
        qs[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()

    timings = {}
    for name in HEADLINE:
        if name not in qs:
            continue
        runs = []
        for _ in range(REPEAT):
            t = time.time()
            qs[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - t)
        timings[name] = round(statistics.median(runs), 3)

    # default gate (0.95): the dirty test tables block Gold, as the contract says they should
    pipe, status = [], None
    for _ in range(REPEAT):
        sec, status = run_pipeline(SF_DIR)
        pipe.append(sec)
    timings["full_job_gate_default"] = round(statistics.median(pipe), 3)
    # the whole path including Gold, as in the baseline's full runs (gate at 0.5)
    pipe_gold, status_gold = [], None
    for _ in range(REPEAT):
        sec, status_gold = run_pipeline(SF_DIR, gate=0.5)
        pipe_gold.append(sec)
    full = round(statistics.median(pipe_gold), 3)
    timings["full_job"] = full
    print(json.dumps({"metric": "full_job_median", "value": full, "unit": "sec",
                      "queries": timings, "sf": _sf_label(SF_DIR), "job_status": status_gold,
                      "job_status_gate_default": status, "gold_gate_threshold": 0.5,
                      "spark_version": spark.version, "cpus": int(CPUS),
                      "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
                      "repeat": REPEAT}))


if __name__ == "__main__":
    main()
