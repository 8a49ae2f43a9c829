"""Inputs and crashes beside the usual path: ties, several snapshots, empty sources, lost commits,
damaged files, lines of the wrong length."""
import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from lakehold_suite import SF_SMALL, run_pipeline
from lakehold.contracts import CONTRACTS, CORRUPT_RULE
from lakehold.operators import profile as P
from lakehold.operators import quality as Q
from lakehold.operators.keys import dedup_keep_first
from lakehold.plans import jobs as J
from lakehold.plans.derived import Chain
from lakehold.plans.registry import queries
from lakehold.sources import testdata as td
from lakehold.sources.lake import Lake
from lakehold.streaming import events as S

BOOKS = "book_id long, title string, author string, genre string, year long"


def sources(spark):
    src = td.load_all(spark, SF_SMALL)
    return src, src.pop("access_events")


def test_identical_rows_are_duplicates(spark):
    books = spark.createDataFrame([(1, "t", "a", "Poesia", 2000)] * 3 + [(None, "t", "a", "Poesia", 2000)] * 2, BOOKS)
    report = {(r["rule"], r["column"]): r["failed"] for r in Q.rule_report(Q.flag(books, CONTRACTS["books"])).collect()}
    assert report["unique", "book_id"] == 2
    kept = dedup_keep_first(books, "book_id", [])
    assert kept.columns == books.columns and sorted(r["book_id"] or 0 for r in kept.collect()) == [0, 1]


@pytest.mark.parametrize("partition_bytes", ["128m", "4k"])
def test_the_first_line_of_a_file_is_kept(spark, tmp_path, partition_bytes):
    lake = Lake(spark, str(tmp_path / "lake"))
    os.makedirs(lake.path("raw", ""))
    with open(lake.path("raw", "books.csv"), "w") as f:
        f.write("book_id,title,author,genre,year\n")
        for copy in ("first", "second"):
            f.writelines(f"{i},{copy},a,Poesia,2000\n" for i in range(1000))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", partition_bytes)
    try:
        n = lake.write_bronze(lake.read_raw_csv("books", CONTRACTS["books"].spark_schema()), "books", "raw", "r1", "t")
        fl = Q.flag(lake.read_bronze("books"), CONTRACTS["books"])
        valid = fl.valid().select("title").distinct().collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert n == 2000 and [r["title"] for r in valid] == ["first"]


def test_short_lines_go_to_quarantine(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    os.makedirs(lake.path("raw", ""))
    with open(lake.path("raw", "books.csv"), "w") as f:
        f.write("book_id,title,author,genre,year\n1,T,A,Poesia,2000\n2,U,B,Poesia\n")
    raw = lake.read_raw_csv("books", CONTRACTS["books"].spark_schema())
    lake.write_bronze(raw, "books", "raw", "r1", "t")
    bad = Q.flag(lake.read_bronze("books"), CONTRACTS["books"]).invalid().collect()
    assert [(r["book_id"], CORRUPT_RULE in r[Q.FAILED]) for r in bad] == [(2, True)]


def test_two_snapshots_return_each_row_once(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    src, _ = sources(spark)
    once = Lake(spark, str(tmp_path / "once"))
    run_pipeline(spark, once, src, None, as_of=td.AS_OF, gate_threshold=0.0)
    want = J.reprocess(spark, once, "loans", as_of=td.LATER_AS_OF, contracts=td.CONTRACTS)
    for _ in range(2):
        run_pipeline(spark, lake, src, None, as_of=td.AS_OF, gate_threshold=0.0)
    got = J.reprocess(spark, lake, "loans", as_of=td.LATER_AS_OF, contracts=td.CONTRACTS)
    assert (got["returned"], got["still_invalid"]) == (want["returned"], want["still_invalid"]) and want["returned"]
    back = lake.read_bronze("loans", [got["run_id"]])
    assert back.where("loan_id is not null").groupBy("loan_id").count().where("count > 1").count() == 0
    # a run that died after its writes, before the ledger, is repeated without a second copy
    shutil.rmtree(lake.path("quarantine", "_ledger"))
    n = lake.read_bronze("loans", lake.bronze_runs("loans")).count()
    lake.delete("quarantine", f"loans/run_id={got['run_id']}")
    again = J.reprocess(spark, lake, "loans", as_of=td.LATER_AS_OF, contracts=td.CONTRACTS)
    assert again["run_id"] == got["run_id"] and lake.read_bronze("loans", lake.bronze_runs("loans")).count() == n
    res = run_pipeline(spark, lake, None, None, as_of=td.LATER_AS_OF, gate_threshold=0.0)
    silver = lake.read("silver", "loans")
    assert silver.count() == silver.select("loan_id").distinct().count() == res["silver"]["datasets"]["loans"]["rows_out"]


def events_queue(tmp_path, n, name="a.jsonl", kind="busca"):
    q = tmp_path / "queue"
    q.mkdir(exist_ok=True)
    (q / name).write_text("".join(json.dumps({"event_id": f"{name}{i}", "reader_id": i, "event_type": kind, "book_id": 1,
                                              "event_ts": "2024-01-01T00:00:00"}) + "\n" for i in range(n)))
    return str(q)


def test_a_replayed_drain_leaves_each_event_once(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    q = events_queue(tmp_path, 10)
    assert S.drain_events(spark, lake, q)["rows"] == 10
    commits = os.path.join(lake.path("logs", "checkpoints/events_bronze"), "commits")
    for f in os.listdir(commits):   # the commit of the batch is lost, its rows are there
        os.remove(os.path.join(commits, f))
    assert S.drain_events(spark, lake, q)["rows"] == 10
    assert lake.read_bronze("access_events", lake.bronze_runs("access_events")).count() == 10
    events_queue(tmp_path, 5, "b.jsonl")
    assert S.drain_events(spark, lake, q)["rows"] == 5
    assert lake.read_bronze("access_events", lake.bronze_runs("access_events")).count() == 15


def test_many_micro_batches_are_all_counted(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    for i in range(12):
        q = events_queue(tmp_path, 1, f"f{i:03d}.jsonl")
    res = S.drain_events(spark, lake, S.event_source(spark, q, max_files_per_trigger=1))
    assert (res["rows"], res["batches"]) == (12, 12)


def test_streamed_events_can_be_reprocessed(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    run_pipeline(spark, lake, None, None, event_dir=events_queue(tmp_path, 6, kind="busca"), gate_threshold=0.0)
    got = J.reprocess(spark, lake, "access_events")   # the product contract allows the type, the other does not
    assert (got["returned"], got["still_invalid"]) == (6, 0)
    assert J.reprocess(spark, lake, "access_events")["returned"] == 0


def test_runs_without_rows(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    q = tmp_path / "queue"
    q.mkdir()
    res = run_pipeline(spark, lake, {"books": spark.createDataFrame([], BOOKS)}, None, event_dir=str(q))
    assert res["status"] == "success" and res["silver"]["worst_rate"] == 1.0
    assert lake.read("silver", "books").count() == 0
    raised = [(a["message"], a["context"]["dataset"]) for a in J.alerts(spark, lake).collect() if a["severity"] == "WARN" and "dataset" in a["context"]]
    assert ("a batch source came without rows", "books") in raised and ("the event queue was empty", "access_events") in raised
    prof = {r["column"]: (r["rows"], r["n_distinct"]) for r in J.read_profile(lake).where("layer = 'silver'").collect()}
    assert prof and set(prof.values()) == {(0, 0)}


@pytest.mark.parametrize("exact", [True, False])
def test_profile_of_an_empty_table_lists_its_columns(spark, exact):
    rows = P.profile(spark.createDataFrame([], BOOKS), "bronze", "books", exact).collect()
    assert {(r["column"], r["rows"], r["null_pct"], r["n_distinct"]) for r in rows} == {(c, 0, 0.0, 0) for c in ("book_id", "title", "author", "genre", "year")}


def test_damaged_gold_is_critical_and_rebuilt(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    src, events = sources(spark)
    run_pipeline(spark, lake, src, events, as_of=td.AS_OF, gate_threshold=0.0)
    folder = lake.location("gold", "kpis")
    for f in os.listdir(folder):
        if f.endswith(".parquet"):
            with open(os.path.join(folder, f), "wb") as out:
                out.write(b"PAR1 not a table")
            crc = os.path.join(folder, f".{f}.crc")
            if os.path.exists(crc):
                os.remove(crc)
    seen = J.monitor(spark, lake)
    assert seen["before"]["items"]["gold"] == "critical" and seen["recovered"] and seen["after"]["items"]["gold"] == "ok"


def test_columns_of_later_quarantine_batches_stay(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    for i, extra in enumerate(([], ["note"])):
        cols = [F.lit(x).alias(x) for x in extra]
        lake.write_quarantine(spark.range(2).select("id", *cols), "books", f"r{i}")
    assert lake.read_quarantine("books").where("note = 'note'").count() == 2


def test_plans_start_at_pruned_scans(spark):
    for key, columns in (("rule_not_null", None), ("rule_in_range", "l_quantity"), ("rule_in_set", None), ("rule_not_future", None)):
        plan = queries()[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "ExistingRDD" not in plan, key
    plan = queries()["rule_in_range"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan


def test_stream_of_a_table_in_parts(spark, tmp_path):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    got = {r["event_type"]: r["total"] for r in S.stream_counts_by_type(spark, str(tmp_path / "events.parquet")).collect()}
    assert got == {r["event_type"]: r["count"] for r in events.groupBy("event_type").count().collect()}


def test_all_datasets_are_replayed(spark):
    runs = queries()["run_history"](spark, SF_SMALL)
    assert {r["d"] for r in runs.selectExpr("split(run_id, '-')[0] AS d").distinct().collect()} == set(td.CONTRACTS)
    assert Chain(spark, SF_SMALL).flagged("ratings").df.count() > spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()


def test_own_contract_values():
    rules = {(r.kind, r.column): r.param for c in CONTRACTS.values() for r in c.rules}
    assert "Poesia" in rules["in_set", "genre"] and "busca" in rules["in_set", "event_type"]
    assert not any(c.order_by for c in CONTRACTS.values())
