"""End-to-end runs over a lake in a temporary folder, fed from the sf0.001 tables."""
import json
import os

import pytest
from pyspark.sql import functions as F

from lakehold_suite import SF_SMALL, run_pipeline
from lakehold.operators import monitor as M
from lakehold.plans import jobs as J
from lakehold.sources import testdata as td
from lakehold.sources.lake import Lake, TableMissing


def _sources(spark):
    src = td.load_all(spark, SF_SMALL)
    return src, src.pop("access_events")


@pytest.fixture(scope="module")
def ran(spark, tmp_path_factory):
    lake = Lake(spark, str(tmp_path_factory.mktemp("lake")))
    src, events = _sources(spark)
    res = run_pipeline(spark, lake, src, events, as_of=td.AS_OF, gate_threshold=0.5)
    return lake, res


def test_run_succeeds_with_gold_and_quarantine(spark, ran):
    lake, res = ran
    assert res["status"] == M.SUCCESS
    kpis = lake.read("gold", "kpis").collect()
    assert len(kpis) == 5 and sum(r["value"] for r in kpis) > 0
    assert lake.read_quarantine("loans").count() > 0
    # valid + quarantined = input, per dataset
    for ds, d in res["silver"]["datasets"].items():
        assert d["rows_out"] + d["quarantined"] == d["rows_in"], ds
    # personal data never reaches Silver in clear
    silver = lake.read("silver", "readers")
    assert "name" not in silver.columns and "name_pseudo" in silver.columns
    assert silver.where(~F.col("email").contains("*")).where(F.col("email").contains("@")).count() == 0


def test_gold_matches_query_form(spark, ran):
    lake, _ = ran
    from lakehold.plans.derived import Chain
    ch = Chain(spark, SF_SMALL)
    for name in ("top_books", "usage_by_genre", "rating_distribution", "loans_by_month", "kpis"):
        a = sorted(map(tuple, lake.read("gold", name).collect()))
        b = sorted(map(tuple, ch.gold(name).collect()))
        assert a == b, name


def test_run_record_and_lineage(spark, ran):
    lake, res = ran
    runs = lake.read_json("logs", "runs", M.RUN_SCHEMA)
    assert runs.count() == 1
    r = runs.collect()[0]
    assert r["status"] == M.SUCCESS and r["stages"]["silver"]["quarantined"] > 0
    edges = lake.read_json("logs", "lineage", M.LINEAGE_SCHEMA)
    latest = M.lineage_latest(edges).collect()
    assert {("raw/loans", "bronze/loans"), ("bronze/loans", "silver/loans"), ("silver/*", "gold/kpis")} <= \
        {(e["source"], e["target"]) for e in latest}


def test_gate_blocks_gold_but_writes_silver(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    src, events = _sources(spark)
    res = run_pipeline(spark, lake, src, events, as_of=td.AS_OF)   # default threshold 0.95
    assert res["status"] == M.BLOCKED
    assert lake.exists("silver", "loans") and not lake.exists("gold", "kpis")
    alerts = lake.read_json("logs", "alerts", M.ALERT).collect()
    assert any(a["severity"] == "CRITICAL" and "below the gate" in a["message"] and a["context"]["gate"] == "0.95" for a in alerts)
    # drift of contract vs delivered columns is reported
    assert any("schema drift" in a["message"] for a in alerts)


def test_health_and_recovery(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    assert J.health(spark, lake)["overall"] == "critical"       # no run yet
    src, events = _sources(spark)
    run_pipeline(spark, lake, src, events, as_of=td.AS_OF, gate_threshold=0.5)
    h = J.health(spark, lake)
    assert h["items"]["gold"] == "ok" and h["items"]["last_run"] == "ok"
    lake.delete("gold", "kpis")
    assert J.health(spark, lake)["overall"] == "critical"
    assert J.rebuild_gold(spark, lake) is True
    assert J.health(spark, lake)["items"]["gold"] == "ok"
    empty = Lake(spark, str(tmp_path / "empty"))
    assert J.rebuild_gold(spark, empty) is False
    # monitor: detect, rebuild, check again; the failed check is in the alert log
    lake.delete("gold", "kpis")
    m = J.monitor(spark, lake)
    assert m["before"]["items"]["gold"] == "critical" and m["recovered"] is True
    assert m["after"]["items"]["gold"] == "ok"
    msgs = [a["message"] for a in J.alerts(spark, lake).collect()]
    assert any(x.startswith("health check:") for x in msgs)
    assert any("built again" in x for x in msgs)


def test_volume_drift_alert(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    src, events = _sources(spark)
    run_pipeline(spark, lake, src, None, as_of=td.AS_OF, gate_threshold=0.0)
    half = {k: v.where(F.col(v.columns[0]) % 4 == 0) for k, v in src.items()}  # a quarter of the rows
    run_pipeline(spark, lake, half, None, as_of=td.AS_OF, gate_threshold=0.0)
    alerts = lake.read_json("logs", "alerts", M.ALERT).collect()
    assert any(a["context"]["stage"] == "ingest_batch" and "moved by" in a["message"] for a in alerts if "stage" in a["context"])
    drift = M.volume_drift(lake.read_json("logs", "runs", M.RUN_SCHEMA)).where("stage = 'ingest_batch'").orderBy("ts", "run_id").collect()
    assert drift[-1]["warn"] is True


def test_reprocess_returns_rows_once(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    src, events = _sources(spark)
    r1 = run_pipeline(spark, lake, src, events, as_of=td.AS_OF, gate_threshold=0.0)
    q1 = r1["silver"]["datasets"]["loans"]["quarantined"]
    rp = J.reprocess(spark, lake, "loans", as_of=td.LATER_AS_OF, contracts=td.CONTRACTS)
    # equal quarantined rows are one candidate
    assert rp["returned"] > 0 and rp["returned"] + rp["still_invalid"] <= q1
    # nothing pending any more; a second pass over the re-quarantine returns nothing new
    rp2 = J.reprocess(spark, lake, "loans", as_of=td.LATER_AS_OF, contracts=td.CONTRACTS)
    assert rp2["returned"] == 0 and rp2["still_invalid"] == rp["still_invalid"]
    # each pass handles only batches not yet in the ledger
    assert J.reprocess(spark, lake, "loans", as_of=td.LATER_AS_OF, contracts=td.CONTRACTS)["batches"] == [rp2["run_id"]]
    # the next Silver build (with the later as_of) reads returned rows instead of originals
    r2 = run_pipeline(spark, lake, None, None, as_of=td.LATER_AS_OF, gate_threshold=0.0)
    d = r2["silver"]["datasets"]["loans"]
    assert d["rows_in"] == r1["silver"]["datasets"]["loans"]["rows_in"]
    assert d["rows_out"] == r1["silver"]["datasets"]["loans"]["rows_out"] + rp["returned"]


def test_missing_table_error(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    with pytest.raises(TableMissing):
        lake.read("silver", "loans")


def test_csv_lake_and_raw_csv(spark, tmp_path):
    from lakehold.contracts import CONTRACTS
    lake = Lake(spark, str(tmp_path / "lake"), fmt="csv")
    books = td.books(spark, SF_SMALL)
    books = books.drop("_ordinal")
    books.coalesce(1).write.option("header", True).csv(lake.path("raw", "books.csv"))
    raw = lake.read_raw_csv("books", CONTRACTS["books"].spark_schema()).cache()
    assert raw.count() == books.count() and raw.where("_corrupt_record is not null").count() == 0
    lake.write(books, "silver", "books")
    assert lake.read("silver", "books").count() == books.count()


def test_history_last_n_and_malformed_lines(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    src, events = _sources(spark)
    books = {"books": src["books"]}
    for _ in range(3):
        run_pipeline(spark, lake, books, None, as_of=td.AS_OF, gate_threshold=0.0)
    # a broken line in the log is skipped
    os.makedirs(lake.path("logs", "runs"), exist_ok=True)
    with open(os.path.join(lake.path("logs", "runs"), "part-broken.json"), "w") as f:
        f.write("{not json\n")
    h = J.history(spark, lake, 2).collect()
    assert len(h) == 2 and h[0]["ts"] >= h[1]["ts"]
    assert J.history(spark, lake, 50).count() == 3


def test_dictionary_filter(spark):
    from lakehold.operators.profile import catalog_columns
    d = catalog_columns(spark, dataset="readers").collect()
    assert {r["column"] for r in d} == {"reader_id", "name", "email", "city", "signup_date"}
    assert {r["column"] for r in d if r["pii"]} == {"name", "email"}


def test_csv_lake_full_run(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), fmt="csv")
    src, events = _sources(spark)
    res = run_pipeline(spark, lake, {"books": src["books"], "loans": src["loans"]}, None,
                         as_of=td.AS_OF, gate_threshold=0.0)
    assert res["status"] == M.SUCCESS
    assert lake.read("gold", "top_books").count() == 20
    prof = J.read_profile(lake)
    assert prof.where("layer = 'silver' AND dataset = 'books'").count() == 5


def test_command_line(spark, tmp_path, capsys):
    from lakehold.__main__ import main
    root = str(tmp_path / "lake")
    lake = Lake(spark, root)
    src, events = _sources(spark)
    for ds in ("readers", "books", "loans", "ratings"):
        src[ds].drop("_ordinal").coalesce(1).write.option("header", True).csv(lake.path("raw", f"{ds}.csv"))
    # one instant for every dataset: readers registered after it fail not_future, hence gate 0
    assert main(["run", "--lake", root, "--gate", "0.0", "--as-of", "2001-01-01 00:00:00"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["status"] == M.SUCCESS
    assert main(["listing", "--lake", root]) == 0
    listing = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert {r["dataset"] for r in listing} >= {"loans", "readers"}
    assert main(["reprocess", "loans", "--lake", root, "--as-of", "2002-01-01 00:00:00"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["returned"] > 0
    assert main(["health", "--lake", root]) == 0


def test_raw_csv_malformed_line_is_kept(spark, tmp_path):
    from lakehold.contracts import CONTRACTS
    lake = Lake(spark, str(tmp_path / "lake"))
    os.makedirs(lake.path("raw", "books.csv"))
    with open(os.path.join(lake.path("raw", "books.csv"), "part-0.csv"), "w") as f:
        f.write("book_id,title,author,genre,year\n1,T,A,SMALL,2000\n2,U,B,LARGE\nx,V,C,MEDIUM,1999\n")
    raw = lake.read_raw_csv("books", CONTRACTS["books"].spark_schema()).cache()
    rows = {r["title"]: r for r in raw.collect()}
    assert rows["T"]["_corrupt_record"] is None and rows["T"]["book_id"] == 1
    assert rows["U"]["_corrupt_record"] is not None         # a field short
    assert rows["V"]["book_id"] is None                      # unparsable id -> null, fails not_null
