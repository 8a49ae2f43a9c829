"""Event queue drains: exactly-once, malformed lines kept for quarantine, stream = batch."""
import json
import os

from pyspark.sql import functions as F

from lakehold_suite import SF_SMALL, run_pipeline
from lakehold.operators import monitor as M
from lakehold.plans import jobs as J
from lakehold.plans.derived import Chain
from lakehold.sources import testdata as td
from lakehold.sources.lake import Lake
from lakehold.streaming import events as S


def _write(path, rows, extra=""):
    with open(path, "w") as f:
        for r in rows:
            f.write(json.dumps({"event_id": str(r.event_id), "reader_id": r.user_id,
                                "event_type": r.event_type, "book_id": json.loads(r.props)["k"],
                                "event_ts": r.ts.isoformat(timespec="seconds")}) + "\n\n")
        f.write(extra)


def test_two_drains_no_loss_no_duplicate(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    contract = td.CONTRACTS["access_events"]
    q, arch = str(tmp_path / "queue"), str(tmp_path / "archive")
    os.makedirs(q)
    rows = spark.read.parquet(f"{SF_SMALL}/events.parquet").orderBy("event_id").collect()
    _write(os.path.join(q, "access_0001.jsonl"), rows[:600], "{broken\n")
    r1 = S.drain_events(spark, lake, q, arch, contract=contract)
    _write(os.path.join(q, "access_0002.jsonl"), rows[600:])
    r2 = S.drain_events(spark, lake, q, arch, contract=contract)
    r3 = S.drain_events(spark, lake, q, arch, contract=contract)
    assert (r1["rows"], r2["rows"], r3["rows"]) == (601, len(rows) - 600, 0)
    assert r1["metrics"]["malformed"] == 1
    bronze = lake.read_bronze("access_events", [r1["run_id"], r2["run_id"]])
    assert bronze.count() == len(rows) + 1
    assert bronze.where(F.col("event_id").isNotNull()).select("event_id").distinct().count() == len(rows)
    # consumed files left the queue for the archive
    assert sorted(os.listdir(q)) in ([], ["access_0002.jsonl"])
    assert os.path.isdir(arch)


def test_pipeline_with_event_queue(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    q = str(tmp_path / "queue")
    os.makedirs(q)
    rows = spark.read.parquet(f"{SF_SMALL}/events.parquet").orderBy("event_id").collect()
    _write(os.path.join(q, "access_0001.jsonl"), rows, "{broken\n")
    src = td.load_all(spark, SF_SMALL)
    src.pop("access_events")
    res = run_pipeline(spark, lake, src, None, as_of=td.AS_OF, gate_threshold=0.5, event_dir=q)
    ev = res["silver"]["datasets"]["access_events"]
    assert ev["rows_in"] == len(rows) + 1
    # malformed line quarantined by not_null(event_id); valid events equal the batch Silver
    batch = Chain(spark, SF_SMALL).silver("access_events")
    assert ev["rows_out"] == batch.count()
    got = {r["event_type"]: r["total"] for r in lake.read("gold", "events_by_type").collect()}
    want = {r["event_type"]: r["total"] for r in Chain(spark, SF_SMALL).gold("events_by_type").collect()}
    assert got == want
    # an empty drain warns and leaves Bronze as it was
    res2 = run_pipeline(spark, lake, None, None, as_of=td.AS_OF, gate_threshold=0.5, event_dir=q)
    assert res2["record"]["stages"]["ingest_stream"]["rows_in"] == 0
    assert any(a["message"] == "the event queue was empty" for a in res2["record"]["alerts"])


def test_live_counts_equal_batch_counts(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    q = str(tmp_path / "queue")
    os.makedirs(q)
    rows = spark.read.parquet(f"{SF_SMALL}/events.parquet").orderBy("event_id").collect()
    _write(os.path.join(q, "a_0001.jsonl"), rows[:500])
    first = {r["event_type"]: r["total"] for r in S.live_counts_by_type(spark, lake, q).collect()}
    _write(os.path.join(q, "a_0002.jsonl"), rows[500:])
    live = {r["event_type"]: r["total"] for r in S.live_counts_by_type(spark, lake, q).collect()}
    raw = spark.read.parquet(f"{SF_SMALL}/events.parquet").groupBy("event_type").count().collect()
    assert live == {r["event_type"]: r["count"] for r in raw}
    assert sum(first.values()) == 500


def test_kafka_source_reports_missing_connector(spark):
    import pytest
    with pytest.raises(RuntimeError):
        S.kafka_event_source(spark, "localhost:1", "events").isStreaming
