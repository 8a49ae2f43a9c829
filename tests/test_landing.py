"""Landing from several sources, renewed checkpoints, identity of streamed rows, replaced tables."""
import json
import os
import shutil

import pytest
from lakehold_suite import run_pipeline
from pyspark.sql import functions as F

from lakehold.plans import jobs as J
from lakehold.sources import testdata as td
from lakehold.sources.lake import Lake
from lakehold.streaming import events as S


def queue(tmp_path, name, ids, folder="queue", kind="clique", reader=1):
    q = tmp_path / folder
    q.mkdir(exist_ok=True)
    (q / name).write_text("".join(json.dumps({"event_id": i, "reader_id": reader, "event_type": kind, "book_id": 1,
                                              "event_ts": "2024-01-01T00:00:00"}) + "\n" for i in ids))
    return str(q)


def landed(lake):
    rows = lake.read_bronze("access_events", lake.bronze_runs("access_events"))
    return sorted(r["event_id"] for r in rows.select("event_id").collect())


def test_sources_do_not_remove_each_others_events(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    assert S.drain_events(spark, lake, queue(tmp_path, "a.jsonl", [f"a{i}" for i in range(10)]))["rows"] == 10
    other = S.event_source(spark, queue(tmp_path, "b.jsonl", [f"b{i}" for i in range(5)], "other"))
    assert S.drain_events(spark, lake, other.drop("_file", "_block", "_modified"))["rows"] == 5   # as from a broker
    third = queue(tmp_path, "c.jsonl", ["c"], "third")
    assert S.drain_events(spark, lake, third, source_name="third")["rows"] == 1
    assert landed(lake) == sorted([f"a{i}" for i in range(10)] + [f"b{i}" for i in range(5)] + ["c"])
    log = S.landings(lake).collect()
    assert sorted(r["metrics"]["rows"] for r in log) == [1, 5, 10] and len({r["stream"] for r in log}) == 3


@pytest.mark.parametrize("archived", [True, False])
def test_a_renewed_checkpoint_loses_and_doubles_nothing(spark, tmp_path, archived):
    lake = Lake(spark, str(tmp_path / "lake"))
    q = queue(tmp_path, "a.jsonl", [f"a{i}" for i in range(10)])
    assert S.drain_events(spark, lake, q)["rows"] == 10
    shutil.rmtree(lake.path("logs", "checkpoints/events_bronze"))
    if archived:
        shutil.move(os.path.join(q, "a.jsonl"), str(tmp_path / "gone.jsonl"))
    queue(tmp_path, "b.jsonl", ["b1", "b2"])
    assert S.drain_events(spark, lake, q)["rows"] == 2
    assert landed(lake) == sorted([f"a{i}" for i in range(10)] + ["b1", "b2"])


def test_streamed_rows_have_positions_of_their_own(spark, tmp_path):
    """A row of one micro-batch that is returned replaces itself, not the rows with its number in other batches."""
    lake = Lake(spark, str(tmp_path / "lake"))
    for i in range(3):
        q = queue(tmp_path, f"f{i}.jsonl", [f"{i}{j}" for j in range(4)], kind="x" if i == 1 else "clique")
    (tmp_path / "queue" / "f1.jsonl").write_text("".join(json.dumps(
        {"event_id": f"1{j}", "reader_id": 1, "event_type": "busca" if j == 1 else "clique", "book_id": 1, "event_ts": "2024-01-01T00:00:00"}) + "\n" for j in range(4)))
    from dataclasses import replace

    from lakehold.contracts import CONTRACTS
    loose = CONTRACTS["access_events"]
    strict = replace(loose, rules=tuple(replace(r, param=("clique",)) if r.kind == "in_set" else r for r in loose.rules))
    source = S.event_source(spark, q, max_files_per_trigger=1)
    run = J.Run(spark, lake, contracts={**CONTRACTS, "access_events": strict})
    assert S.drain_events(spark, lake, source, run_id=run.run_id, contract=strict)["batches"] == 3
    first = J.silver_job(run, ["access_events"])["datasets"]["access_events"]
    assert (first["rows_in"], first["quarantined"], first["rows_out"]) == (12, 1, 11)
    assert J.reprocess(spark, lake, "access_events", contracts=CONTRACTS)["returned"] == 1
    again = J.silver_job(J.Run(spark, lake), ["access_events"])["datasets"]["access_events"]
    assert (again["rows_in"], again["quarantined"], again["rows_out"]) == (12, 0, 12)
    assert J.reprocess(spark, lake, "access_events", contracts=CONTRACTS)["returned"] == 0


def test_metrics_are_observed_in_the_pass_that_writes(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    for i in range(8):
        q = queue(tmp_path, f"f{i}.jsonl", [f"{i}", None], kind="busca" if i % 2 else "other")
    res = S.drain_events(spark, lake, S.event_source(spark, q, max_files_per_trigger=1))
    assert res["batches"] == 8 and res["metrics"]["rows"] == 16
    assert res["metrics"]["not_null:event_id"] == 8 and res["metrics"]["in_set:event_type"] == 8
    assert sum(r["metrics"]["rows"] for r in S.landings(lake).collect()) == 16


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_failed_write_leaves_the_table(spark, tmp_path, fmt):
    lake = Lake(spark, str(tmp_path / "lake"), fmt=fmt)
    broken = spark.range(50).select(F.when(F.col("id") < 40, F.col("id")).otherwise(F.raise_error(F.lit("stop")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        lake.write(broken, "gold", "t")
    assert not lake.exists("gold", "t") and not lake.has_rows_of("gold", "t")
    lake.write(spark.range(3), "gold", "t")
    with pytest.raises(Exception, match="stop"):
        lake.write(broken, "gold", "t")
    assert lake.read("gold", "t").count() == 3
    begun = lake.read("gold", "t")
    lake.write(spark.range(7), "gold", "t")
    assert begun.count() == 3 and lake.read("gold", "t").count() == 7   # a reader that began before ends with the old rows
    for n in (4, 5):
        lake.write(spark.range(n), "gold", "t")
    assert lake.read("gold", "t").count() == 5 and len(os.listdir(lake.path("gold", "t"))) <= 3


def test_tables_without_versions_are_replaced(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    spark.range(4).write.parquet(lake.path("silver", "old"))
    assert lake.exists("silver", "old") and lake.read("silver", "old").count() == 4
    lake.write(spark.range(2), "silver", "old")
    assert lake.read("silver", "old").count() == 2


def test_a_gold_job_that_dies_leaves_gold(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path / "lake"))
    src = td.load_all(spark, "/root/testdata/sf0.001")
    events = src.pop("access_events")
    run_pipeline(spark, lake, src, events, as_of=td.AS_OF, gate_threshold=0.0)
    before = {n: sorted(map(tuple, lake.read("gold", n).collect())) for n in ("kpis", "top_books")}
    tables = J.G.gold_tables

    def dying(silver):
        return {n: df.withColumn(df.columns[0], F.raise_error(F.lit("killed")).cast(df.dtypes[0][1])) for n, df in tables(silver).items()}

    monkeypatch.setattr(J.G, "gold_tables", dying)
    with pytest.raises(Exception, match="killed"):
        J.gold_job(J.Run(spark, lake))
    assert {n: sorted(map(tuple, lake.read("gold", n).collect())) for n in before} == before
    assert J.health(spark, lake)["items"]["gold"] == "ok"
