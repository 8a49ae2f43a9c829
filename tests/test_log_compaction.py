"""Logs of appended records become versions of a table; readers see every record once."""
import os

from lakehold.sources.lake import COMPACTED, OF_RECORDS, Lake

SCHEMA = "run_id string, n long, parts array<struct<a: string>>"


def append(spark, lake, ids):
    for i in ids:
        lake.append_json("logs", "runs", spark.createDataFrame([(f"r{i}", i, [(str(i),)])], SCHEMA))


def records(lake, schema=SCHEMA):
    return sorted(r["n"] for r in lake.read_json("logs", "runs", schema).collect())


def folders(lake):
    return [f for f in os.listdir(lake.path("logs", "runs")) if OF_RECORDS.fullmatch(f)]


def test_records_once_and_few_folders(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    assert not lake.compact_log("logs", "runs", SCHEMA, least=1) and records(lake) == []
    for step in range(4):
        append(spark, lake, range(3 * step, 3 * step + 2))
        assert not lake.compact_log("logs", "runs", SCHEMA, least=3)
        append(spark, lake, [3 * step + 2])
        begun = lake.read_json("logs", "runs", SCHEMA)
        assert lake.compact_log("logs", "runs", SCHEMA, least=3)
        assert records(lake) == sorted(r["n"] for r in begun.collect()) == list(range(3 * step + 3))
        assert len(folders(lake)) <= 6
        assert len([v for v in os.listdir(lake.path("logs", f"runs{COMPACTED}")) if not v.startswith(".")]) <= 2
    append(spark, lake, [12])
    assert records(lake) == list(range(13))
    assert [r["parts"][0]["a"] for r in lake.read_json("logs", "runs", SCHEMA).where("n = 5").collect()] == ["5"]
    assert records(lake, SCHEMA + ", later string") == list(range(13))   # a column that came since


def test_lines_that_do_not_parse_and_other_files_stay(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    append(spark, lake, range(3))
    one = os.path.join(lake.path("logs", "runs"), folders(lake)[0])
    with open(os.path.join(one, "more.json"), "w") as f:
        f.write("{not json\n")
    with open(os.path.join(lake.path("logs", "runs"), "by_hand.json"), "w") as f:
        f.write('{"run_id": "hand", "n": 50}\n')
    assert lake.compact_log("logs", "runs", SCHEMA, least=3) and records(lake) == [0, 1, 2, 50]
    kept = spark.read.parquet(lake.location("logs", f"runs{COMPACTED}"))
    assert [r["_corrupt_record"] for r in kept.where("_corrupt_record is not null").collect()] == ["{not json"]


def test_a_pass_that_dies_loses_and_doubles_nothing(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path))
    append(spark, lake, range(3))

    def die(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(Lake, "write", die)
        try:
            lake.compact_log("logs", "runs", SCHEMA, least=3)
        except RuntimeError:
            pass
    assert records(lake) == [0, 1, 2]
    assert lake.compact_log("logs", "runs", SCHEMA, least=3) and records(lake) == [0, 1, 2]


def test_one_writer_at_a_time(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    append(spark, lake, range(2))
    lock = lake.path("logs", "runs") + COMPACTED + ".lock"
    open(lock, "w").close()
    assert not lake.compact_log("logs", "runs", SCHEMA, least=2) and records(lake) == [0, 1]
    os.utime(lock, (0, 0))
    assert lake.compact_log("logs", "runs", SCHEMA, least=2) and not os.path.exists(lock) and records(lake) == [0, 1]
