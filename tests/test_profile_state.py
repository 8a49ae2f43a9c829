"""Profiles of runs add up to the profile of all their rows."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakehold.operators import profile as P
from lakehold.plans import jobs as J
from lakehold.sources.lake import Lake, TableMissing

ROW = "run string, n long, t string, d double, at timestamp, tags array<string>, b binary"


def rows_of(df):
    return {(r["dataset"], r["column"]): (r["rows"], r["null_pct"], r["n_distinct"]) for r in df.collect()}


def test_merged_states_equal_a_fresh_profile(spark):
    nan, at = float("nan"), dt.datetime(2024, 1, 1)
    data = [("a", 1, "", 0.0, at, ["x"], b""), ("a", 1, "x", -0.0, at, ["x"], b"x"), ("b", None, None, nan, None, None, None),
            ("b", 2, "", 1.5, at, [], b""), (None, 2, "y", None, dt.datetime(2025, 1, 1), ["x", "y"], b"x")] * 3
    df = spark.createDataFrame(data, ROW)
    states = P.profile_state(df, "bronze", "t", F.col("run"))
    assert {r["run_id"] for r in states.collect()} == {"a", "b", None}
    assert rows_of(P.merge_states(states)) == rows_of(P.profile(df, "bronze", "t"))


def test_large_columns_within_the_stated_error(spark):
    df = spark.range(200_000).select((F.col("id") % 7).alias("run"), F.col("id").alias("k"), (F.col("id") % 5000).cast("string").alias("v"),
                                     F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("h"))
    merged = rows_of(P.merge_states(P.profile_state(df, "bronze", "t", F.col("run"))))
    for key, (rows, null_pct, n) in rows_of(P.profile(df, "bronze", "t")).items():
        assert merged[key][:2] == (rows, null_pct)
        assert abs(merged[key][2] - n) <= max(1, n * 5 * 1.04 / 2 ** (P.LG_K / 2)), key


def test_whole_number_types_of_runs_may_differ(spark):
    a = P.profile_state(spark.range(50).select(F.col("id").cast("int").alias("k")), "bronze", "t", F.lit("1"))
    b = P.profile_state(spark.range(100).select(F.col("id").alias("k")), "bronze", "t", F.lit("2"))
    assert rows_of(P.merge_states(a.unionByName(b)))["t", "k"] == (150, 0.0, 100)


def test_empty_tables_have_no_state(spark):
    assert P.profile_state(spark.range(0), "bronze", "t", F.lit("1")).collect() == []


def books(spark, ids, **more):
    df = spark.range(max(ids) + 1).where(F.col("id").isin(list(ids))).select(
        F.col("id").alias("book_id"), F.lit("t").alias("title"), F.lit("a").alias("author"), F.lit("g").alias("genre"), F.lit(2000).cast("long").alias("year"))
    return df.select("*", *[F.lit(v).alias(k) for k, v in more.items()])


def test_a_new_run_profiles_its_own_partition_only(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    with pytest.raises(TableMissing):
        J.read_merged_profile(lake)
    for run_id, ids, more in (("r1", range(10), {}), ("r2", range(5, 20), {}), ("r3", range(30), {"shelf": "s"})):
        lake.write_bronze(books(spark, ids, **more), "books", "file", run_id, "2024-01-01T00:00:00")
        J.profile_runs(J.Run(spark, lake, run_id=run_id), ["books"])
        batch = spark.read.parquet(lake.path("catalog", f"profile_state/books/batch={run_id}"))
        assert {r["run_id"] for r in batch.collect()} == {run_id}

    def check():
        merged = rows_of(J.read_merged_profile(lake))
        fresh = rows_of(P.profile(lake.read_bronze("books", lake.bronze_runs("books")), "bronze", "books"))
        assert merged == fresh
        return merged

    assert check()["books", "shelf"] == (55, 0.4545, 1)
    # a run that is repeated replaces its own state
    lake.write_bronze(books(spark, [1, 2, 99]), "books", "file", "r2", "2024-01-01T00:00:00")
    J.profile_runs(J.Run(spark, lake, run_id="r2"), ["books"])
    assert check()["books", "book_id"] == (43, 0.0, 31)
    # runs without a state are made up for, in one pass
    for run_id in ("r4", "r5"):
        lake.write_bronze(books(spark, [200, 300]), "books", "file", run_id, "2024-01-01T00:00:00")
    J.profile_runs(J.Run(spark, lake, run_id="r5"), ["books"])
    J.profile_runs(J.Run(spark, lake, run_id="r5"), ["books"])
    assert check()["books", "book_id"] == (47, 0.0, 33)
    # r4, made up for by r5, runs again
    lake.write_bronze(books(spark, [200, 300, 400]), "books", "file", "r4", "2024-01-01T00:00:00")
    J.profile_runs(J.Run(spark, lake, run_id="r4"), ["books"])
    assert check()["books", "book_id"] == (48, 0.0, 34)


def test_governance_takes_states_where_estimates_do(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    for run_id, ids in (("r1", range(10)), ("r2", range(4))):
        lake.write_bronze(books(spark, ids), "books", "file", run_id, "2024-01-01T00:00:00")
    J.governance(J.Run(spark, lake, run_id="r2"), exact=False)
    assert rows_of(J.read_profile(lake).where("layer = 'bronze'"))["books", "book_id"] == (4, 0.0, 4)
    assert rows_of(J.read_merged_profile(lake))["books", "book_id"] == (14, 0.0, 10)
