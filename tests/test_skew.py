"""A key holding a third of all rows: exact results, and no operator that would put the
whole key into one task (no Window over the key; partial aggregation before shuffles)."""
import re

from pyspark.sql import functions as F

from test_shuffle_path import no_broadcast
from lakehold.operators import quality as Q
from lakehold.sources.testdata import CONTRACTS
from lakehold.operators.keys import dedup_keep_first


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _hot_loans(spark, n=30000):
    # every third row reuses loan 7 and reader 1; others are unique
    return (spark.range(n)
            .select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") + 100).alias("loan_id"),
                    F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 50 + 1).alias("reader_id"),
                    F.lit(1).cast("long").alias("book_id"),
                    F.lit("2020-01-01").alias("loan_date"),
                    F.col("id").alias("l_suppkey"), F.lit(1.0).alias("l_extendedprice"),
                    F.lit(1.0).alias("l_quantity")))


def test_hot_key_unique_and_fk_exact(spark):
    loans = _hot_loans(spark)
    refs = {"readers": spark.range(1, 40).select(F.col("id").alias("reader_id")),
            "books": spark.range(1, 3).select(F.col("id").alias("book_id"))}
    fl = Q.flag(loans, CONTRACTS["loans"], refs, as_of="2030-01-01 00:00:00")
    counts = {r["rule"] + ":" + r["column"]: r["failed"] for r in Q.rule_report(fl).collect()}
    hot = 30000 // 3
    assert counts["unique:loan_id"] == hot - 1          # every copy but the first (l_suppkey 0)
    # readers 40..50 are orphans: ids with id % 50 + 1 >= 40 among non-hot rows
    expect = loans.where((F.col("reader_id") >= 40)).count()
    assert counts["fk:reader_id"] == expect
    first = fl.df.where((F.col("loan_id") == 7) & ~F.col(fl.flag_cols[1])).collect()
    assert len(first) == 1 and first[0]["l_suppkey"] == 0
    plan = _plan(fl.df)
    assert "Window" not in plan


def test_hot_key_dedup(spark):
    loans = _hot_loans(spark)
    out = dedup_keep_first(loans, "loan_id", ["loan_date", "l_suppkey"])
    assert out.count() == loans.select("loan_id").distinct().count()
    assert "Window" not in _plan(out)


def test_null_keys_are_dealt_over_partitions(spark):
    """A third of the rows without a key: nothing fails for it, and the joins with key sets that are
    too big to broadcast spread those rows instead of sending them to one partition."""
    loans = _hot_loans(spark).withColumn("loan_id", F.when(F.col("loan_id") != 7, F.least("loan_id", F.lit(20_000)))).withColumn(
        "reader_id", F.when(F.col("reader_id") != 1, F.col("reader_id")))
    refs = {"readers": spark.range(2, 40).select(F.col("id").alias("reader_id")),
            "books": spark.range(1, 3).select(F.col("id").alias("book_id"))}
    with no_broadcast(spark):
        fl = Q.flag(loans, CONTRACTS["loans"], refs, as_of="2030-01-01 00:00:00")
        counts = {r["rule"] + ":" + r["column"]: r["failed"] for r in Q.rule_report(fl).collect()}
        plan = _plan(fl.df)
        for key in ("loan_id", "reader_id"):  # the slot is a key of the shuffle
            assert re.search(rf"hashpartitioning\({key}#\d+L?, \S*CASE WHEN", plan.replace("cast(", "").replace("coalesce(", "")), plan
    filled = [x + 100 if x + 100 < 20_000 else 20_000 for x in range(30_000) if x % 3]
    assert counts["unique:loan_id"] == len(filled) - len(set(filled))
    assert counts["fk:reader_id"] == loans.where("reader_id >= 40").count() > 0
