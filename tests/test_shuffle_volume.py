"""What the keyed rules move: key sets hold keys and places, they are made from narrow frames, and a
query evaluates the flags of a dataset once."""
from pyspark.sql import functions as F

from lakehold.operators import quality as Q
from lakehold.operators import quarantine as QR
from lakehold.operators.joins import Marks, key_set
from lakehold.operators.keys import duplicate_keys, repeated_keys, with_duplicate_flag
from lakehold.plans import replay as RP
from lakehold.plans.derived import Chain
from lakehold.plans.registry import queries
from lakehold.sources import testdata as td
from lakehold.sources.testdata import CONTRACTS
from lakehold_suite import SF_SMALL
from test_shuffle_path import no_broadcast


def _line_scans(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [l_orderkey")


def test_key_sets_hold_the_key_and_a_place(spark):
    rows = spark.createDataFrame([(1, "b", 10), (1, "a", 11), (1, "a", 12), (2, "a", 13), (None, "a", 14), (None, "a", 15)],
                                 "k long, at string, _ordinal long")
    dups = duplicate_keys(rows, "k", ["at", "_ordinal"])
    assert dups.schema["_dfirst"].dataType.names == ["_ordinal"]
    assert [(r["_dk"], r["_dfirst"]["_ordinal"]) for r in dups.collect()] == [(1, 11)]
    # rows without a position are told apart by all that orders them
    assert duplicate_keys(rows, "k", ["at"]).schema["_dfirst"].dataType.names == ["at"]


def test_key_sets_come_from_narrow_frames(spark):
    rows = spark.createDataFrame([(1, 5, 7, "2020-01-01", 0), (1, 6, 8, "2019-01-01", 1), (2, 5, 8, "2020-01-01", 2), (3, None, None, None, 3)],
                                 "loan_id long, reader_id long, book_id long, loan_date string, _ordinal long")
    wide = rows.crossJoin(spark.range(1).select(F.lit("x").alias("city")))
    refs = {"readers": spark.range(5, 6).select(F.col("id").alias("reader_id")), "books": spark.range(8, 9).select(F.col("id").alias("book_id"))}
    asked = []

    def only(columns):
        asked.append(set(columns))
        return rows.select(*[c for c in rows.columns if c in columns or c == "_ordinal"])

    c = CONTRACTS["loans"]
    narrow = Q.flag(wide.withColumns({k: F.lit(0) for k in ("l_suppkey", "l_extendedprice", "l_quantity")}), c, refs, "2030-01-01 00:00:00")
    plain = {r["_ordinal"]: r[Q.FAILED] for r in narrow.df.collect()}
    fl = Q.flag(wide, c, refs, "2030-01-01 00:00:00", only=only)
    assert {r["_ordinal"]: r[Q.FAILED] for r in fl.df.collect()} == plain == {
        0: ["unique:loan_id", "fk:book_id"], 1: ["fk:reader_id"], 2: [], 3: []}
    assert sorted(map(sorted, asked)) == sorted(map(sorted, ({"loan_id", "loan_date", "book_id", "_ordinal"}, {"reader_id"}, {"book_id"})))


def test_flags_are_evaluated_once(spark):
    assert _line_scans(queries()["fk_orphans"](spark, SF_SMALL)) == 2   # loans and ratings
    assert _line_scans(RP.replay_lineage(Chain(spark, SF_SMALL))) == 2


def test_lines_and_orders_merge_at_any_size(spark):
    plan = td.loans(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_recheck_reads_narrow_bronze(spark):
    ch, c, asked = Chain(spark, SF_SMALL), CONTRACTS["loans"], []
    q = QR.quarantine_rows(ch.flagged("loans"), "reason", "batch", "2026-01-01T00:00:00")

    def only(columns):
        asked.append(set(columns))
        return ch.raw("loans", columns)

    rows = lambda fl: sorted(map(str, fl.df.select("loan_id", "reader_id", "book_id", "_ordinal", Q.FAILED).collect()))
    narrow = rows(QR.recheck(q, ch.raw("loans"), c, ch.refs, td.LATER_AS_OF, only=only))
    assert narrow == rows(QR.recheck(q, ch.raw("loans"), c, ch.refs, td.LATER_AS_OF)) and narrow
    assert asked == [{"loan_id", "loan_date", "l_suppkey", "l_extendedprice", "book_id", "l_quantity", "_ordinal"}]


def _tables(spark, path) -> str:
    """Lines with repeated keys and lines, orders that are missing or come twice."""
    lines = [(o, n, 10 * o + n, o % 4, 1, float(n), f"199{o % 9}-01-0{1 + n % 5}") for o in range(1, 130) for n in (1, 2, 2, 3)]
    lines += [lines[5], lines[5], (None, 1, 11, 1, 1, 1.0, "1995-01-01"), (7, None, 11, 1, 1, 1.0, "1995-01-01"), (8, 1, None, None, None, None, "2003-01-01")]
    frames = {"lineitem": spark.createDataFrame(lines, "l_orderkey long, l_linenumber long, l_partkey long, l_suppkey long, l_quantity long, l_extendedprice double, d string")
              .withColumn("l_shipdate", F.col("d").cast("timestamp_ntz")).drop("d"),
              "orders": spark.createDataFrame([(o, o % 30) for o in [*range(1, 120), 3, 3, 50]] + [(None, 1)], "o_orderkey long, o_custkey long"),
              "part": spark.range(600).select(F.col("id").alias("p_partkey"), F.lit("n").alias("p_name"), F.lit("b").alias("p_brand"), F.lit("LARGE").alias("p_type")),
              "customer": spark.range(25).select(F.col("id").alias("c_custkey"), F.lit("n").alias("c_name"), F.lit(1).alias("c_nationkey")),
              "nation": spark.createDataFrame([(1, "x")], "n_nationkey int, n_name string")}
    for name, df in frames.items():
        df.coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_valid_rows_are_those_without_a_flag(spark, tmp_path):
    sf = _tables(spark, tmp_path)
    for name in td.LATE:
        ch = Chain(spark, sf)
        fl = ch.flagged(name)
        rows = lambda df: sorted(map(str, df.collect()))
        want = rows(fl.valid().select(*ch.raw(name).columns))
        assert rows(ch.valid(name)) == want and 0 < len(want) < ch.raw(name).count()
        got = ch.counts(name).first()
        assert (got["n"], got["n_invalid"]) == (fl.df.count(), fl.df.count() - len(want))
        assert rows(Q.report_of(name, ch.counts(name), F.col("n_invalid") == 0)) == rows(Q.dataset_report(fl))


def test_valid_rows_meet_their_keys_in_one_shuffle(spark):
    ch = Chain(spark, SF_SMALL)
    plan = ch.silver("loans")._jdf.queryExecution().optimizedPlan().toString()
    assert "_dfirst" not in plan and plan.count("Relation [l_orderkey") == 1
    # orders join the firsts of keys, not all lines
    assert plan.index("Relation [o_orderkey") > plan.index("Aggregate [") or plan.index("Join LeftOuter") < plan.index("Aggregate [")


def _sorted(df, *columns) -> list:
    return sorted(map(str, (df.select(*columns) if columns else df).collect()))


def test_marks_leave_no_key_out(spark):
    keys = key_set(spark.range(0, 60_000, 3).select(F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(-F.col("id")).alias("k")))
    marks = Marks.over(keys, "k")
    assert marks.on(keys, "k").where("not _may").count() == 0
    others = marks.on(spark.range(100_000, 200_000).select(F.col("id").alias("k"), F.lit(1).alias("v")), "k")
    assert others.columns == ["k", "v", "_may"] and others.where("_may").count() < 8_000
    none = spark.createDataFrame([(None,), (3,)], "k long")
    assert [r["_may"] for r in marks.on(none, "k").orderBy("k").collect()] == [False, False]   # 3 is odd: -3 is held
    assert Marks.over(key_set(none.where("false")), "k").on(keys, "k").where("_may").count() == 0
    texts = key_set(keys.select(F.col("k").cast("string").alias("k")))
    assert Marks.over(texts, "k").on(texts, "k").where("not _may").count() == 0


def test_repeated_keys_move_only_their_rows(spark):
    # every third row has key 7, or none, or a key of its own
    rows = spark.range(9_000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id") + 100).alias("k"),
                                     (-F.col("id")).alias("at"), F.col("id").alias("_ordinal"))
    stored, asked = key_set(rows), []

    def narrow(columns):
        asked.append(columns)
        return stored.select(*columns)

    dups, marks = repeated_keys(narrow, "k", ["at", "_ordinal"])
    assert asked == [{"k"}, {"k", "at", "_ordinal"}]
    assert [(r["_dk"], r["_dfirst"]["_ordinal"]) for r in dups.collect()] == [(7, 8_997)]
    with no_broadcast(spark):
        got = with_duplicate_flag(stored, "k", ["at", "_ordinal"], "twice", dups=dups, marks=marks)
        assert _sorted(got, "_ordinal", "twice") == _sorted(with_duplicate_flag(stored, "k", ["at", "_ordinal"], "twice"), "_ordinal", "twice")
        assert got.where("twice").count() == 2_999


def _stored(spark, path) -> Chain:
    ch = Chain(spark, path)
    ch.store_lines()
    return ch


def test_stored_lines_give_the_same_rows_and_flags(spark, tmp_path):
    sf = _tables(spark, tmp_path)
    plain, stored = Chain(spark, sf), _stored(spark, sf)
    for name in td.LATE:
        columns = plain.raw(name).columns
        assert stored.raw(name).dtypes == plain.raw(name).dtypes
        assert _sorted(stored.raw(name)) == _sorted(plain.raw(name))
        narrow = {columns[0], "reader_id", td.LINK}
        assert _sorted(stored.raw(name, narrow)) == _sorted(plain.raw(name, narrow))
        with no_broadcast(spark):
            assert _sorted(stored.flagged(name).df, *columns, Q.FAILED) == _sorted(plain.flagged(name).df, *columns, Q.FAILED)


def test_recheck_and_merge_with_repeated_keys(spark, tmp_path):
    sf = _tables(spark, tmp_path)
    for name in td.LATE:
        ch, c = _stored(spark, sf), CONTRACTS[name]
        q = key_set(QR.quarantine_rows(ch.flagged(name), "reason", "batch", "2026-01-01T00:00:00"))
        dups, marks = ch.flagged(name).repeated[c.key]
        with no_broadcast(spark):
            was = QR.recheck(q, ch.raw(name), c, ch.refs, td.LATER_AS_OF)
            now = QR.recheck(q, ch.raw(name), c, ch.refs, td.LATER_AS_OF, repeated=(dups, marks))
            columns = [*was.public_columns(), "_ordinal", Q.FAILED]
            assert _sorted(now.df, *columns) == _sorted(was.df, *columns) and now.df.count() > 0
            # what is returned need not lie in Bronze, and may lie there several times
            back = key_set(ch.raw(name).where("l_suppkey = 1").select(*now.public_columns()))
            other = back.limit(3).withColumn("l_suppkey", F.lit(77).cast("long")).unionByName(back.limit(2).withColumn(c.key, F.lit(10**9).cast("long")))
            back = key_set(back.unionByName(other).unionByName(other).unionByName(back.limit(1).withColumn(c.key, F.lit(None).cast("long"))))
            want = QR.merge_into_bronze(ch.raw(name), back)
            got = QR.merge_into_bronze(ch.raw(name), back, c.key, marks)
            assert got.columns == want.columns and _sorted(got) == _sorted(want)
            assert ch.raw(name).count() > want.count() > ch.raw(name).select(*back.columns).distinct().count()


def test_reprocess_merge_counts_different_rows(spark, tmp_path):
    sf = _tables(spark, tmp_path)
    spark.createDataFrame([(i, i, "view", '{"k": 1}', "2000-01-01") for i in (1, 2, 2)], "event_id long, user_id long, event_type string, props string, d string").select(
        "event_id", "user_id", "event_type", "props", F.col("d").cast("timestamp_ntz").alias("ts")).write.parquet(f"{sf}/events.parquet")
    merged = queries()["reprocess_merge"](spark, sf)
    # returned rows are rows of Bronze: merging them adds none
    ch, want = Chain(spark, sf), []
    for name, c in CONTRACTS.items():
        rows = ch.raw(name).drop("_ordinal").distinct().groupBy(F.col(c.row_key).cast("string").alias("row_key")).agg(F.count(F.lit(1)).alias("n_rows"))
        want += [(name, r["row_key"], r["n_rows"]) for r in rows.collect()]
    assert sorted(map(str, map(tuple, merged.collect()))) == sorted(map(str, want))
    # lines met their orders once, before; whole rows are compared for repeated and returned keys alone
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert "o_orderkey" not in plan and plan.count("_several") > 0
