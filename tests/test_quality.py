"""Rule engine: the reference's unit cases plus edge cases of each rule."""
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakehold.contracts import Contract, Rule
from lakehold.operators import quality as Q
from lakehold.sources.testdata import CONTRACTS

READERS_SCHEMA = "reader_id long, name string, email string, city string, signup_date string"


def _counts(fl):
    rep = Q.rule_report(fl).collect()
    return {f"{r['rule']}:{r['column']}": r["failed"] for r in rep}


def test_duplicate_id_and_bad_email(spark):
    df = spark.createDataFrame([
        (1, "A", "a@x.com", "BSB", "2024-01-01"),
        (1, "B", "b@x.com", "SP", "2024-01-02"),
        (3, "C", "email_invalido", "RJ", "2024-01-03")], READERS_SCHEMA)
    fl = Q.flag(df, CONTRACTS["readers"], as_of="2026-01-01 00:00:00")
    counts = _counts(fl)
    assert counts["unique:reader_id"] == 1
    assert counts["regex:email"] == 1
    assert Q.dataset_report(fl).collect()[0]["passed"] is False


def test_keep_first_by_order(spark):
    # the later row (by the contract order) is the duplicate, whatever the physical order
    df = spark.createDataFrame([
        (10, 1, 1, "2024-02-01", 5, 1.0, 1.0), (10, 1, 1, "2024-01-01", 5, 1.0, 1.0),
        (None, 1, 1, "2024-01-01", 5, 1.0, 1.0), (None, 1, 1, "2024-01-01", 6, 1.0, 1.0)],
        "loan_id long, reader_id long, book_id long, loan_date string, l_suppkey long, "
        "l_extendedprice double, l_quantity double")
    fl = Q.flag(df, CONTRACTS["loans"], as_of="2030-01-01 00:00:00")
    rows = fl.df.select("loan_id", "loan_date", fl.flag_cols[1]).collect()
    dup = {(r[0], r[1]): r[2] for r in rows}
    assert dup[(10, "2024-02-01")] is True and dup[(10, "2024-01-01")] is False
    assert dup[(None, "2024-01-01")] is False  # null keys never fail unique


def test_rating_out_of_range(spark):
    refs = {"readers": spark.createDataFrame([(1,)], "reader_id long"),
            "books": spark.createDataFrame([(1,)], "book_id long")}
    df = spark.createDataFrame([(1, 1, 1, 5, "2024-01-01"), (2, 1, 1, 7, "2024-01-01")],
                               "rating_id long, reader_id long, book_id long, rating long, rating_date string")
    assert _counts(Q.flag(df, CONTRACTS["ratings"], refs))["in_range:rating"] == 1


def test_orphan_fk(spark):
    refs = {"readers": spark.createDataFrame([(1,), (2,)], "reader_id long"),
            "books": spark.createDataFrame([(1,)], "book_id long")}
    df = spark.createDataFrame([(1, 1, 1, "2024-01-01"), (2, 999, 1, "2024-01-01"), (3, None, 1, "2024-01-01")],
                               "loan_id long, reader_id long, book_id long, loan_date string")
    counts = _counts(Q.flag(df, CONTRACTS["loans"], refs, as_of="2030-01-01 00:00:00"))
    assert counts["fk:reader_id"] == 1   # null key passes
    assert counts["fk:book_id"] == 0


def test_fk_without_reference_fails_nothing(spark):
    df = spark.createDataFrame([(1, 5, 7, "2024-01-01")],
                               "loan_id long, reader_id long, book_id long, loan_date string")
    counts = _counts(Q.flag(df, CONTRACTS["loans"], {}, as_of="2030-01-01 00:00:00"))
    assert counts["fk:reader_id"] == 0 and counts["fk:book_id"] == 0
    refs = {"readers": spark.createDataFrame([(1,)], "other long")}
    counts = _counts(Q.flag(df, CONTRACTS["loans"], refs, as_of="2030-01-01 00:00:00"))
    assert counts["fk:reader_id"] == 0


def test_pass_rate_exact(spark):
    df = spark.createDataFrame([(1, "A", "a@x.com", "BSB", "2024-01-01"),
                                (2, "B", "ruim", "SP", "2024-01-02")], READERS_SCHEMA)
    rep = Q.dataset_report(Q.flag(df, CONTRACTS["readers"], as_of="2026-01-01 00:00:00")).collect()[0]
    assert rep["pass_rate"] == 0.5


def test_empty_input_rate_is_one(spark):
    df = spark.createDataFrame([], READERS_SCHEMA)
    rep = Q.dataset_report(Q.flag(df, CONTRACTS["readers"])).collect()[0]
    assert rep["pass_rate"] == 1.0 and rep["passed"] is True
    gate = Q.quality_gate(spark.createDataFrame([], "pass_rate double")).collect()[0]
    assert gate["worst_rate"] == 1.0 and gate["gate_ok"] is True


def test_missing_column_fails_every_row(spark):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-01")], "reader_id long, signup_date string")
    fl = Q.flag(df, CONTRACTS["readers"], as_of="2026-01-01 00:00:00")
    assert fl.valid().count() == 0
    rep = {r["rule"] + ":" + r["column"]: r for r in Q.rule_report(fl).collect()}
    assert rep["regex:email"]["failed"] == 2 and rep["regex:email"]["passed"] == 0
    assert rep["regex:email"]["detail"] == "column missing"
    c = CONTRACTS["readers"]
    c2 = Contract(name="x", columns=c.columns,
                  rules=(Rule("fk", "name", ("readers", "reader_id")),))
    fl2 = Q.flag(df, c2, {"readers": df})
    assert fl2.invalid().count() == 2  # fk on a missing column is treated as missing too


def test_unknown_rule_rejected():
    import pytest
    with pytest.raises(ValueError):
        Rule("freshness", "x")


def test_in_range_lenient(spark):
    c = Contract(name="t", columns=(("v", "string"),),
                 rules=(Rule("in_range", "v", (1, 5)),))
    df = spark.createDataFrame([("3",), ("abc",), (None,), ("9",), ("NaN",), ("1",), ("5.0",)], "v string")
    bad = [r["v"] for r in Q.flag(df, c).invalid().collect()]
    assert bad == ["9"]


def test_in_range_nan_double(spark):
    c = Contract(name="t", columns=(("v", "double"),),
                 rules=(Rule("in_range", "v", (1, 5)), Rule("not_null", "v")))
    df = spark.createDataFrame([(float("nan"),), (2.0,), (0.5,)], "v double")
    fl = Q.flag(df, c)
    counts = _counts(fl)
    assert counts["in_range:v"] == 1     # NaN passes the range, 0.5 fails
    assert counts["not_null:v"] == 1     # NaN counts as missing


def test_regex_anchoring_and_unicode(spark):
    c = Contract(name="t", columns=(("email", "string"),),
                 rules=(Rule("regex", "email", r"^[^@\s]+@[^@\s]+\.[^@\s]+$"),))
    vals = ["a@b.co", "a b@c.de", "a b@c.de", "x@y.z\n", "x@y", None]
    df = spark.createDataFrame([(v,) for v in vals], "email string")
    bad = {r["email"] for r in Q.flag(df, c).invalid().collect()}
    # Python semantics: NBSP is whitespace, $ matches before a final newline, null passes
    assert bad == {"a b@c.de", "a b@c.de", "x@y"}


def test_not_future_strict_and_lenient(spark):
    df = spark.createDataFrame([(1, "2026-01-01"), (2, "2026-01-02"), (3, "garbage"), (4, None)],
                               "reader_id long, signup_date string")
    c = CONTRACTS["readers"]
    fl = Q.flag(df, c, as_of="2026-01-01 00:00:00")
    i = [r.kind for r in c.rules].index("not_future")
    bad = [r["reader_id"] for r in fl.df.where(F.col(fl.flag_cols[i])).collect()]
    assert bad == [2]


def test_in_set_null_passes(spark):
    df = spark.createDataFrame([("1", "view"), ("2", None), ("3", "error")], "event_id string, event_type string")
    fl = Q.flag(df, CONTRACTS["access_events"])
    assert [r["event_id"] for r in fl.invalid().collect()] == ["3"]


def test_valid_and_invalid_partition_input(spark):
    from lakehold.plans.derived import Chain
    from lakehold_suite import SF_SMALL
    ch = Chain(spark, SF_SMALL)
    for ds in ("loans", "ratings", "readers"):
        fl = ch.flagged(ds)
        n = fl.df.count()
        v, i = fl.valid().count(), fl.invalid().count()
        assert v + i == n


def test_register_custom_rule(spark):
    from lakehold.functions.rules import register_rule

    def positive(df, c, rule, as_of):
        return F.col(rule.column) <= 0

    register_rule("positive", positive)
    c = Contract(name="t", columns=(("v", "int"),),
                 rules=(Rule("positive", "v"),))
    df = spark.createDataFrame([(1,), (0,), (-3,)], "v long")
    assert Q.flag(df, c).invalid().count() == 2


def test_dates_do_not_depend_on_session_zone(spark):
    from lakehold.plans import registry
    from lakehold_suite import SF_SMALL
    keys = ("silver_dates", "rule_not_future", "loans_by_month", "run_health", "silver_readers")
    before = {k: sorted(map(tuple, registry.queries()[k](spark, SF_SMALL).collect()), key=repr) for k in keys}
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        after = {k: sorted(map(tuple, registry.queries()[k](spark, SF_SMALL).collect()), key=repr) for k in keys}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    for k in keys:
        assert before[k] == after[k], k


def test_partial_dates_are_not_dates(spark):
    from lakehold.operators.silver import normalise_dates
    df = spark.createDataFrame([(1, "2024"), (2, "2024-01"), (3, "2024-02-30"), (4, "2024-02-29"),
                                (5, "24-01-01")], "reader_id long, signup_date string")
    got = {r["reader_id"]: r["signup_date"] for r in normalise_dates(df, CONTRACTS["readers"]).collect()}
    assert got[1] is None and got[2] is None and got[3] is None and got[5] is None
    assert str(got[4]) == "2024-02-29 00:00:00"


def test_sized_shuffles_never_lower_and_come_back(spark):
    from lakehold.session import sized_shuffles
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with sized_shuffles(spark, 10):
        assert spark.conf.get(key) == before
    with sized_shuffles(spark, 100 * 10**12):
        assert int(spark.conf.get(key)) >= 100 * 10**12 // (128 * 1024 * 1024)
    assert spark.conf.get(key) == before


def test_rules_match_python_statement_on_random_tables(spark):
    """Random small tables (null keys, duplicates, out-of-set and out-of-range values): the
    Spark flags equal a plain-Python statement of each rule."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    c = Contract(name="t",
                 columns=(("k", "int"), ("v", "int"), ("s", "string"), ("seq", "int")),
                 rules=(Rule("not_null", "k"), Rule("unique", "k"), Rule("in_range", "v", (1, 5)),
                        Rule("in_set", "s", ("a", "b"))),
                 order_by=("seq",))
    row = st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.one_of(st.none(), st.integers(-2, 8)),
                    st.one_of(st.none(), st.sampled_from(["a", "b", "c"])))

    @settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(row, min_size=1, max_size=40))
    def check(rows):
        data = [(k, v, s, 1000 - i) for i, (k, v, s) in enumerate(rows)]   # order differs from input order
        df = spark.createDataFrame(data, "k long, v long, s string, seq long")
        fl = Q.flag(df, c)
        got = {r["seq"]: tuple(r[n] for n in fl.flag_cols) for r in fl.df.collect()}
        first = {}
        for k, v, s, seq in sorted(data, key=lambda t: t[3]):
            if k is not None and k not in first:
                first[k] = seq
        for k, v, s, seq in data:
            want = (k is None,
                    k is not None and first[k] != seq,
                    v is not None and (v < 1 or v > 5),
                    s is not None and s not in ("a", "b"))
            assert got[seq] == want, (k, v, s, seq)

    check()


def test_fk_matches_python_statement_on_random_tables(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    c = Contract(name="t", columns=(("id", "int"), ("r", "int")),
                 rules=(Rule("fk", "r", ("refs", "rid")),))
    keys = st.one_of(st.none(), st.integers(0, 9))

    @settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(keys, min_size=1, max_size=40), st.lists(keys, max_size=12))
    def check(facts, ref):
        df = spark.createDataFrame([(i, k) for i, k in enumerate(facts)], "id long, r long")
        refs = {"refs": spark.createDataFrame([(k,) for k in ref], "rid long")}
        fl = Q.flag(df, c, refs)
        got = {r["id"]: r[fl.flag_cols[0]] for r in fl.df.collect()}
        valid = {k for k in ref if k is not None}
        for i, k in enumerate(facts):
            assert got[i] == (k is not None and k not in valid)

    check()


def test_date_only_pattern_takes_iso_datetime(spark):
    from lakehold.operators.silver import normalise_dates
    df = spark.createDataFrame([(1, "1996-03-13T00:00:00.000"), (2, "1996-03-13 10:20:30"), (3, "1996-03")],
                               "reader_id long, signup_date string")
    got = {r["reader_id"]: r["signup_date"] for r in normalise_dates(df, CONTRACTS["readers"]).collect()}
    assert str(got[1]) == "1996-03-13 00:00:00" and str(got[2]) == "1996-03-13 10:20:30" and got[3] is None
