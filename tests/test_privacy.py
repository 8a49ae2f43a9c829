import hashlib

from pyspark.sql import functions as F

from lakehold.contracts import CONTRACTS
from lakehold.functions.privacy import apply_pii, mask_email, pseudonym


def test_mask_and_pseudonym(spark):
    df = spark.createDataFrame([(1, "Ana Silva", "ana.silva@exemplo.com"), (2, "Bruno Costa", "bruno@teste.com")],
                               "reader_id long, name string, email string")
    out = apply_pii(df, CONTRACTS["readers"], "salt")
    assert "name" not in out.columns and out.columns[-1] == "name_pseudo"
    mails = [r["email"] for r in out.orderBy("reader_id").collect()]
    assert all("*" in m for m in mails) and "ana.silva" not in mails[0]
    assert mails == ["an*******@exemplo.com", "br***@teste.com"]


def test_pseudonym_matches_sha256_and_is_deterministic(spark):
    df = spark.createDataFrame([("Ana Silva",), (None,), ("Émilie",)], "name string")
    got = [r[0] for r in df.select(pseudonym(F.col("name"), "s")).collect()]
    want = [hashlib.sha256(("s" + v).encode()).hexdigest()[:16] if v is not None else None
            for v in ["Ana Silva", None, "Émilie"]]
    assert got == want


def test_mask_edge_cases(spark):
    cases = {"a@b": "a*@b", "ab@x": "ab*@x", "@x": "*@x", "abc@x@y": "ab*@x@y", "plain": "plain",
             "": "", "abcdef@d.com": "ab****@d.com"}
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "e string")
    got = {r[0]: r[1] for r in df.select("e", mask_email(F.col("e"))).collect()}
    for k, v in cases.items():
        assert got[k] == v
    assert got[None] is None


def test_no_pii_unchanged(spark):
    df = spark.createDataFrame([(1, "X", "Poesia")], "book_id long, title string, genre string")
    out = apply_pii(df, CONTRACTS["books"])
    assert out.columns == df.columns


def _mask_spec(s):
    """The masking rule stated in plain Python."""
    if s is None or "@" not in s:
        return s
    local, domain = s.split("@", 1)
    return local[:2] + "*" * max(len(local) - 2, 1) + "@" + domain


def test_mask_matches_rule_on_random_strings(spark):
    from hypothesis import given, settings, HealthCheck
    from hypothesis import strategies as st

    alphabet = st.sampled_from(list("ab.@_-x9 ") + ["é", "ß", "中", "😀"])
    strings = st.one_of(st.none(), st.text(alphabet, max_size=12))

    @settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(strings, min_size=1, max_size=60))
    def check(values):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, e string")
        got = {r[0]: r[1] for r in df.select("i", mask_email(F.col("e"))).collect()}
        for i, v in enumerate(values):
            assert got[i] == _mask_spec(v), (v, got[i])

    check()


def test_pseudonym_matches_hashlib_on_random_strings(spark):
    from hypothesis import given, settings, HealthCheck
    from hypothesis import strategies as st

    @settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.one_of(st.none(), st.text(max_size=20)), min_size=1, max_size=40))
    def check(values):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v string")
        got = {r[0]: r[1] for r in df.select("i", pseudonym(F.col("v"), "k")).collect()}
        for i, v in enumerate(values):
            want = None if v is None else hashlib.sha256(("k" + v).encode("utf-8")).hexdigest()[:16]
            assert got[i] == want

    check()
