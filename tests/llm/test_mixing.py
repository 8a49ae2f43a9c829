import collections

import llm_plain as plain
import pytest

from lakehold.llm import mixing as M
from lakehold.llm.queries import op7_entropy_balancing


def size(text):
    return len(plain.WORD.findall(text or ""))


def check(rows, got, near):
    """rows: (doc_id, text, source); got: result rows."""
    assert sorted(r["doc_id"] for r in got) == sorted(r[0] for r in rows)
    text, source = {r[0]: r[1] for r in rows}, {r[0]: r[2] for r in rows}
    of, taken = collections.Counter(), collections.Counter()
    for r in got:
        assert r["size"] == size(text[r["doc_id"]]) and r["taken"] in (0, r["size"], 2 * r["size"])
        of[source[r["doc_id"]]] += r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
    aims = plain.targets(of)
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == of[s] and abs(r["target"] - aims[s]) < 1e-6 * max(1, aims[s])
    for s in of:
        assert abs(taken[s] - aims[s]) <= near * aims[s] + 3, s
    return taken


def test_query_meets_its_targets_and_reruns_agree(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = op7_entropy_balancing(spark, sf).collect()
    check(rows, got, 0.01)
    again = op7_entropy_balancing(spark, sf).repartition(3).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_rates_are_exponential_tilts(spark):
    rows = [(i, i % 2 and "a" or "b", 1 + i * 7 % 50) for i in range(400)] + [(1000 + i, "c", 1) for i in range(20)]
    sizes = spark.createDataFrame(rows, "doc_id long, source string, size long")
    got = M.copies(sizes).collect()
    import math
    for s in "ab":
        mine = [r for r in got if r["source"] == s]
        owed = sum(r["rate"] * r["size"] for r in mine)
        assert abs(owed - mine[0]["target"]) < 1e-4 * mine[0]["target"]
        tilts = {round(math.log(r["rate"]) / r["size"], 5) for r in mine if r["rate"] < 2}
        assert len(tilts) <= 1


@pytest.mark.parametrize("rows", [
    [], [(1, None, None)], [(1, "", "a"), (2, None, "b")], [(1, "a b c", None), (2, "d e", "é"), (3, "f", "z"), (4, "g h", "Z")],
    [(i, "one two three " * (1 + i % 7), "hot" if i % 3 else f"s{i % 9}") for i in range(300)]])
def test_small_tables(spark, rows):
    got = M.mix(plain.docs(spark, [(d, t, None, s) for d, t, s in rows])).collect()
    check(rows, got, 0.02 if len(rows) > 100 else 1.0)


def test_nulls_ties_and_repeats(spark):
    df = plain.docs(spark)
    assert len(M.mix(df).collect()) == len(plain.TEXTS)
    twice = plain.docs(spark, [(1, "a b c", None, "s")] * 4 + [(None, "a b", None, "s")])
    assert sorted((r["doc_id"] or 0, r["size"]) for r in M.mix(twice).collect()) == [(0, 2)] + [(1, 3)] * 4


def test_mixed_rows_are_the_copies(spark):
    df = plain.docs(spark, [(i, "w " * (1 + i % 11), "l", f"s{i % 4}") for i in range(200)] + [(500, "a b", None, None)] * 3)
    out = M.mixed(df)
    assert out.columns == df.columns
    want = collections.Counter()
    for r in M.mix(df).collect():
        want[r["doc_id"]] += r["taken"] // r["size"]
    assert collections.Counter(r["doc_id"] for r in out.collect()) == +want
