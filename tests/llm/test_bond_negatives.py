import collections
import math

import numpy as np
import pytest

from lakehold.llm import bond_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, dim string, block int, mark int"


def brute(rows, every=50, positives=5, negatives=3):
    """By comparing every anchor with every row."""
    fine = {(i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * x) for x in v)) for i, v, label in rows
            if i is not None and v and label is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for a, label, q in fine:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v, strict=True)), i, other) for i, other, v in fine if i != a and len(v) == len(q))
        for p, pid, _ in [s for s in scored if s[2] == label][:positives]:
            found = [s for s in scored if s[2] != label and 50 * -p <= 100 * -s[0] <= 95 * -p][:negatives]
            out += [(a, pid, rank, i, -p, -s) for rank, (s, i, _) in enumerate(found, 1)]
    return sorted(out)


def got(df):
    return sorted((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in df.collect())


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)


@pytest.mark.parametrize("spread", [0.2, 3.0])
def test_equals_brute_force_over_several_blocks(spark, spread):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(10, 16))
    label = np.where(rng.random(900) < 0.35, 3, rng.integers(0, 10, 900))  # a label with a third of all rows
    vectors = centres[rng.integers(0, 10, 900)] + spread * rng.normal(size=(900, 16))
    vectors[200:320] = vectors[200]  # copies: many ties
    rows = [(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(vectors, label, strict=True))]
    assert got(bond_negatives.mine(table(spark, rows), block_rows=128)) == brute(rows)


def test_defined_cases(spark):
    a = [1.0, 2.0]
    rows = [(0, a, 9), (50, a, 1), (1, a, 1), (1, a, 1), (2, [0.8, 1.0], 2), (3, [0.6, 1.6], 3), (4, None, 1), (5, [1.0, None], 1),
            (6, [float("nan"), 1.0], 1), (8, [float("inf"), 1.0], 1), (9, a, None), (None, a, 1), (10, [], 1), (11, [1.0, 2.0, 3.0], 1),
            (100, [0.0, 0.0], 4), (12, [5.0, 1.0], 4), (13, [0.0, -1.0], 5), (150, [-1.0, -1.0], 4), (14, [1e6, -1e6], 6),
            (200, [1e6, 1e6], 4), (50, [2.0, 0.5], 1), (7, [0.9, 1.9], 0)]
    want = brute(rows)
    assert got(bond_negatives.mine(table(spark, rows))) == want and want
    assert got(bond_negatives.mine(table(spark, [*rows, (15, [1e300, 1.0], 1)]))) == want  # beyond 64 bits: takes no part


def test_empty_table(spark):
    assert bond_negatives.mine(table(spark, [])).collect() == []


def test_scan_reads_a_part_of_the_values():
    rng = np.random.default_rng(1)
    columns = rng.integers(-20, 20, (64, 4000)).astype("<i4")
    columns[:, :10] += 300
    q = rng.integers(200, 300, 64)
    row = {"ids": np.arange(4000, dtype="<i8").tobytes(), "labels": np.zeros(4000, "<i4").tobytes(), "columns": [c.tobytes() for c in columns],
           "least": columns.min(1).tobytes(), "most": columns.max(1).tobytes()}
    block = bond_negatives.Block(row)
    ids, score = block.best(q, -1, 0, 5)
    exact = q @ columns.astype(np.int64)
    assert score.tolist() == np.sort(exact)[::-1][:5].tolist() and exact[ids].tolist() == score.tolist()
    assert block.read < 0.8 * columns.size  # the bitmap shrank before all dimensions were read


def test_wide_values_use_integers():
    q = np.array([2 ** 27, -2 ** 27 + 1])
    columns = np.array([[2 ** 27 - 1, 5, -2 ** 26], [3, 2 ** 27, 2 ** 26 + 1]], "<i4")
    block = bond_negatives.Block({"ids": np.arange(3, dtype="<i8").tobytes(), "labels": np.zeros(3, "<i4").tobytes(),
                                  "columns": [c.tobytes() for c in columns], "least": columns.min(1).tobytes(), "most": columns.max(1).tobytes()})
    ids, score = block.best(q, -1, 0, 3)
    want = {i: sum(int(x) * int(y) for x, y in zip(q, columns[:, i], strict=True)) for i in range(3)}
    assert dict(zip(ids.tolist(), score.tolist(), strict=True)) == want


def test_query_on_the_table(spark):
    from lakehold.llm.queries import op13_bond_negatives

    sf = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]], r["label"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute(rows)
    assert got(op13_bond_negatives(spark, sf)) == want
    assert len(collections.Counter(r[0] for r in want)) == 10
