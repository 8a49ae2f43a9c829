import random

import llm_plain as plain
import numpy as np
import pytest

from lakehold.llm import _graph as G
from lakehold.llm import ngram_rtree as N


def texts(seed, n, words=60, edits=8, bases=12, vocabulary=400):
    """Near copies of a few bases, with up to a number of words changed, and lone texts."""
    rng = random.Random(seed)
    base = [[f"w{rng.randrange(vocabulary)}" for _ in range(rng.randint(3, words))] for _ in range(bases)]
    out = []
    for i in range(n):
        t = list(rng.choice(base)) if rng.random() < 0.8 else [f"w{rng.randrange(vocabulary)}" for _ in range(rng.randint(1, words))]
        for _ in range(rng.randrange(edits)):
            t[rng.randrange(len(t))] = f"w{rng.randrange(vocabulary)}"
        out.append((i * 3 + 1, " ".join(t)))
    return out


def got(spark, rows, k, num, den):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, shard long, component string")
    return {r[0]: (r[1], r[2]) for r in N.link_components(df, k, num, den).collect()}


@pytest.mark.parametrize(("k", "num", "den", "seed"), [(3, 9, 10, 1), (5, 4, 5, 2), (2, 1, 2, 3)])
def test_against_all_pairs(spark, k, num, den, seed):
    rows = texts(seed, 400) + texts(seed + 9, 60, words=900, edits=40, vocabulary=20_000)
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    assert got(spark, rows, k, num, den) == plain.jaccard_components(rows, k, num, den)


def test_a_large_group_is_cut_into_units(spark, monkeypatch):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        t = list(base)
        for _ in range(rng.randrange(4)):
            t[rng.randrange(len(t))] = f"v{rng.randrange(9999)}"
        rows.append((i, " ".join(t)))
    monkeypatch.setattr(N, "BLOCK", 16)
    assert got(spark, rows, 3, 9, 10) == plain.jaccard_components(rows, 3, 9, 10)


def test_near_copies_meet_once(spark):
    """Two texts that share nearly all their shards are one unit of two classes, not one for each shard."""
    words = [f"w{i}" for i in range(300)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:150], "x", *words[151:]])), (3, " ".join(f"v{i}" for i in range(300)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    keys = N.shard_keys(df, 3, 9, 10)
    assert keys.groupBy("shard").count().where("count > 1").count() > 20
    met = N.shared_members(keys).collect()
    assert len(met) == 2 and len({r["shard"] for r in met}) == 1 and len({r["class"] for r in met}) == 2


@pytest.mark.parametrize("most", [None, 3, 50])
def test_classes_are_numbered_across_batches(spark, most):
    """Keys end anywhere in a record batch, with repeated rows on either side of its end."""
    rng = random.Random(5)
    rows = [(k, c) for k in range(60) for c in rng.choices(range(100, 130), k=rng.choice([1, 1, 2, 3, 9, 40])) for _ in range(rng.randint(1, 3))]
    want = set()
    for k in range(60):
        classes = sorted({c for x, c in rows if x == k})
        for i, c in enumerate(classes if len(classes) > 1 else []):
            want.add((classes[0], c, None) if len(classes) <= (most or 0) else (k, c, i))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for batch in (1, 3, 7):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
        try:
            got_ = [tuple(r) for r in N.numbered(spark.createDataFrame(rows, "shard long, class long"), "shard", most).collect()]
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
        assert set(got_) == want
        assert len([r for r in got_ if r[2] is not None]) == len({r for r in want if r[2] is not None})


def test_components_of_more_edges_go_through_these_only(spark, monkeypatch):
    rng = random.Random(6)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(90)]
    frame = lambda e: spark.createDataFrame([*e, (None, 3), (5, 5)], "u long, v long")
    known = G.components(frame(edges))
    more = [(rng.randrange(260), rng.randrange(260)) for _ in range(40)]
    held = []
    monkeypatch.setattr(G, "materialise", lambda df, name, f=G.materialise: held.append(f(df, name)) or held[-1])
    found = {tuple(r) for r in G.joined(known, frame(more)).collect()}
    nodes = {n for u, v in edges + more if u != v for n in (u, v)}
    assert found == set(plain.components(nodes, edges + more).items())
    assert max(h.count() for h in held[:-1]) <= len(more)
    # a graph of stars needs no step: its edges are written once
    held.clear()
    assert {tuple(r) for r in G.components(frame([(7, 1), (8, 1), (9, 2)])).collect()} == {(1, 1), (7, 1), (8, 1), (2, 2), (9, 2)}
    assert len(held) == 1


def test_defined_cases(spark):
    rows = [(i, t) for i, t in enumerate(plain.TEXTS)] + [(50, "A B"), (51, "a  b"), (52, "É a b c"), (53, "é a b c")]
    assert got(spark, rows, 3, 9, 10) == plain.jaccard_components(rows, 3, 9, 10)
    assert N.link_components(plain.empty(spark)).collect() == []
    odd = N.link_components(plain.docs(spark, [(None, "a b c d", None, None), (4, "a b c d", None, None), (4, "a b c d", None, None),
                                               (2, "a b c d", None, None), (9, None, None, None)])).collect()
    assert sorted((r[0] or 0, r[1], r[2] or 0) for r in odd) == [(0, 2, 0), (2, 2, 2), (4, 2, 2), (4, 2, 2), (9, 0, 9)]


def test_first_of_each_keeps_columns_and_one_row(spark):
    df = plain.docs(spark, [(5, "a b c d e f", "en", "s"), (3, "a b c d e f", "en", None), (3, "a b c d e f", "en", "s"), (8, None, None, None),
                            (9, "", "x", None), (None, "a b c d e f", None, None), (7, "other words entirely", None, None)])
    out = N.first_of_each(df)
    assert out.columns == df.columns
    assert sorted(((r["doc_id"] or 0, r["source"]) for r in out.collect()), key=str) == [(0, None), (3, None), (7, None), (8, None), (9, None)]


@pytest.mark.parametrize(("num", "den"), [(9, 10), (4, 5), (1, 2)])
def test_shards_lose_no_linked_pair(num, den):
    """Sets at the very threshold share a shard, whatever their sizes."""
    rng = np.random.default_rng(num)
    for n in [*range(1, 60), 100, 333, 1000, 5000]:
        for _ in range(8):
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            both = rng.integers(-(-num * len(a) // den), len(a) + 1)  # shared shingles
            most = max(0, (den * both - num * len(a)) // num)  # of the other set alone
            b = np.unique(np.concatenate((rng.permutation(a)[:both], rng.integers(0, 2**63, rng.integers(0, most + 1)).astype(np.uint64))))
            shared = len(np.intersect1d(a, b))
            if den * shared >= num * (len(a) + len(b) - shared) and len(np.setxor1d(a, b)):
                bands = N.Bands(num, den)
                assert len(np.intersect1d(bands.signatures(a), bands.signatures(b)))


@pytest.mark.parametrize("n", [2, 5, 33, 300])
def test_tree_finds_what_comparing_all_points_finds(n):
    rng = np.random.default_rng(n)
    base = rng.poisson(2, (max(1, n // 10), N.DIMENSIONS))
    points = (base[rng.integers(0, len(base), n)] + (rng.random((n, N.DIMENSIONS)) < 0.05)).astype(np.int32)
    sizes = points.sum(1).astype(np.int64)
    a, b = N.RTree(points, sizes, 9, 10).pairs()
    found = {tuple(sorted(p)) for p in zip(a.tolist(), b.tolist(), strict=True)}
    want = {(i, j) for i in range(n) for j in range(i + 1, n)
            if np.minimum(points[i], points[j]).sum() * 19 >= 9 * (sizes[i] + sizes[j]) and 10 * min(sizes[i], sizes[j]) >= 9 * max(sizes[i], sizes[j])}
    assert found == want and len(found) == len(a)


def test_inner_nodes_prune():
    """A tree of many leaves and units: most pairs of nodes and points are never looked at."""
    rng = np.random.default_rng(8)
    base = rng.poisson(6, (60, N.DIMENSIONS))
    points = (base[rng.integers(0, 60, 3000)] + (rng.random((3000, N.DIMENSIONS)) < 0.03)).astype(np.int32)
    points[:1500] *= rng.integers(1, 6, (1500, 1))  # sizes that differ
    sizes, unit = points.sum(1).astype(np.int64), rng.integers(0, 5, 3000)
    tree = N.RTree(points, sizes, 9, 10, unit)
    a, b = tree.pairs()
    found = {tuple(sorted(p)) for p in zip(a.tolist(), b.tolist(), strict=True)}
    want = set()
    for i in range(3000):
        j = np.arange(i + 1, 3000)
        j = j[unit[j] == unit[i]]
        fine = np.minimum(points[i], points[j]).sum(1) * 19 >= 9 * (sizes[i] + sizes[j])
        fine &= 10 * np.minimum(sizes[i], sizes[j]) >= 9 * np.maximum(sizes[i], sizes[j])
        want |= {(i, int(x)) for x in j[fine]}
    assert found == want
    leaves = len(tree.levels[1][0])
    assert leaves > 90 and tree.kept[1] < 0.25 * leaves ** 2 / 2  # pairs of leaves that survive
    assert tree.seen[0] < 0.1 * 3000 ** 2 / 2  # pairs of points compared


def test_forest_spans_and_takes_the_best():
    rng = np.random.default_rng(3)
    for n in (2, 7, 40):
        a, b = np.triu_indices(n, 1)
        some = rng.random(len(a)) < 0.3
        a, b, weight = a[some], b[some], rng.integers(0, 5, some.sum()) / 4
        pick = N.forest(n, a, b, weight)
        edges = list(zip(a.tolist(), b.tolist(), strict=True))
        assert plain.components(range(n), edges) == plain.components(range(n), [edges[i] for i in pick])
        assert len(pick) == n - len(set(plain.components(range(n), edges).values()))
        total, root = 0.0, []
        for i in np.argsort(-weight, kind="stable"):  # greedily
            if plain.components(range(n), root) != plain.components(range(n), [*root, edges[i]]):
                root.append(edges[i])
                total += weight[i]
        assert abs(total - weight[pick].sum()) < 1e-9


def test_query(spark):
    from lakehold.llm.queries import op10_ngram_rtree

    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert {r[0]: (r[1], r[2]) for r in op10_ngram_rtree(spark, sf).collect()} == plain.jaccard_components(rows, 3, 9, 10)


def test_marks_bound_the_difference_from_below():
    rng = np.random.default_rng(7)
    sets = []
    for n in (1, 40, 300, 3000, 30_000):
        base = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        sets += [np.unique(base), np.unique(np.concatenate((base[n // 10:], rng.integers(0, 1 << 63, n // 5, dtype=np.uint64)))),
                 np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))]
    marks = [N.parity(s) for s in sets]
    assert {len(m) for m in marks} == {64, 128, 1024, 4096}
    a, b = (np.array(x) for x in zip(*[(i, j) for i in range(len(sets)) for j in range(i)]))
    least = N.differing(a, b, marks)
    real = np.array([len(np.setxor1d(sets[i], sets[j])) for i, j in zip(a, b)])
    assert (least <= real).all() and (least > 0).sum() > len(a) / 2


def test_marks_drop_pairs_of_long_sets_that_counts_let_pass():
    rng = np.random.default_rng(8)
    part = rng.integers(0, 1 << 63, 1500, dtype=np.uint64)  # shared by all: similarity about 0.5
    sets = [np.unique(np.concatenate((part, rng.integers(0, 1 << 63, 750, dtype=np.uint64)))) for _ in range(20)]
    near = np.unique(np.concatenate((sets[0][60:], sets[1][:10])))
    sets.append(near)
    n, sizes = len(sets), np.array([len(s) for s in sets])
    given = (np.zeros(n, np.int64), np.arange(n), sizes, np.stack([N.point(s) for s in sets]).astype(np.int32), np.zeros(n, np.int64), np.arange(n), 4, 5, True)
    assert len(N.unit_pairs(*given)[0]) > 100
    a, b, _ = N.unit_pairs(*given, [N.parity(s) for s in sets])
    assert list(zip(a.tolist(), b.tolist())) == [(0, 20)]


def test_the_first_pass_takes_few_large_shards_of_a_class(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 4)
    rows = [(s, c, c) for s in range(30) for c in range(10)] + [(s, 100 + c, c) for s in range(40, 45) for c in range(3)]
    members = spark.createDataFrame(rows, "shard long, class long, place long")
    kept = [tuple(r) for r in N.thinned(members).select("shard", "class", "place").collect()]
    assert sorted(kept) == sorted(r for r in rows if r[0] in (0, 1) or r[0] >= 40)
    assert N.first_units(N.thinned(members)).count() == 2 * (10 + 6) + 15


def test_torn_large_shards_become_one_of_their_smallest_class(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 4)
    rows = [(s, c, 1 if c < 9 else 2) for s in range(1000, 1030) for c in range(10)]          # torn, large
    rows += [(2000, c, 7) for c in range(50, 60)] + [(2001, 70, 1), (2001, 71, 2)]            # one component; torn, small
    members = spark.createDataFrame(rows, "shard long, class long, label long")
    kept = sorted(tuple(r) for r in N.gathered(members).collect())
    assert kept == [(0, c, 1 if c < 9 else 2) for c in range(10)] + [(2001, 70, 1), (2001, 71, 2)]
