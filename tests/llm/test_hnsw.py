import collections
import math

import numpy as np

from lakehold.llm import hnsw

SCHEMA = "vec_id long, embedding array<float>, label int, dim string, shard int"


def brute(rows, every, count):
    """{query: [(id, distance)]} by comparing everything."""
    fine = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and len(v) and any(v)
            and all(x is not None and math.isfinite(x) for x in v)}
    out = collections.defaultdict(dict)
    for q, x in fine:
        if q % every == 0:
            for i, y in fine:
                if i != q and len(x) == len(y):
                    d = float(np.sqrt(((np.array(x, np.float32).astype(float) - np.array(y, np.float32).astype(float)) ** 2).sum()))
                    out[q][i] = min(d, out[q].get(i, d))
    return {q: sorted(((d, i) for i, d in found.items()))[:count] for q, found in out.items()}


def got(df):
    out = collections.defaultdict(list)
    for r in df.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out[r["query_id"]]) + 1
        out[r["query_id"]].append((r["score"], r["vec_id"]))
    return out


def test_recall_over_several_shards(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(10, 24))[rng.integers(0, 10, 1500)] + 0.6 * rng.normal(size=(1500, 24))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    df = hnsw.usable(spark.createDataFrame([(*r, 0, "", 0) for r in rows], SCHEMA))
    index = hnsw.build_index(df, shard_rows=400).cache()
    assert index.count() == 4
    found = got(hnsw.search(index, df, df.where("vec_id % 25 = 0"), 10, shard_rows=400))
    want = brute(rows, 25, 10)
    assert found.keys() == want.keys()
    assert sum(len({i for _, i in found[q]} & {i for _, i in want[q]}) for q in want) >= 0.95 * 10 * len(want)
    exact = {(q, i): d for q in want for d, i in want[q]}
    assert all(abs(d - exact[q, i]) < 1e-12 for q in found for d, i in found[q] if (q, i) in exact)


def test_near_copies_far_from_the_origin():
    """Distances within the group are far below what norms and products resolve in single precision."""
    rng = np.random.default_rng(4)
    vectors = (rng.normal(size=(1200, 24)) * 10).astype(np.float32)
    vectors[:400] = 100 + 1e-3 * rng.normal(size=(400, 24))
    g = hnsw.Graph(vectors).build(seed=1)
    right = 0
    for q in range(0, 400, 10):
        exact = ((vectors.astype(float) - vectors[q].astype(float)) ** 2).sum(1)
        right += len(set(g.nearest(vectors[q], 10)[0][:10].tolist()) & set(np.argsort(exact, kind="stable")[:10].tolist()))
    assert right >= 0.95 * 400


def test_copies_and_defined_cases(spark):
    rows = [(i, [1.0, 2.0]) for i in range(0, 40)] + [(100, [5.0, 5.0]), (101, [5.0, 4.0]), (50, [0.0, 0.0]), (51, None),
            (52, [1.0, None]), (53, [float("nan"), 1.0]), (54, [float("inf"), 1.0]), (200, [1.0, 2.0, 3.0]), (201, [1.0, 2.0, 4.0]),
            (None, [1.0, 2.0]), (300, []), (100, [5.0, 5.0]), (400, [-0.0, 2.0]), (401, [0.0, 2.0])]
    df = spark.createDataFrame([(*r, 0, "", 0) for r in rows], SCHEMA)
    found = got(hnsw.nearest_neighbours(df, every=10, count=10))
    assert found == brute(rows, 10, 10)
    assert found[200] == [(1.0, 201)]


def test_empty_table(spark):
    assert hnsw.nearest_neighbours(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_recall_on_the_table(spark):
    from lakehold.llm.queries import op2_hnsw

    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    found, want = got(op2_hnsw(spark, sf)), brute(rows, 100, 10)
    assert found.keys() == want.keys()
    assert sum(len({i for _, i in found[q]} & {i for _, i in want[q]}) for q in want) >= 0.9 * sum(map(len, want.values()))
