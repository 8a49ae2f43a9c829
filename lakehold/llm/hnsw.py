"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Vectors are dealt to shards by a hash of their id, so every shard has about ``shard_rows`` vectors
whatever the data look like. Each shard is one task that builds one graph (Malkov and Yashunin,
2016) and stores it as one row of flat arrays: the vectors, one neighbour array per level (int32,
padded with -1) and the member ids of each distinct vector. Blocks of queries are sent to every
shard's partition, where its graph is loaded once and the blocks stream past it; each shard answers
with its nearest, by exact distances in double precision, and the answers are merged per query.

Equal vectors of a shard are one node with its member ids in ascending order, so copies neither
crowd the graph nor get lost: ties go to the smaller id.

Defined cases. Vectors that are null, zero or hold null or non-finite components take no part.
Only vectors of equal length are neighbours. Repeated rows count once; of a vec_id with several
vectors the nearest counts. With fewer candidates than asked for, all are returned. Empty tables give no rows.
"""
from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakehold.llm._base import mapped
from lakehold.sources.scratch import materialise

SHARD_ROWS, LINKS, BUILD_WIDTH, SEARCH_WIDTH, QUERY_BLOCK = 4096, 16, 80, 96, 512

INDEX = ("dim int, shard int, n int, members binary, member_start binary, vectors binary, levels binary, "
         "neighbours array<binary>, entry int")


class Graph:
    """The graph of one shard. ``vectors`` are distinct."""

    def __init__(self, vectors: np.ndarray, links: int = LINKS):
        self.vectors, self.links = vectors, links
        self.centre = vectors.mean(0, dtype=np.float64) if len(vectors) else 0.0
        self._near = self._centred(vectors)
        self.levels = np.zeros(len(vectors), np.int8)
        self.neighbours: list[np.ndarray] = []  # by level: [n, links or twice that], padded with -1
        self.entry = 0

    def _centred(self, vectors: np.ndarray) -> np.ndarray:
        return (vectors - self.centre).astype(np.float32)

    def _distances(self, q: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Squared distances, from differences: norms and products cancel where vectors lie close."""
        apart = self._near[nodes] - q
        return np.einsum("ij,ij->i", apart, apart)

    def _search(self, q: np.ndarray, entries: list[tuple[float, int]], width: int, level: int) -> list[tuple[float, int]]:
        """The ``width`` nearest that a best-first walk on one level finds, nearest first."""
        links, seen = self.neighbours[level], {node for _, node in entries}
        todo, found = list(entries), [(-d, node) for d, node in entries]
        heapq.heapify(todo)
        heapq.heapify(found)
        while todo:
            d, node = heapq.heappop(todo)
            if d > -found[0][0] and len(found) >= width:
                break
            new = [x for x in links[node].tolist() if x >= 0 and x not in seen]
            if not new:
                continue
            seen.update(new)
            for dx, x in zip(self._distances(q, np.array(new)).tolist(), new, strict=True):
                if len(found) < width or dx < -found[0][0]:
                    heapq.heappush(todo, (dx, x))
                    heapq.heappush(found, (-dx, x))
                    if len(found) > width:
                        heapq.heappop(found)
        return sorted((-d, node) for d, node in found)

    def _choose(self, found: list[tuple[float, int]], most: int) -> list[int]:
        """Of the candidates, nearest first, those nearer to the new node than to any already chosen."""
        nodes = np.array([x for _, x in found])
        if len(nodes) <= most // 2:
            return nodes.tolist()
        least = np.full(len(nodes), np.inf, np.float32)
        mine = np.array([d for d, _ in found], np.float32)
        chosen, passed = [], []
        for i in range(len(nodes)):
            if mine[i] < least[i]:
                chosen.append(i)
                if len(chosen) == most:
                    break
                np.minimum(least, self._distances(self._near[nodes[i]], nodes), out=least)
            else:
                passed.append(i)
        return nodes[(chosen + passed)[:most]].tolist()

    def build(self, seed: int, width: int = BUILD_WIDTH) -> Graph:
        n = len(self.vectors)
        draws = np.random.default_rng(seed).random(n)
        self.levels = np.minimum((-np.log(1 - draws) / math.log(self.links)).astype(int), 30).astype(np.int8)
        tops = int(self.levels.max(initial=0))
        self.neighbours = [np.full((n, self.links * (2 if k == 0 else 1)), -1, np.int32) for k in range(tops + 1)]
        counts = [np.zeros(n, np.int32) for _ in range(tops + 1)]
        top = -1
        for node in range(n):
            q, level = self._near[node], int(self.levels[node])
            if top >= 0:
                entries = [(float(self._distances(q, np.array([self.entry]))[0]), self.entry)]
                for k in range(top, level, -1):
                    entries = self._search(q, entries, 1, k)
                for k in range(min(top, level), -1, -1):
                    entries = self._search(q, entries, width, k)
                    most, links = self.links, self.neighbours[k]
                    for x in self._choose(entries, most):
                        links[node, counts[k][node]] = x
                        counts[k][node] += 1
                        if counts[k][x] < links.shape[1]:
                            links[x, counts[k][x]] = node
                            counts[k][x] += 1
                        else:
                            around = np.append(links[x], node)
                            d = self._distances(self._near[x], around)
                            order = np.argsort(d, kind="stable")
                            kept = self._choose(list(zip(d[order].tolist(), around[order].tolist(), strict=True)), links.shape[1])
                            links[x, :] = -1
                            links[x, :len(kept)] = kept
                            counts[k][x] = len(kept)
            if level > top:
                top, self.entry = level, node
        return self

    def nearest(self, q: np.ndarray, count: int, width: int = SEARCH_WIDTH) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, exact distances in double precision) of about ``width`` nearest nodes, nearest first."""
        near = self._centred(q)
        entries = [(float(self._distances(near, np.array([self.entry]))[0]), self.entry)]
        for k in range(len(self.neighbours) - 1, 0, -1):
            entries = self._search(near, entries, 1, k)
        nodes = np.array([x for _, x in self._search(near, entries, max(width, count), 0)])
        exact = np.sqrt(((self.vectors[nodes].astype(np.float64) - q.astype(np.float64)) ** 2).sum(1))
        order = np.argsort(exact, kind="stable")
        return nodes[order], exact[order]


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) that take part, with ``dim``; repeated rows once."""
    e = F.col("embedding")
    fine = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select("vec_id", "embedding").where(
        F.col("vec_id").isNotNull() & e.isNotNull() & fine & F.exists(e, lambda x: x != 0)).withColumn(
        "dim", F.size("embedding"))


def _shards(vectors: DataFrame, shard_rows: int) -> DataFrame:
    return vectors.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("shards"))


def _tasks(vectors: DataFrame, shard_rows: int) -> int:
    """Partitions for work by shard: four for each, so that hashing rarely puts several in one."""
    return 4 * (_shards(vectors, shard_rows).agg(F.sum("shards")).first()[0] or 1)


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def build_index(vectors: DataFrame, shard_rows: int = SHARD_ROWS, links: int = LINKS,
                width: int = BUILD_WIDTH) -> DataFrame:
    """One row per shard (see INDEX); written to the shared folder by the caller."""
    from pyspark.sql.types import DoubleType

    kind = np.float64 if vectors.schema["embedding"].dataType.elementType == DoubleType() else np.float32
    dealt = vectors.join(_shards(vectors, shard_rows), "dim").withColumn(
        "shard", F.pmod(F.xxhash64("vec_id"), F.col("shards")).cast("int"))

    def build(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        dim, shard = (x.as_py() for x in key)
        ids, matrix = rows.column("vec_id").to_numpy(), _matrix(rows.column("embedding"), dim).astype(kind)
        matrix = matrix + kind(0)  # no negative zeros: equal vectors have equal bytes
        raw = np.ascontiguousarray(matrix).view(np.dtype((np.void, matrix.dtype.itemsize * dim))).ravel()
        _, first, of = np.unique(raw, return_index=True, return_inverse=True)
        distinct = matrix[first]
        pairs = np.unique(np.stack((of, ids), 1), axis=0)  # members of a node in ascending order, repeated rows once
        start = np.concatenate(([0], np.cumsum(np.bincount(pairs[:, 0], minlength=len(first))))).astype("<i8")
        g = Graph(distinct, links).build(seed=shard * 65_537 + dim, width=width)
        row = {"dim": dim, "shard": shard, "n": len(distinct), "members": pairs[:, 1].astype("<i8").tobytes(),
               "member_start": start.tobytes(), "vectors": distinct.tobytes(), "levels": g.levels.tobytes(),
               "neighbours": [x.astype("<i4").tobytes() for x in g.neighbours], "entry": g.entry}
        return pa.Table.from_pylist([row], schema=out)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out = to_arrow_schema(StructType.fromDDL(INDEX))
    # a graph is minutes of work: its task must not be merged with others for being few bytes
    return dealt.select("dim", "shard", "vec_id", "embedding").repartition(
        _tasks(vectors, shard_rows), "dim", "shard").groupBy("dim", "shard").applyInArrow(build, INDEX)


def load(row: dict, kind: type, links: int = LINKS) -> tuple[Graph, np.ndarray, np.ndarray]:
    """(graph, member ids, start of each node's members) of an index row."""
    g = Graph(np.frombuffer(row["vectors"], kind).reshape(row["n"], row["dim"]), links)
    g.levels, g.entry = np.frombuffer(row["levels"], np.int8), row["entry"]
    g.neighbours = [np.frombuffer(x, "<i4").reshape(row["n"], -1) for x in row["neighbours"]]
    return g, np.frombuffer(row["members"], "<i8"), np.frombuffer(row["member_start"], "<i8")


def search(index: DataFrame, vectors: DataFrame, queries: DataFrame, count: int = 10, width: int = SEARCH_WIDTH,
           shard_rows: int = SHARD_ROWS, links: int = LINKS) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``count`` nearest found, its own id left out."""
    from pyspark.sql.types import DoubleType

    kind = np.float64 if vectors.schema["embedding"].dataType.elementType == DoubleType() else np.float32
    blocks = _shards(queries, QUERY_BLOCK).withColumnRenamed("shards", "blocks")
    dealt = queries.join(blocks, "dim").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))

    def gather(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        dim, block = (x.as_py() for x in key)
        return pa.table({"dim": pa.array([dim], pa.int32()), "block": pa.array([block], pa.int32()),
                         "ids": [rows.column("vec_id").to_numpy().astype("<i8").tobytes()],
                         "asked": [_matrix(rows.column("embedding"), dim).astype(kind).tobytes()]})

    packed = dealt.select("dim", "block", "vec_id", "embedding").groupBy("dim", "block").applyInArrow(
        gather, "dim int, block int, ids binary, asked binary")
    # each block of queries meets each shard of its dimension; a shard's graph comes first in its
    # partition and is loaded once, the blocks stream past it
    graph = ("n", "members", "member_start", "vectors", "levels", "neighbours", "entry")
    asking = packed.join(_shards(vectors, shard_rows), "dim").withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).drop("shards")
    meet = index.select("dim", "shard", *graph, F.lit(None).cast("binary").alias("ids"), F.lit(None).cast("binary").alias("asked")).unionByName(
        asking, allowMissingColumns=True)
    meet = meet.repartition(_tasks(vectors, shard_rows), "dim", "shard").sortWithinPartitions("dim", "shard", F.col("n").desc_nulls_last())

    def answer(batches) -> Iterator[dict]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["n"] is not None:
                    g, members, start = load(row, kind, links)
                    continue
                q, found = [], []
                asked = np.frombuffer(row["asked"], kind).reshape(-1, row["dim"])
                for own, vector in zip(np.frombuffer(row["ids"], "<i8").tolist(), asked, strict=True):
                    nodes, scores = g.nearest(vector, count + 1, width)
                    best: dict[int, float] = {}
                    for node, score in zip(nodes.tolist(), scores.tolist(), strict=True):
                        if len(best) >= count and score > last:
                            break
                        last = score
                        for x in members[start[node]:min(start[node] + count + 1, start[node + 1])].tolist():
                            if x != own:
                                best.setdefault(x, score)
                    found += best.items()
                    q += [own] * len(best)
                yield {"query_id": q, "vec_id": [x for x, _ in found], "score": [s for _, s in found]}

    answers = mapped(meet.select("dim", *graph, "ids", "asked"), answer, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    nearest = answers.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))  # of ids with several vectors
    return nearest.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count).select(
        "query_id", "rank", "vec_id", "score")


def nearest_neighbours(vectors: DataFrame, every: int = 100, count: int = 10) -> DataFrame:
    """Search all vectors for the rows whose vec_id is divisible by ``every``."""
    taking_part = usable(vectors)
    index = materialise(build_index(taking_part), "hnsw")
    return search(index, taking_part, taking_part.where(F.col("vec_id") % every == 0), count)
