"""Hard-negative mining by a vertical scan (BOND: branch and bound on decomposed data).

Vectors become integers, ``floor(scale * x)`` per component, and are stored *by dimension*: a block of
about ``BLOCK_ROWS`` rows is one row that holds an array per dimension and each dimension's least and
most value. An anchor reads a block's dimensions in descending order of its own magnitudes, a few
at a time. What the unread dimensions can still add lies between two sums, taken from the least and
most values; so every row's score lies in an interval, and a bitmap keeps the rows whose interval may still matter:

* pass 1 (positives): the ``positives`` best rows of the anchor's label. A row goes when it cannot
  reach the ``positives``-th best of the lower ends.
* pass 2 (negatives): each positive score sets a window ``low * p <= 100 * s <= high * p``. A row goes when it
  cannot lie in any window, or lies below as many rows as are asked for that surely lie in the window.

When all dimensions are read the intervals are single values and the windows are resolved exactly:
nothing is approximate. Blocks are ranges of (label, id): a block of one label has tight ends, a label with a third
of all rows is many blocks, and many small labels share one. Packs of anchors are streamed past each block,
which is loaded once; each block answers with a few rows per anchor, and those are merged by rank.

Defined cases. Rows with a null id, label or vector, without components, or with a null or non-finite
component take no part; nor do rows with a component of ``2^31 / sqrt(dimensions)`` or more after scaling,
whose scores might leave 64 bits. Only vectors of equal length meet. Repeated rows count once; an anchor's other rows
are those of other ids, and an id with two vectors or labels is two rows, or two anchors. Ties go to the smaller id. Positive scores of zero or less have a window of zero
(0: ``low * 0 <= s <= high * 0``) or none. Empty tables give no rows; other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakehold.llm._base import mapped
from lakehold.sources.scratch import materialise

BLOCK_ROWS, PACK_ROWS, STEP = 4096, 256, 4

BLOCKS = ("dim int, block int, holds array<int>, ids binary, labels binary, columns array<binary>, least binary, most binary")
PACKS = "dim int, holds array<int>, ids binary, marks binary, labels binary, vectors binary, positives array<array<long>>"


def usable(vectors: DataFrame, scale: int = 256, shift_every: int = 7, labels: int = 10) -> DataFrame:
    """(vec_id, label, parts, dim, mark): the rows that take part, as integers, repeated rows once.

    Where vec_id is divisible by ``shift_every`` the label becomes ``(label + 1) % labels``. ``mark`` tells
    rows of one id apart.
    """
    limit = F.lit(float(2 ** 31)) / F.sqrt(F.size("embedding")) - 1
    scaled = lambda x: F.lit(float(scale)) * x.cast("double")
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(scaled(x)) < limit))
    label = F.when(F.col("vec_id") % shift_every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return vectors.select("vec_id", "label", "embedding").where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
        & (F.size("embedding") > 0) & fine).select(
        F.col("vec_id").cast("long").alias("vec_id"), label.cast("int").alias("label"),
        F.transform("embedding", lambda x: F.floor(scaled(x)).cast("int")).alias("parts"),
        F.size("embedding").alias("dim")).distinct().withColumn("mark", F.xxhash64("label", "parts"))


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in getattr(column, "chunks", [column])]).astype("<i4").reshape(-1, dim)


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the runs of equal values."""
    cuts = (np.flatnonzero(np.diff(values)) + 1).tolist()
    return list(zip([0, *cuts], [*cuts, len(values)], strict=True)) if len(values) else []


def build_blocks(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per block: ids, labels and, by dimension, the values with their least and most."""
    n = rows.count()
    placed = rows.repartitionByRange(max(1, -(-n // block_rows)), "dim", "label", "vec_id", "mark").withColumn(
        "block", F.spark_partition_id())

    def build(batches) -> Iterator[dict]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        table = table.sort_by([("dim", "ascending"), ("label", "ascending"), ("vec_id", "ascending")])
        for s, e in _runs(table.column("dim").to_numpy()):
            part = table.slice(s, e - s)
            dim, labels = part.column("dim")[0].as_py(), part.column("label").to_numpy().astype("<i4")
            columns = np.ascontiguousarray(_matrix(part.column("parts"), dim).T)
            yield {"dim": [dim], "block": [part.column("block")[0].as_py()], "holds": [np.unique(labels).tolist()],
                   "ids": [part.column("vec_id").to_numpy().astype("<i8").tobytes()], "labels": [labels.tobytes()],
                   "columns": [[c.tobytes() for c in columns]], "least": [columns.min(1).tobytes()], "most": [columns.max(1).tobytes()]}

    return mapped(placed.select("dim", "block", "label", "vec_id", "parts"), build, BLOCKS)


class Block:
    """The rows of a block, by dimension."""

    def __init__(self, row: dict):
        self.ids, self.labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i4")
        self.columns = np.stack([np.frombuffer(c, "<i4") for c in row["columns"]])
        self.least, self.most = np.frombuffer(row["least"], "<i4"), np.frombuffer(row["most"], "<i4")
        self.reach = int(max(np.abs(self.least.astype(np.int64)).max(), np.abs(self.most.astype(np.int64)).max()))
        self.values: dict[type, np.ndarray] = {}
        self.read = 0  # values read, for tests and figures

    def kind(self, q: np.ndarray) -> type:
        """Double precision holds every sum exactly below 2^53; integers of 64 bits beyond."""
        return np.float64 if len(q) * self.reach * int(np.abs(q).max(initial=0)) < 2 ** 53 else np.int64

    def scan(self, q: np.ndarray, rows: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
        """(rows, exact scores) of the candidates that ``keep(low, high)`` lets through to the end.

        ``keep`` gets the lower and upper end of each candidate's score and returns a bitmap.
        """
        kind = self.kind(q)
        if kind not in self.values:
            self.values[kind] = self.columns.astype(kind)
        values, weight = self.values[kind], q.astype(kind)
        order = np.argsort(-np.abs(q), kind="stable")
        one, two = weight * self.least.astype(kind), weight * self.most.astype(kind)
        # what the dimensions from the k-th of the order on can add
        low = np.append(np.cumsum(np.minimum(one, two)[order][::-1])[::-1], 0)
        high = np.append(np.cumsum(np.maximum(one, two)[order][::-1])[::-1], 0)
        score = np.zeros(len(rows), weight.dtype)
        alive = keep(score + low[0], score + high[0])
        rows, score = rows[alive], score[alive]
        for k in range(0, len(q), STEP):
            if not len(rows):
                break
            dims = order[k:k + STEP]
            part = values[dims] if len(rows) == values.shape[1] else values[np.ix_(dims, rows)]
            score = score + weight[dims] @ part
            self.read += len(dims) * len(rows)
            done = min(k + STEP, len(q))
            alive = keep(score + low[done], score + high[done])
            if not alive.all():
                rows, score = rows[alive], score[alive]
        return rows, score.astype(np.int64)

    def best(self, q: np.ndarray, own: int, label: int, count: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the ``count`` best rows of the label, ties by id; rows of the id ``own`` are left out."""
        def keep(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            return high >= np.partition(low, len(low) - count)[len(low) - count] if len(low) > count else np.ones(len(low), bool)

        rows, score = self.scan(q, np.flatnonzero((self.ids != own) & (self.labels == label)), keep)
        first = np.lexsort((self.ids[rows], -score))[:count]
        return self.ids[rows[first]], score[first]

    def within(self, q: np.ndarray, label: int, windows: list[tuple[int, int]], count: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per window (least, most score): (ids, scores) of its ``count`` best rows of other labels."""
        def keep(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            alive = np.zeros(len(low), bool)
            for least, most in windows:
                may = (high >= least) & (low <= most)
                sure = low[may & (low >= least) & (high <= most)]
                if len(sure) > count:  # so many surely lie in the window at or above this
                    may &= high >= np.partition(sure, len(sure) - count)[len(sure) - count]
                alive |= may
            return alive

        rows, score = self.scan(q, np.flatnonzero(self.labels != label), keep)
        order = np.lexsort((self.ids[rows], -score))
        rows, score = rows[order], score[order]
        found = []
        for least, most in windows:
            inside = np.flatnonzero((score >= least) & (score <= most))[:count]
            found.append((self.ids[rows[inside]], score[inside]))
        return found


def window(positive: int, low: int, high: int) -> tuple[int, int]:
    """The integer scores s with ``low * positive <= 100 * s <= high * positive``."""
    return -(-low * positive // 100), high * positive // 100


def _packs(anchors: DataFrame) -> DataFrame:
    """Up to ``PACK_ROWS`` anchors of one length, neighbours by label, as one row."""
    def pack(batches) -> Iterator[dict]:
        for batch in batches:
            for s, e in _runs(batch.column("dim").to_numpy()):
                for i in range(s, e, PACK_ROWS):
                    part = batch.slice(i, min(PACK_ROWS, e - i))
                    dim, labels = part.column("dim")[0].as_py(), part.column("label").to_numpy().astype("<i4")
                    yield {"dim": [dim], "holds": [np.unique(labels).tolist()],
                           "ids": [part.column("vec_id").to_numpy().astype("<i8").tobytes()],
                           "marks": [part.column("mark").to_numpy().astype("<i8").tobytes()], "labels": [labels.tobytes()],
                           "vectors": [_matrix(part.column("parts"), dim).tobytes()],
                           "positives": [part.column("positives").to_pylist()]}

    dealt = anchors.repartitionByRange("dim", "label", "vec_id").sortWithinPartitions("dim", "label", "vec_id", "mark")
    return mapped(dealt.select("dim", "label", "vec_id", "mark", "parts", "positives"), pack, PACKS)


def _past(blocks: DataFrame, packs: DataFrame, tasks: int, answer, schema: str) -> DataFrame:
    """Each block once, then the packs dealt to it, through ``answer(block, own id, mark, label, vector, positives)``.

    ``answer`` returns lists of values, which follow anchor_id and mark in ``schema``. The number of ``tasks`` is
    given, since bytes say little about the work of a block and would have blocks merged.
    """
    none = lambda **kinds: [F.lit(None).cast(kind).alias(c) for c, kind in kinds.items()]
    first = blocks.select("dim", "block", F.lit(0).alias("side"), "ids", "labels", "columns", "least", "most",
                          *none(marks="binary", vectors="binary", positives="array<array<bigint>>"))
    then = packs.select("dim", "block", F.lit(1).alias("side"), "ids", "labels",
                        *none(columns="array<binary>", least="binary", most="binary"), "marks", "vectors", "positives")
    met = first.unionByName(then).repartition(tasks, "dim", "block").sortWithinPartitions("dim", "block", "side")
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches) -> Iterator[dict]:
        at = held = None
        for batch in batches:
            out: dict = {name: [] for name in names}
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if not row["side"]:
                    at, held = (row["dim"], row["block"]), Block(row)
                elif at == (row["dim"], row["block"]):
                    anchors = (np.frombuffer(row[c], kind).tolist() for c, kind in (("ids", "<i8"), ("marks", "<i8"), ("labels", "<i4")))
                    vectors = np.frombuffer(row["vectors"], "<i4").astype(np.int64).reshape(-1, row["dim"])
                    for own, mark, label, q, scores in zip(*anchors, vectors, row["positives"], strict=True):
                        values = answer(held, own, label, q, scores)
                        for name, column in zip(names, [[own] * len(values[0]), [mark] * len(values[0]), *values], strict=True):
                            out[name] += column
            yield out

    return mapped(met, run, schema)


def _meets(packs: DataFrame, blocks: DataFrame) -> DataFrame:
    """Packs, once for each block that holds one of their labels."""
    packs = packs.withColumn("pack", F.xxhash64("ids", "marks"))
    links = packs.select("dim", "pack", F.explode("holds").alias("label")).join(
        blocks.select("dim", "block", F.explode("holds").alias("label")), ["dim", "label"]).select("dim", "pack", "block").distinct()
    return packs.join(links, ["dim", "pack"])


def mine(vectors: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         scale: int = 256, shift_every: int = 7, labels: int = 10, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose vec_id is divisible by ``every``; per anchor and each of its first ``positives``
    rows of the same label, the first ``negatives`` rows of other labels whose score lies between
    ``low`` and ``high`` per cent of the positive's.
    """
    rows = usable(vectors, scale, shift_every, labels)
    blocks = materialise(build_blocks(rows, block_rows), "bond-blocks")
    anchors = rows.where(F.col("vec_id") % every == 0)
    key, tasks = ["anchor_id", "mark"], max(1, blocks.count())

    def nearest(block: Block, own: int, label: int, q: np.ndarray, scores: None) -> list[list]:
        found, score = block.best(q, own, label, positives)
        return [found.tolist(), score.tolist()]

    # pass 1: packs meet the blocks that hold their labels
    packs = materialise(_packs(anchors.withColumn("positives", F.lit(None).cast("array<long>"))), "bond-anchors")
    found = _past(blocks, _meets(packs, blocks), tasks, nearest, "anchor_id long, mark long, positive_id long, positive_score long")
    order = Window.partitionBy(*key).orderBy(F.desc("positive_score"), "positive_id")
    best = materialise(found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives).drop("place"), "bond-positives")

    def harder(block: Block, own: int, label: int, q: np.ndarray, scores: list[int]) -> list[list]:
        out: list[list] = [[], [], []]
        for p, (ids, score) in zip(scores, block.within(q, label, [window(p, low, high) for p in scores], negatives), strict=True):
            out[0] += [p] * len(ids)
            out[1] += ids.tolist()
            out[2] += score.tolist()
        return out

    # pass 2: packs, with the scores of their positives, meet every block of their length
    scores = best.groupBy(*key).agg(F.sort_array(F.collect_set("positive_score"), asc=False).alias("positives"))  # `positives` at most
    ready = _packs(anchors.withColumnRenamed("vec_id", "anchor_id").join(scores, key).withColumnRenamed("anchor_id", "vec_id"))
    spans = materialise(blocks.groupBy("dim").agg(F.min("block").alias("lo"), F.max("block").alias("hi")), "bond-spans")
    everywhere = ready.join(spans, "dim").withColumn("block", F.explode(F.sequence("lo", "hi")))
    hard = _past(blocks, everywhere, tasks, harder, "anchor_id long, mark long, positive_score long, negative_id long, negative_score long")
    order = Window.partitionBy(*key, "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    ranked = hard.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return best.join(ranked, [*key, "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
