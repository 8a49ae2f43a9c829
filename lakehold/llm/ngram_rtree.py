"""N-gram Jaccard join over a count-vector R-tree, and the components of its links.

A document's set is its distinct word shingles, as 64-bit hashes. Equal sets are one class from the
start (by a 64-bit digest, as the shingles), so copies are never paired. Two classes link when
``den * intersection >= num * union``.

*Count vectors.* A set's shingles are hashed into ``DIMENSIONS`` groups; the group counts are its
point. Two sets share at most the sum of the coordinate minima of their points. An R-tree packs
points by unit of work, size and leading coordinates; a node keeps the maximum of every coordinate and the ranges
of units and sizes, which bounds the overlap of any two points below two nodes. One tree holds many units. Node pairs, then point pairs,
whose bound misses the threshold are dropped. Counts of long texts scatter so that the bound drops few of their pairs: those
that survive are held against parity marks, bitmaps that grow with the set and bound the shingles in which two sets differ
from below. What is left is verified on the sets.

*Shards.* At these thresholds one tree over all documents prunes little but by size (a text of n
shingles may differ in n/10, while its coordinates scatter by the square root of their counts; see
README), so trees are built per shard, and shards lose no link: sets of sizes up to ``hi`` that link
differ in at most ``k = 2 hi (den - num) / (den + num)`` shingles. Dealt into ``k + 1 + spare`` groups,
they agree exactly in at least ``1 + spare`` of them. A set therefore joins one shard for the content
of each group: any linked pair meets in a group both have whole. Sets with no more than ``spare``
empty groups leave these out, and still meet any partner in a group that is not empty; sets with
more join the shards of their empty groups as well. Size classes overlap, so that a pair of
unequal sizes meets in the larger one's.

*Large shards.* Members of a shard lie in blocks of ``BLOCK``. The first pass takes each block with the next one
only, so that a member occurs twice at most, however large the shard is, looks at ``FEW`` of the large shards of a class, and emits of each such unit's surviving pairs a maximum
spanning forest (by bounded similarity). Of these the ``PARTNERS`` best of each class, then of each component, are verified and
joined to components, which contracts groups of near copies; then all others that still lie between components. The second pass looks at shards whose members still lie in several components (those of more than a block become one of their smallest class): large components have blocks of
their own, small ones share blocks, and pairs of blocks meet unless both hold one and the same component. It emits every
surviving pair between members of different components, so that no link that matters is lost.

*One exchange.* Shard keys are hashes, most of which occur once. They are exchanged once, as (shard, class), sorted
within tasks and never stored; what a stream over the sorted rows finds in shards of one class is dropped there. A pair that
links meets in most of its shards. Shards of one block at most become one of their smallest class, which holds
every two of them together, so that a pair is not tried once for each. Points and texts are fetched for the classes that remain.

Defined cases. Null texts and texts without words have an empty set, link with nothing and are
their own component. Texts with fewer words than a shingle have one shingle, their whole word
sequence. Rows that repeat a doc_id are judged each by its own text. Null ids link with nothing;
their component is null. Very long texts are sets like any other. Empty tables give no rows.
"""
from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakehold.llm._base import fresh, mapped, slices
from lakehold.llm._graph import components, joined
from lakehold.sources.scratch import materialise

DIMENSIONS, LEAF, BLOCK = 64, 32, 512
CHUNK, PARTNERS, ROUNDS = 16_384, 3, 2  # rows under one tree; pairs per class in each of the first rounds of verification
FEW = 2  # large shards of a class that the first pass looks at
SLOTS = 1 << 16, 1 << 27  # least and most of the bitmap that preselects documents for verification

# odd 64-bit multipliers that spread bits
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_32 = np.uint64(32)


# ---- sets -----------------------------------------------------------------------------------

class _Hashes(dict):
    """Word -> 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


class Shingles:
    """The sorted distinct shingle hashes of texts; keeps the hashes of up to a number of words."""

    def __init__(self, width: int, most_words: int = 100_000):
        self.width, self.most, self.hashes = width, most_words, _Hashes()

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()  # of bytes: A-Z, and ASCII white space, only
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.hashes) > self.most:
            self.hashes.clear()
        h = np.array(list(map(self.hashes.__getitem__, words)), np.uint64)
        k = min(self.width, len(h))
        n = len(h) - k + 1
        out = np.full(n, np.uint64(k), np.uint64)  # a short text is unlike any whole shingle
        for j in range(k):
            out = (out ^ h[j:j + n]) * _A
            out ^= out >> _32
        return np.unique(out * _B)


# ---- shards that lose no link -----------------------------------------------------------------

class Bands:
    """Size classes, and in each the number of groups that a set is dealt into."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.lows = [1]

    def of(self, n: int) -> int:
        while self.lows[-1] <= n:
            low = self.lows[-1]
            self.lows.append(max(low * 5 // 4, low * self.den // self.num) + 1)
        return bisect_right(self.lows, n) - 1

    @lru_cache(maxsize=None)  # noqa: B019 - one small object per task
    def groups(self, band: int) -> tuple[int, int]:
        """(groups, spare) of a size class; no groups where only equal sets can link."""
        self.of(self.lows[-1])
        high = self.lows[band + 1] - 1
        differ = 2 * high * (self.den - self.num) // (self.den + self.num)
        spare = 2 + (differ + 1) // 12
        return (differ + 1 + spare, spare) if differ else (0, 0)

    def signatures(self, hashes: np.ndarray) -> np.ndarray:
        """One 64-bit shard key per group that the set joins a shard for."""
        n, keys = len(hashes), []
        mixed = hashes * _C
        high, low = (mixed >> _32).astype(np.float64), (mixed & np.uint64(0xFFFFFFFF)).astype(np.float64)
        for band in range(self.of(n), self.of(max(n, n * self.den // self.num)) + 1):
            groups, spare = self.groups(band)
            if not groups:
                continue
            g = (((hashes * _A) >> _32) * np.uint64(groups) >> _32).astype(np.int64)
            count = np.bincount(g, minlength=groups)
            # sums of 32-bit halves are exact in double precision for sets below two million
            content = np.bincount(g, low, groups).astype(np.uint64) * _A ^ np.bincount(g, high, groups).astype(np.uint64) * _B
            key = (content ^ count.astype(np.uint64)) * _C + np.arange(groups, dtype=np.uint64) * _B + np.uint64(band)
            key = (key ^ (key >> _32)) * _A
            some = count > 0
            keys.append((key if groups - some.sum() > spare else key[some]).view(np.int64))
        return np.concatenate(keys) if keys else np.zeros(0, np.int64)


def point(hashes: np.ndarray) -> np.ndarray:
    """Group counts; a byte each where they fit."""
    counts = np.bincount(((hashes * _B) >> np.uint64(58)).astype(np.int64), minlength=DIMENSIONS)
    return counts.astype("<u4" if counts.max() > 255 else "u1")


def points_of(stored: list[bytes]) -> np.ndarray:
    wide = {len(p) for p in stored} != {DIMENSIONS}
    rows = [np.frombuffer(p, "u1" if len(p) == DIMENSIONS else "<u4") for p in stored] if wide else [np.frombuffer(b"".join(stored), "u1")]
    return (np.stack(rows) if wide and rows else np.concatenate(rows or [np.zeros(0, "u1")])).reshape(-1, DIMENSIONS).astype(np.int32)


MARKS = 64, 4096  # least and most bytes of a set's parity marks


def parity(hashes: np.ndarray) -> bytes:
    """Bitmap of two to four bits a shingle, each the parity of the shingles that fall on it. Where two bitmaps differ
    in d bits, the sets differ in d shingles at least."""
    size = min(max(MARKS[0], 1 << (len(hashes) // 4).bit_length()), MARKS[1])
    place = ((hashes * _C) >> np.uint64(40)).astype(np.int64) & (8 * size - 1)
    return np.packbits((np.bincount(place, minlength=8 * size) & 1).astype(bool)).tobytes()


def differing(a: np.ndarray, b: np.ndarray, marks: list[bytes]) -> np.ndarray:
    """The least number of shingles in which the sets of pairs differ; a longer bitmap is folded onto the shorter."""
    length = np.array([len(m) for m in marks], np.int64)
    least, out = np.minimum(length[a], length[b]), np.zeros(len(a), np.int64)
    for size in np.unique(least).tolist():
        of = np.flatnonzero(least == size)
        used = np.unique(np.concatenate((a[of], b[of])))
        folded = np.zeros((len(used), size // 8), np.uint64)
        for long in np.unique(length[used]).tolist():
            rows = np.flatnonzero(length[used] == long)
            stored = np.frombuffer(b"".join(marks[i] for i in used[rows].tolist()), np.uint64)
            folded[rows] = np.bitwise_xor.reduce(stored.reshape(len(rows), long // size, size // 8), 1)
        x, y = np.searchsorted(used, a[of]), np.searchsorted(used, b[of])
        for i in range(0, len(of), 8192):
            s = slice(i, i + 8192)
            out[of[s]] = np.bitwise_count(folded[x[s]] ^ folded[y[s]]).sum(1, dtype=np.int64)
    return out


def digest(hashes: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


SKETCH = "doc_id long, n_shingles long, class long, point binary, marks binary"


def sketch(docs: DataFrame, width: int) -> DataFrame:
    """Each document's set size, digest and point."""
    def run(batches) -> Iterator[dict]:
        shingles = Shingles(width)
        for batch in slices(batches, "text"):
            sets = [shingles(t) for t in batch.column("text").to_pylist()]
            yield {"doc_id": batch.column("doc_id"), "n_shingles": [len(s) for s in sets],
                   "class": [digest(s) if len(s) else None for s in sets],
                   "point": [point(s).tobytes() if len(s) else None for s in sets],
                   "marks": [parity(s) if len(s) else None for s in sets]}

    return mapped(docs.select("doc_id", "text"), run, SKETCH)


def shard_keys(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """class, shard: the shards that each document's set joins. Not stored: they go straight into their one exchange."""
    def run(batches) -> Iterator[dict]:
        shingles, bands = Shingles(width), Bands(num, den)
        for batch in slices(batches, "text"):
            sets = [s for s in map(shingles, batch.column("text").to_pylist()) if len(s)]
            keys = [bands.signatures(s) for s in sets]
            sizes = np.array([len(k) for k in keys], np.int64)
            yield {"class": pa.array(np.repeat(np.array([digest(s) for s in sets], np.int64), sizes)),
                   "shard": pa.array(np.concatenate([np.zeros(0, np.int64), *keys]))}

    return mapped(docs.where("doc_id is not null and text is not null").select("text"), run, "class long, shard long")


# ---- the R-tree -------------------------------------------------------------------------------

class RTree:
    """Points packed by unit, size and leading coordinates; nodes bound the overlap of what is below.

    One tree holds many units; only points of one unit are paired, and nodes without a common unit part at once.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray, num: int, den: int, unit: np.ndarray | None = None):
        self.num, self.den = num, den
        unit = np.zeros(len(sizes), np.int64) if unit is None else unit
        self.order = np.lexsort((points[:, 2], points[:, 1], points[:, 0], sizes, unit))
        points, sizes, unit = points[self.order], sizes[self.order], unit[self.order]
        # of each node: maxima, least and most size, first and last unit
        self.levels = [(points, sizes, sizes, unit, unit)]
        fan = LEAF
        while len(self.levels[-1][0]) > 1:
            top, least, most, first, last = self.levels[-1]
            cuts = np.arange(0, len(top), fan)
            ends = np.append(cuts[1:], len(top)) - 1
            self.levels.append((np.maximum.reduceat(top, cuts), np.minimum.reduceat(least, cuts), np.maximum.reduceat(most, cuts),
                                first[cuts], last[ends]))
            fan = 8
        self.seen = [0] * len(self.levels)  # node pairs looked at, by level
        self.kept = [0] * len(self.levels)

    def _survive(self, level: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The node pairs that may hold a link: the bound on the overlap against the least that is needed."""
        top, least, most, first, last = self.levels[level]
        fine = np.flatnonzero((first[a] <= last[b]) & (first[b] <= last[a])
                              & (most[a] * self.den >= self.num * least[b]) & (most[b] * self.den >= self.num * least[a]))
        a, b = a[fine], b[fine]
        need = self.num * (least[a] + least[b])
        keep = np.zeros(len(a), bool)
        for i in range(0, len(a), 8192):
            s = slice(i, i + 8192)
            keep[s] = np.minimum(top[a[s]], top[b[s]]).sum(1, dtype=np.int64) * (self.num + self.den) >= need[s]
        self.seen[level] += len(a)
        self.kept[level] += int(keep.sum())
        return a[keep], b[keep]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Surviving pairs of different points of a unit, as positions in the arrays given."""
        a = b = np.zeros(1, np.int64)
        for level in range(len(self.levels) - 1, 0, -1):
            a, b = self._survive(level, a, b)
            fan, n = LEAF if level == 1 else 8, len(self.levels[level - 1][0])
            i, j = np.divmod(np.arange(fan ** 2), fan)
            low = []
            for s in range(0, len(a), 1024):
                x, y = (a[s:s + 1024, None] * fan + i).ravel(), (b[s:s + 1024, None] * fan + j).ravel()
                fine = ((x <= y) if level > 1 else (x < y)) & (x < n) & (y < n)
                x, y = x[fine], y[fine]
                low.append(self._survive(0, x, y) if level == 1 else (x, y))
            a, b = (np.concatenate([p[k] for p in low] or [a[:0]]) for k in (0, 1))
        return (self.order[a], self.order[b]) if len(self.levels) > 1 else (a[:0], b[:0])


def bounded(a: np.ndarray, b: np.ndarray, points: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The most that the similarity of pairs can be."""
    overlap = np.empty(len(a), np.int64)
    for i in range(0, len(a), 8192):
        overlap[i:i + 8192] = np.minimum(points[a[i:i + 8192]], points[b[i:i + 8192]]).sum(1, dtype=np.int64)
    return overlap / (sizes[a] + sizes[b] - overlap)


def forest(n: int, a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Positions of the pairs of a maximum spanning forest (Boruvka: every tree takes its best pair, and again)."""
    place = np.lexsort((b, a, -weight))
    a, b, label, chosen = a[place], b[place], np.arange(n), []
    while len(a):
        best = np.full(n, len(a))
        np.minimum.at(best, label[a], np.arange(len(a)))
        np.minimum.at(best, label[b], np.arange(len(a)))
        pick = np.unique(best[best < len(a)])
        chosen.append(place[pick])
        root = {}
        for x, y in zip(label[a[pick]].tolist(), label[b[pick]].tolist(), strict=True):
            while root.get(x, x) != x:
                x = root[x]
            while root.get(y, y) != y:
                y = root[y]
            root[max(x, y)] = min(x, y)
        for x in sorted(root):  # smaller ones are settled before
            root[x] = root.get(root[x], root[x])
        if root:
            to = np.arange(n)
            to[list(root)] = list(root.values())
            label = to[label]
        live = label[a] != label[b]
        a, b, place = a[live], b[live], place[live]
    return np.concatenate(chosen) if chosen else np.zeros(0, np.int64)


def unit_pairs(unit: np.ndarray, ids: np.ndarray, sizes: np.ndarray, points: np.ndarray, side: np.ndarray, label: np.ndarray,
               num: int, den: int, whole: bool, marks: list[bytes] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidate pairs of whole units, with the most that their similarity can be.

    Per unit a spanning forest of the pairs that have a member on side 0; or (``whole``) all pairs between labels, which
    lie on different sides if the unit has two.
    """
    a, b = RTree(points, sizes, num, den, unit).pairs()
    fine = (label[a] != label[b]) & (ids[a] != ids[b])
    if not whole:
        fine &= (side[a] == 0) | (side[b] == 0)
    else:
        two = np.zeros(int(unit.max(initial=0)) + 1, bool)
        two[unit[side == 1]] = True
        fine &= ~two[unit[a]] | (side[a] != side[b])
    a, b = a[fine], b[fine]
    if marks is not None and len(a):
        total, differ = sizes[a] + sizes[b], differing(a, b, marks)
        fine = differ * (den + num) <= total * (den - num)
        a, b = a[fine], b[fine]
    weight = bounded(a, b, points, sizes)
    if not whole and len(a) > 1:
        pick = forest(len(ids), a, b, weight)
        a, b, weight = a[pick], b[pick], weight[pick]
    return np.minimum(ids[a], ids[b]), np.maximum(ids[a], ids[b]), weight


def candidates(shared: DataFrame, num: int, den: int, whole: bool) -> DataFrame:
    """(shard, unit, side, class, size, point, marks, label) -> distinct candidate pairs a < b, with their weight."""
    rows = shared.withColumn("unit", F.concat_ws(":", "shard", "unit")).repartition("unit").sortWithinPartitions("unit", "class")

    def run(batches) -> Iterator[dict]:
        def work(table: pa.Table) -> dict:
            side, ids, sizes, label = (table.column(c).to_numpy() for c in ("side", "class", "size", "label"))
            unit = table.column("unit").combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
            a, b, weight = unit_pairs(unit, ids, sizes, points_of(table.column("point").to_pylist()), side, label, num, den, whole,
                                      table.column("marks").to_pylist())
            return {"a": pa.array(a), "b": pa.array(b), "weight": pa.array(weight)}

        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.Table.from_batches([batch]))
            size += batch.num_rows
            if size >= CHUNK:
                table = pa.concat_tables(held).combine_chunks()
                unit = table.column("unit").combine_chunks().dictionary_encode().indices.to_numpy()
                done = int(np.argmax(unit == unit[-1]))  # the last unit may go on in the next batch
                if done:
                    yield work(table.slice(0, done))
                held = [table.slice(done)]
                size = table.num_rows - done
        if size:
            yield work(pa.concat_tables(held).combine_chunks())

    found = mapped(rows.select("unit", "side", "class", "size", "point", "marks", "label"), run, "a long, b long, weight double")
    return found.groupBy("a", "b").agg(F.max("weight").alias("weight"))


# ---- members of shards ------------------------------------------------------------------------

def numbered(keys: DataFrame, key: str, most: int | None = None) -> DataFrame:
    """(key, class) -> key, class, place: the distinct classes of each key that has two or more, numbered from 0.

    Where ``most`` is given, keys with up to so many classes are told by their smallest class instead, and their places are null.
    Of one key no more than ``most`` classes are held.
    """
    dealt = keys.select(key, "class").repartition(key).sortWithinPartitions(key, "class")
    least = most or 1

    def run(batches) -> Iterator[dict]:
        held = np.zeros((2, 0), np.int64)  # of the last key, which may go on in the next batch
        sent, sent_key, sent_class = 0, None, None  # classes of it that are out already, as they are more than ``least``

        def told(rows: np.ndarray, more: bool) -> Iterator[dict]:
            nonlocal held, sent, sent_key, sent_class
            of, cls = rows
            new = np.ones(len(of), bool)
            new[1:] = (of[1:] != of[:-1]) | (cls[1:] != cls[:-1])
            goes_on = bool(sent) and len(of) > 0 and of[0] == sent_key
            if goes_on and cls[0] == sent_class:
                new[0] = False
            of, cls = of[new], cls[new]
            held = rows[:, :0]
            if not len(of):
                return
            starts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
            sizes = np.diff(np.append(starts, len(of)))
            before = np.zeros(len(starts), np.int64)
            before[0] = sent if goes_on and of[0] == sent_key else 0
            if more and before[-1] + sizes[-1] <= least:
                held = np.stack((of[starts[-1]:], cls[starts[-1]:]))
                of, cls, starts, sizes, before = of[:starts[-1]], cls[:starts[-1]], starts[:-1], sizes[:-1], before[:-1]
                sent = 0
            elif more:
                sent, sent_key, sent_class = int(before[-1] + sizes[-1]), of[-1], cls[-1]
            n = before + sizes
            place = np.arange(len(of)) - np.repeat(starts - before, sizes)
            keep = np.repeat(n > 1, sizes)
            small = np.repeat(n <= (most or 0), sizes)
            named = np.where(small, np.repeat(cls[starts], sizes), of)
            yield {key: pa.array(named[keep]), "class": pa.array(cls[keep]), "place": pa.array(place[keep], mask=small[keep])}

        for batch in batches:
            if batch.num_rows:
                rows = np.stack((batch.column(key).to_numpy(), batch.column("class").to_numpy()))
                yield from told(np.concatenate((held, rows), 1), True)
        yield from told(held, False)

    return mapped(dealt, run, f"{key} long, class long, place long")


def shared_members(keys: DataFrame) -> DataFrame:
    """shard, class, place: what has to meet. A pair that links lies in as many shards as it has groups in common, most
    of which hold the same few classes. Shards of a block at most are therefore joined into one of their smallest class, once
    for all: this holds any two of them together. Larger ones stay as they are."""
    found = materialise(numbered(keys, "shard", BLOCK), "ngram-shards")
    return numbered(found.where("place is null"), "shard").unionByName(found.where("place is not null"))


def thinned(members: DataFrame) -> DataFrame:
    """Members for the first pass: of shards larger than a block, each class keeps its first ``FEW``. Near copies share
    nearly all their shards and so meet in these; the second pass sees every shard."""
    large = members.where(F.col("place") >= BLOCK).select("shard").distinct()
    order = Window.partitionBy("class").orderBy("shard")
    some = members.join(large, "shard", "left_semi").withColumn("n", F.row_number().over(order)).where(F.col("n") <= FEW).drop("n")
    return members.join(large, "shard", "left_anti").unionByName(some)


def first_units(members: DataFrame) -> DataFrame:
    """(shard, class, place, ...) -> with unit and side: each block with the one after it."""
    block = (F.col("place") / BLOCK).cast("long")
    both = F.array(F.struct(block.cast("string").alias("unit"), F.lit(0).alias("side")),
                   F.struct((block - 1).cast("string").alias("unit"), F.lit(1).alias("side")))
    return members.withColumn("u", F.explode(F.filter(both, lambda u: u["unit"] != "-1"))).select("*", "u.unit", "u.side").drop("u")


def gathered(members: DataFrame) -> DataFrame:
    """(shard, class, label) -> those of shards with several components. Those shards that are larger than a block become
    one of their smallest class: near copies share most of their shards, and need not be tried in each."""
    torn = members.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.min("class").alias("least"),
                                        F.min("label").alias("from"), F.max("label").alias("to")).where("from <> to")
    named = F.when(F.col("n") > BLOCK, F.col("least")).otherwise(F.col("shard"))
    return members.join(torn.select("shard", "n", "least"), "shard").select(named.alias("shard"), "class", "label").distinct()


def second_units(members: DataFrame) -> DataFrame:
    """(shard, class, label, ...) of shards with several components -> with unit and side.

    Components of half a block or more have blocks of their own, others share; two blocks of one and the same component
    do not meet.
    """
    sizes = members.groupBy("shard", "label").agg(F.count(F.lit(1)).alias("n"))
    torn = sizes.groupBy("shard").agg(F.count(F.lit(1)).alias("labels"), F.sum(F.when(F.col("n") < BLOCK // 2, F.col("n")).otherwise(0)).alias("rest")).where("labels > 1")
    placed = members.join(sizes, ["shard", "label"]).join(torn.select("shard", "rest"), "shard")
    large = F.col("n") >= BLOCK // 2
    blocks = F.ceil(F.when(large, F.col("n")).otherwise(F.col("rest")) / BLOCK)
    own = F.when(large, F.col("label").cast("string")).otherwise(F.lit("rest"))
    placed = placed.withColumn("block", F.concat_ws("/", own, F.pmod(F.xxhash64("class"), blocks).cast("string"))).withColumn(
        "alone", F.when(large, F.col("label")))
    shape = placed.groupBy("shard", "block").agg(F.first("alone").alias("alone"))
    left, right = (shape.select("shard", F.col("block").alias(f"{x}_block"), F.col("alone").alias(f"{x}_alone")) for x in "lr")
    meet = left.join(right, "shard").where("l_block <= r_block and not coalesce(l_alone = r_alone, false)").select(
        "shard", F.concat_ws("|", "l_block", "r_block").alias("unit"), F.explode(F.when(F.col("l_block") == F.col("r_block"), F.array(
            F.struct(F.col("l_block").alias("block"), F.lit(0).alias("side")))).otherwise(F.array(
                F.struct(F.col("l_block").alias("block"), F.lit(0).alias("side")), F.struct(F.col("r_block").alias("block"), F.lit(1).alias("side"))))).alias("of")).select(
        "shard", "unit", "of.block", "of.side")
    return placed.join(meet, ["shard", "block"]).drop("n", "rest", "block", "alone")


# ---- verification -----------------------------------------------------------------------------

def verify(docs: DataFrame, pairs: DataFrame, first: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of classes whose sets link.

    ``first`` has a document of each class. A bitmap preselects these documents, so that only their sets are
    shuffled; the joins that follow are exact. It has eight bits per class asked for, up to 16 MB in all.
    """
    named = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct().join(first.select("class", F.col("doc_id").alias("id")), "class")
    asked = materialise(named.select("id").distinct(), "ngram-asked")
    slots = min(max(SLOTS[0], 1 << (8 * asked.count()).bit_length()), SLOTS[1])
    slot = F.pmod(F.xxhash64("id"), F.lit(slots))
    marks = asked.groupBy((slot / 64).cast("int").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(xxhash64(id), {slots}) % 64 as int))")).alias("bits"))
    bitmap = np.zeros(slots // 64, np.int64)
    for m in marks.toLocalIterator():  # bounded by the number of words
        bitmap[m["word"]] = m["bits"]
    shared = docs.sparkSession.sparkContext.broadcast(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))

    def sets(batches) -> Iterator[dict]:
        shingles = Shingles(width)
        for batch in batches:
            wanted = shared.value[batch.column("slot").to_numpy()] == 1
            for part in slices([batch.filter(pa.array(wanted))], "text"):
                found = [s for s in map(shingles, part.column("text").to_pylist()) if len(s)]
                yield {"class": [digest(s) for s in found], "shingles": [s.tobytes() for s in found]}

    chosen = docs.where("doc_id is not null").select(F.col("doc_id").alias("id"), "text")
    found = mapped(chosen.select("id", "text", slot.alias("slot")), sets, "class long, shingles binary")
    found = found.groupBy("class").agg(F.first("shingles").alias("shingles"))  # equal sets only
    both = pairs.join(found.select(F.col("class").alias("a"), F.col("shingles").alias("of_a")), "a").join(
        found.select(F.col("class").alias("b"), F.col("shingles").alias("of_b")), "b")

    def check(batches) -> Iterator[dict]:
        for batch in batches:
            a, b, linked = batch.column("a").to_pylist(), batch.column("b").to_pylist(), []
            for x, y in zip(batch.column("of_a"), batch.column("of_b"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                shared_ = len(x) + len(y) - len(np.union1d(x, y))
                linked.append(den * shared_ >= num * (len(x) + len(y) - shared_))
            yield {"u": [i for i, ok in zip(a, linked, strict=True) if ok], "v": [i for i, ok in zip(b, linked, strict=True) if ok]}

    return mapped(both.select("a", "b", "of_a", "of_b"), check, "u long, v long")


# ---- the join ---------------------------------------------------------------------------------

def link_components(docs: DataFrame, width: int = 3, num: int = 9, den: int = 10) -> DataFrame:
    """(doc_id, text) -> doc_id, n_shingles, component_id: the smallest doc_id reachable by links."""
    sk = materialise(sketch(docs, width), "ngram-sketch")
    members = materialise(shared_members(shard_keys(docs, width, num, den)), "ngram-members")
    able = sk.where("doc_id is not null and class is not null")
    # size, point and a document of the classes that share a shard with another
    paired = members.select("class").distinct()
    first = materialise(able.select("class", "doc_id", F.col("n_shingles").alias("size"), "point", "marks").join(paired, "class", "left_semi").groupBy(
        "class").agg(F.min("doc_id").alias("doc_id"), F.first("size").alias("size"), F.first("point").alias("point"),
        F.first("marks").alias("marks")), "ngram-classes")
    placed = lambda df: df.join(first.select("class", "size", "point", "marks"), "class")

    tried = materialise(candidates(placed(first_units(thinned(members))).withColumn("label", F.col("class")), num, den, whole=False), "ngram-pairs")
    # the best pairs of each class or component, some times over; then the others that do not lie within a component by then
    member = None

    def torn(pairs: DataFrame) -> DataFrame:
        if member is None:
            return pairs.withColumns({"of_a": F.col("a"), "of_b": F.col("b")})
        of = lambda c: member.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}"))
        named = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
        return named.withColumns({"of_a": F.coalesce("of_a", "a"), "of_b": F.coalesce("of_b", "b")}).where("of_a <> of_b")

    def add(pairs: DataFrame) -> None:
        nonlocal member
        found = materialise(verify(docs, pairs, first, width, num, den), "ngram-links")
        member = components(found) if member is None else joined(member, found)

    open_ = torn(tried)
    # few pairs are verified at once: rounds spare texts, but each has its own joins and components
    few = open_.count() <= PARTNERS * first.count()
    for _ in range(0 if few else ROUNDS):
        ends = open_.select(F.explode(F.array("of_a", "of_b")).alias("end"), "a", "b", "weight")
        order = Window.partitionBy("end").orderBy(F.desc("weight"), "a", "b")
        best = materialise(ends.withColumn("n", F.row_number().over(order)).where(F.col("n") <= PARTNERS).select("a", "b").distinct(), "ngram-best")
        add(best)
        open_ = materialise(torn(open_.select("a", "b", "weight").join(best, ["a", "b"], "left_anti")), "ngram-open")
        if open_.isEmpty():
            break
    else:
        add(open_.select("a", "b"))
    # what is left: pairs of a shard whose members lie in different components
    labelled = members.join(member.withColumnRenamed("node", "class"), "class", "left").select(
        "shard", "class", F.coalesce("component", "class").alias("label"))
    rest = candidates(placed(second_units(materialise(gathered(labelled), "ngram-torn"))), num, den, whole=True)
    rest = materialise(rest.select("a", "b").join(tried, ["a", "b"], "left_anti"), "ngram-pairs")
    if not rest.isEmpty():
        add(rest)

    # linked classes: the smallest document of each component; others: of their class
    linked = member.withColumnRenamed("node", "class").join(first.select("class", "doc_id"), "class")
    smallest = linked.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    known = linked.join(smallest, "component").select("class", "component_id")
    classes = able.groupBy("class").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    out = sk.select("doc_id", "n_shingles", "class").join(known, "class", "left").join(classes.select("class", "least"), "class", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "least", "doc_id")).alias("component_id"))


def first_of_each(docs: DataFrame, width: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """The rows of ``docs``, all columns kept, whose doc_id is the smallest of its component.

    Of rows that repeat a kept doc_id the least stays (columns compared in order). Rows without an
    id stay.
    """
    judged = materialise(link_components(docs, width, num, den).where("doc_id is not null").select(
        "doc_id", (F.col("doc_id") == F.col("component_id")).alias("stays")), "ngram-judged")
    ids = judged.groupBy("doc_id").agg(F.max("stays").alias("stays"), F.count(F.lit(1)).alias("n"))
    # written lists of ids: texts are shuffled only where these are too large to be sent to all tasks
    gone = materialise(ids.where("not stays").select("doc_id"), "ngram-gone")
    repeated = materialise(ids.where("stays and n > 1").select("doc_id"), "ngram-repeated")
    row = fresh(docs, "row")
    once = docs.where("doc_id is not null").join(gone, "doc_id", "left_anti").join(repeated, "doc_id", "left_anti")
    least = docs.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*docs.columns)).alias(row))
    return once.select(*docs.columns).unionByName(least.select(f"{row}.*")).unionByName(docs.where("doc_id is null"))
