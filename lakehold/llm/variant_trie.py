"""Spelling variants: words one letter apart, found in a trie of letter-group counts.

*Words.* Runs of letters are counted over all texts; words that are long and frequent enough form
the vocabulary.

*Trie.* The letters are dealt into ``LEVELS`` groups; a word's vector holds its number of letters of each group,
and the trie has one level per group. Inserting a letter raises one count by one, deleting lowers one, replacing
does both, once each. So a depth-first search for a word's neighbours has a budget of one surplus and one
deficit: at each level it follows the branch of the word's own count and, as long as the budget lasts, those
one below (surplus) and one above (deficit). The searches of all words of a task go down together, as arrays of
(word, node, budget left). The words at the leaves reached are verified letter by letter.

*Parts.* The levels k, k + depth, k + 2 depth ... together are coarse group k; the vocabulary is dealt into parts by its
``depth`` coarse counts, the top of the trie. A word is stored in its own part and searched there and in
those parts that its budget can reach and that come after its own in order, so that every pair is found once. A budget
spent between parts is known level by level: only the coarse group that differs may spend it.
``depth`` is the least of ``DEPTHS`` whose parts are no larger than ``PART_WORDS``; parts that still are larger are
dealt into shares by a hash of the word, and each search visits all shares. No pair is lost either way.

Defined cases. Null texts have no words. Texts with a null doc_id count their words as they stand. Rows that
repeat a doc_id count each by itself. Very long words are words like any other (their pairs are verified one
by one). Ties between forms go to the word that is smaller in code points. An empty table, or one without frequent words,
gives no rows. Other columns are ignored.
"""
from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakehold.llm._base import mapped, slices
from lakehold.sources.scratch import materialise

LEVELS, DEPTHS, PART_WORDS = 24, (4, 6, 8, 12), 32_768
HELD_WORDS, CHUNK_ROWS, WIDE = 400_000, 200_000, 48
#: letters, the more frequent ones first; every LEVELS-th letter joins the same group
ORDER = "eanirtsoludhcmgpbvfkwzyjqx" + "".join(map(chr, range(0xC0, 0x100)))
assert len(set(ORDER)) == len(ORDER) == 90


# ---- words ------------------------------------------------------------------------------------

def count_words(docs: DataFrame, least_length: int = 6, least_count: int = 5, drop_every: int = 199) -> DataFrame:
    """(doc_id, text) -> word, n: runs of letters, A-Z lower-cased, long and frequent enough.

    Of a run whose crc32 with its doc_id is divisible by ``drop_every`` one letter is left out (0: of none).
    Tasks add up their words before the shuffle.
    """
    def run(batches) -> Iterator[dict]:
        find, total = re.compile(f"[a-zÀ-ÿ]{{{least_length},}}").findall, Counter()
        for batch in slices(batches, "text"):
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = find((text or "").encode().lower().decode())  # of bytes: A-Z only
                total.update(words)
                if doc is None or not drop_every or not words:
                    continue
                start = zlib.crc32(b"%d:" % doc)
                hashes = {w: h for w in set(words) if not (h := zlib.crc32(w.encode(), start)) % drop_every}
                counts = Counter(words) if len(hashes) > 4 else {w: words.count(w) for w in hashes}
                for w, h in hashes.items():
                    at = h % len(w)
                    total[w] -= counts[w]
                    if len(w) > least_length:
                        total[w[:at] + w[at + 1:]] += counts[w]
            if len(total) > HELD_WORDS:
                yield {"word": list(total), "n": list(total.values())}
                total.clear()
        yield {"word": list(total), "n": list(total.values())}

    counted = mapped(docs.select("doc_id", "text"), run, "word string, n long").where("n > 0")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# ---- the trie ---------------------------------------------------------------------------------

_LEVEL = np.full(256, -1, np.int64)
_LEVEL[list(ORDER.encode("latin-1"))] = np.arange(len(ORDER)) % LEVELS


def vectors(words: list[bytes]) -> np.ndarray:
    """Letter-group counts of words (latin-1)."""
    lengths = np.array([len(w) for w in words], np.int64)
    flat = _LEVEL[np.frombuffer(b"".join(words), np.uint8)]
    cells = np.bincount(np.repeat(np.arange(len(words)), lengths) * LEVELS + flat, minlength=len(words) * LEVELS)
    return cells.reshape(len(words), LEVELS).astype(np.int32)


class Trie:
    """The distinct rows of ``keys``, one level per column; ``leaf`` is the leaf of each row."""

    def __init__(self, keys: np.ndarray):
        order = np.lexsort(keys.T[::-1])
        rows = keys[order]
        new = np.zeros(len(rows), bool)
        node = np.zeros(len(rows), np.int64)
        self.levels: list[tuple[np.ndarray, int]] = []
        for column in rows.T.astype(np.int64):
            base = int(column.max()) + 3
            new[1:] |= column[1:] != column[:-1]
            code = node * base + column  # branches of a level, ascending; the position is the node below
            self.levels.append((code[np.append(True, new[1:])], base))
            node = np.cumsum(new)
        self.leaf = np.empty(len(rows), np.int64)
        self.leaf[order] = node
        self.visited = 0

    def below(self, level: int, node: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(exists, node) of the branch ``value`` of each node."""
        codes, base = self.levels[level]
        code = node * base + value
        at = np.searchsorted(codes, code)
        ok = (value >= 0) & (value < base - 1)
        ok &= codes[np.minimum(at, len(codes) - 1)] == code
        self.visited += len(node)
        return ok, at

    def search(self, keys: np.ndarray, spare: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """(row of ``keys``, leaf) pairs within the budget; the first column must agree.

        ``spare`` has per row and coarse group 1 where the row has one letter more than the part searched,
        -1 where it has one less; rows of zeros may spend surplus and deficit within one group.
        """
        at = np.arange(len(keys))
        ok, node = self.below(0, np.zeros(len(keys), np.int64), keys[:, 0].astype(np.int64))
        at, node = at[ok], node[ok]
        more = less = np.zeros(len(at), bool)  # surplus spent, deficit spent
        group = np.full(len(at), -1, np.int64)  # where the first was spent
        same = ~spare.any(1)
        for level in range(1, keys.shape[1]):
            k = (level - 1) % depth
            count, own, off = keys[at, level].astype(np.int64), same[at], spare[at, k]
            home = own & (~(more | less) | (group == k))
            parts = []
            for step, may in ((0, None), (-1, ~more & np.where(own, home, off == 1)), (1, ~less & np.where(own, home, off == -1))):
                pick = slice(None) if may is None else np.flatnonzero(may)
                ok, down = self.below(level, node[pick], count[pick] + step)
                parts.append((at[pick][ok], down[ok], more[pick][ok] | (step < 0), less[pick][ok] | (step > 0),
                              np.where((step != 0) & (group[pick][ok] < 0), k, group[pick][ok])))
            at, node, more, less, group = (np.concatenate(x) for x in zip(*parts, strict=True))
        whole = (more == less) | ~same[at]
        return at[whole], node[whole]


class Spelling:
    """Words as padded letters from either end, for comparing many pairs."""

    def __init__(self, words: list[bytes]):
        self.words, self.size = words, np.array([len(w) for w in words], np.int64)
        width = int(min(WIDE, self.size.max(initial=1)))
        fit = [w if len(w) <= width else b"" for w in words]
        self.left = np.array(fit, f"S{width}").view(np.uint8).reshape(len(words), width)
        self.right = np.array([w[::-1] for w in fit], f"S{width}").view(np.uint8).reshape(len(words), width)
        self.width = width

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs differ by exactly one inserted, deleted or replaced letter."""
        out = np.zeros(len(a), bool)
        longer, shorter = np.maximum(self.size[a], self.size[b]), np.minimum(self.size[a], self.size[b])
        for i in np.flatnonzero((longer > self.width) & (longer - shorter <= 1)).tolist():
            out[i] = _one_apart(self.words[a[i]], self.words[b[i]])
        fit = np.flatnonzero((longer <= self.width) & (longer - shorter <= 1))
        for i in range(0, len(fit), 100_000):
            s = fit[i:i + 100_000]
            same = sum(np.minimum(_leading(m[a[s]], m[b[s]]), shorter[s]) for m in (self.left, self.right))
            out[s] = (same >= longer[s] - 1) & (_leading(self.left[a[s]], self.left[b[s]]) < self.width)
        return out


def _leading(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Number of equal letters from the start."""
    differs = x != y
    first = differs.argmax(1)
    return np.where(differs[np.arange(len(first)), first], first, x.shape[1])


def _one_apart(a: bytes, b: bytes) -> bool:
    a, b = sorted((a, b), key=len)
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a != b and len(b) - len(a) <= 1 and (a[i:] == b[i + 1:] or (len(a) == len(b) and a[i + 1:] == b[i + 1:]))


def leaf_pairs(spelling: Spelling, a: np.ndarray, start_a: np.ndarray, end_a: np.ndarray,
               b: np.ndarray, start_b: np.ndarray, end_b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word pairs of pairs of leaves, whose words are ``a[start:end]`` and ``b[start:end]``.

    Large leaves do not meet as a product: words one letter apart agree in the first or in the last half of the
    shorter, so these halves are joined.
    """
    na, nb = end_a - start_a, end_b - start_b
    small = np.flatnonzero(na * nb <= 4096)
    cells = np.cumsum(na[small] * nb[small])
    for part in np.split(small, np.searchsorted(cells, np.arange(2_000_000, int(cells[-1]) if len(cells) else 0, 2_000_000))):
        n = na[part] * nb[part]
        of = np.repeat(part, n)
        cell = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        yield a[start_a[of] + cell // nb[of]], b[start_b[of] + cell % nb[of]]
    for i in np.flatnonzero(na * nb > 4096).tolist():
        left, right = a[start_a[i]:end_a[i]], b[start_b[i]:end_b[i]]
        half = int(min(spelling.size[left[0]], spelling.size[right[0]])) // 2
        found = set()
        for cut in (lambda w: w[:half], lambda w: w[len(w) - half:]):
            by = defaultdict(list)
            for x in left.tolist():
                by[cut(spelling.words[x])].append(x)
            for y in right.tolist():
                found.update((x, y) for x in by.get(cut(spelling.words[y]), ()))
        yield (np.array([x for x, _ in found], np.int64), np.array([y for _, y in found], np.int64))


def near_words(part: np.ndarray, role: np.ndarray, words: list[bytes], n: np.ndarray, done: np.ndarray, depth: int) -> dict:
    """Per word of the parts given: its near words found here, and the best of them.

    ``role`` 0 are the stored words of a part, 1 those searched in it; pairs of stored words are found
    unless ``done``.
    """
    spelling, counts = Spelling(words), vectors(words)
    keys = np.column_stack((part, counts))
    stored = np.flatnonzero(role == 0)
    trie = Trie(keys[stored])
    by_leaf = stored[np.argsort(trie.leaf, kind="stable")]
    bounds = np.append(0, np.cumsum(np.bincount(trie.leaf)))
    coarse = np.stack([counts[:, k::depth].sum(1) for k in range(depth)], 1)
    of_part = np.zeros((int(part.max()) + 1, depth), np.int64)
    of_part[part[stored]] = coarse[stored]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for own in (True, False):
        asked = stored[~done[stored]] if own else np.flatnonzero(role == 1)
        if not len(asked):
            continue
        # words of equal keys ask once
        which, leader, of = np.unique(keys[asked], axis=0, return_index=True, return_inverse=True)
        group = asked[np.argsort(of.ravel(), kind="stable")]
        ends = np.append(0, np.cumsum(np.bincount(of.ravel())))
        lead = asked[leader]
        at, leaf = trie.search(which, np.clip(coarse[lead] - of_part[part[lead]], -1, 1), depth)
        if own:  # the keys asked are the leaves, in the same order: each pair of leaves once
            here = np.searchsorted(stored, lead)
            fine = leaf >= trie.leaf[here][at]
            at, leaf = at[fine], leaf[fine]
        for x, y in leaf_pairs(spelling, group, ends[at], ends[at + 1], by_leaf, bounds[leaf], bounds[leaf + 1]):
            fine = spelling.near(x, y)
            x, y = x[fine], y[fine]
            if own and len(x):  # within one leaf a pair comes from both sides
                pair = np.unique(np.stack((np.minimum(x, y), np.maximum(x, y)), 1), axis=0)
                x, y = pair[:, 0], pair[:, 1]
            found.append((x, y))
    a = np.concatenate([z for x, y in found for z in (x, y)] or [stored[:0]])
    b = np.concatenate([z for x, y in found for z in (y, x)] or [stored[:0]])
    rank = np.empty(len(words), np.int64)  # code-point order
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[b], -n[b], a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else a
    best = b[first]
    return {"word": [words[i].decode("latin-1") for i in a[first].tolist()], "n_near": np.diff(np.append(first, len(a))).tolist(),
            "near_n": n[best].tolist(), "near": [words[i].decode("latin-1") for i in best.tolist()]}


# ---- parts ------------------------------------------------------------------------------------

def _coarse(depth: int) -> list[Column]:
    """Letters of each coarse group in ``word``."""
    out = []
    for k in range(depth):
        letters = "".join(c for i, c in enumerate(ORDER) if i % LEVELS % depth == k)
        out.append(F.length("word") - F.length(F.translate(F.col("word"), letters, "")))
    return out


def _after(depth: int) -> list[list[int]]:
    """The changes of coarse counts by one letter that lead to a part later in order."""
    steps = [[(i == a) - (i == b) for i in range(depth)] for a in range(-1, depth) for b in range(-1, depth) if a != b]
    return [s for s in steps if next(x for x in s if x) > 0]


def near_summary(words: DataFrame, depths: tuple[int, ...] = DEPTHS, part_words: int = PART_WORDS) -> DataFrame:
    """(word, n) -> word, n_near, near_n, near: the number of near words, and the most frequent of them."""
    for depth in depths:
        dealt = words.withColumn("counts", F.array(*_coarse(depth)))
        sizes = materialise(dealt.groupBy("counts").agg(F.count(F.lit(1)).alias("size")), "variant-parts")
        if (sizes.agg(F.max("size").alias("most")).first()["most"] or 0) <= part_words:
            break
    shares = F.ceil(F.col("size") / part_words).cast("int")
    own = F.pmod(F.xxhash64("word"), F.col("shares")).cast("int")
    parts = sizes.select("counts", shares.alias("shares"))
    home = dealt.join(parts, "counts")
    stored = home.select("counts", own.alias("share"), F.lit(0).alias("role"), "word", "n")
    across = home.where("shares > 1").select("counts", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"),
                                             F.lit(1).alias("role"), "word", "n", own.alias("own")).where("share > own").drop("own")
    changes = F.array(*[F.array(*map(F.lit, s)) for s in _after(depth)])
    reach = dealt.select("word", "n", "counts", F.explode(changes).alias("change")).select(
        "word", "n", F.zip_with("counts", "change", lambda x, y: x + y).alias("counts"))
    other = reach.join(parts, "counts").select("counts", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"),
                                               F.lit(1).alias("role"), "word", "n")
    rows = stored.unionByName(across).unionByName(other).withColumn("part", F.concat_ws(",", F.concat_ws(",", "counts"), "share"))

    def run(batches) -> Iterator[dict]:
        held, seen = [], None  # seen: the part of the last rows, if its stored words are already paired
        size = 0

        def work(last: bool) -> tuple[dict | None, list[pa.Table], str | None]:
            table = pa.concat_tables(held).combine_chunks()
            names, role = table.column("part").to_numpy(zero_copy_only=False), table.column("role").to_numpy()
            open_ = names == names[-1]
            keep: list[pa.Table] = []
            if not last:
                keep = [table.filter(pa.array(open_ & (role == 0)))]
            if not last and not (role[open_] == 1).any():  # its stored words may go on in the next batch
                ready = ~open_
                table, names, role = table.filter(pa.array(ready)), names[ready], role[ready]
                after = seen if seen == keep[0].column("part")[0].as_py() else None
            else:
                after = names[-1]
            if not len(names):
                return None, keep, after
            _, part = np.unique(names.astype(str), return_inverse=True)
            out = near_words(part.ravel().astype(np.int64), role, [w.encode("latin-1") for w in table.column("word").to_pylist()],
                             table.column("n").to_numpy(), names == seen if seen is not None else np.zeros(len(names), bool), depth)
            return out, keep, after

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.Table.from_batches([batch]))
            size += batch.num_rows
            if size >= CHUNK_ROWS:
                out, held, seen = work(False)
                size = 0
                if out:
                    yield out
        if held:
            out, _, _ = work(True)
            if out:
                yield out

    met = rows.select("part", "role", "word", "n").repartition("part").sortWithinPartitions("part", "role")
    found = mapped(met, run, "word string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near"))).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("best.minus")).alias("near_n"), F.col("best.near").alias("near"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, form) -> word, root: the last form reached; forms grow in frequency, so there is one.

    Doubling: each round replaces a word's target by its target's target; chains are as long as the logarithm
    of the largest count at most.
    """
    at = materialise(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = materialise(at.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                     F.col("next").isNotNull().alias("moved")), "variant-roots")
        at = joined.select("word", "root")
        if joined.where("moved").isEmpty():
            return at


def variants(docs: DataFrame, least_length: int = 6, least_count: int = 5, drop_every: int = 199, factor: int = 5,
             depths: tuple[int, ...] = DEPTHS, part_words: int = PART_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n of the words of all texts.

    A word's form is its near word with the largest count, if that is ``factor`` times its own or more.
    """
    words = materialise(count_words(docs, least_length, least_count, drop_every), "variant-words")
    near = near_summary(words, depths, part_words)
    judged = materialise(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(F.col("near_n") >= factor * F.col("n"), F.struct("near", "near_n")).alias("best")).select(
        "word", "n", "n_near", F.col("best.near").alias("form"), F.col("best.near_n").alias("form_n")), "variant-forms")
    return judged.join(roots(judged.where("form is not null")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
