"""Document fingerprints: a Merkle tree of sections, paragraphs and sentences.

Leaves are digests of a paragraph's sentences, a paragraph's node is the digest of its leaves'
digests, a section groups paragraphs, and the root covers the sections. Equal roots are equal
texts. Where roots differ, descending into the children that differ locates the edit.

Sections end at a blank line, or after a paragraph whose digest is divisible by four: the cuts
depend on what the text says, so they fall in step again after an edit. Sentences end at ``. `` and
at the ends of other kinds and scripts (see END); within one, a leaf ends after a word with an even
hash, of four to eight words. Words of over 16 code points, such as text without spaces, count as
several: their parts of three to eight code points end where the last three have a hash divisible by four.
Leaves keep their separators, so texts are equal where roots are.

The fingerprint is ``root:sections``: the root in hex, and the tree below it with every leaf as eight
characters of URL-safe base64, ``.`` closing a paragraph and ``/`` a section. Inner nodes are digests of
what is printed, so ``parse`` makes the whole tree from the string, and stored fingerprints can be
compared, and differing branches found, without the texts (``compare``). The likeness of two fingerprints
is the share of leaves in equal branches: equal sections first, then equal paragraphs of the other
sections, then equal leaves of the other paragraphs (Dice, with repeats).

Defined cases. Null text is empty; an empty text has a root of its own and no leaf. Two texts
without leaves are alike (1), one without and one with are not (0). Repeated branches pair off one
to one. Very long texts are one tree; nothing is cut off. An edit smaller than a leaf changes the
whole leaf: up to eight words without a sentence end may have no leaf in common with what they become.
"""
from __future__ import annotations

import hashlib
import re
import zlib
from base64 import urlsafe_b64decode, urlsafe_b64encode
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakehold.llm._base import mapped, parts, slices, total_bytes

LEAF_BYTES = 6  # of a leaf's digest; a multiple of three, as base64 then needs no padding
LEAST_WORDS, MOST_WORDS = 4, 8  # of a leaf that ends within a sentence
WORD_POINTS, LEAST_POINTS, MOST_POINTS = 16, 3, 8  # code points of a word, and of a part of a longer one

STOPS, OTHER_STOPS = ".?!\u2026", "\u3002\uff0e\uff61\uff01\uff1f\u0964\u0965\u061f\u06d4\u0589\u1362\u104b"
SIGN = re.compile(f"[{STOPS}{OTHER_STOPS}]")
END = re.compile(rf"[{STOPS}]+[\"'\u201d\u2019)\]]*\s+|[{OTHER_STOPS}]+\s*")


def _digest(data: bytes, size: int = 16) -> bytes:
    return hashlib.blake2b(data, digest_size=size).digest()


@lru_cache(1 << 18)
def _hash(word: str) -> int:
    return zlib.crc32(word.rstrip(" ").encode()) >> 7


def _units(words: list[str]) -> Iterator[str]:
    """Words with the spaces that follow them, those of over WORD_POINTS code points in parts."""
    for at, word in enumerate(words, 1):
        start = 0
        if len(word) > WORD_POINTS:
            for i in range(LEAST_POINTS, len(word)):
                n = i - start
                if n >= LEAST_POINTS and (n == MOST_POINTS or not _hash(word[i - 3:i]) & 3):
                    yield word[start:i]
                    start = i
        yield word[start:] + " " if at < len(words) else word[start:]


def _runs(sentence: str) -> list[str]:
    """Parts of LEAST_WORDS to MOST_WORDS words; the last may have fewer."""
    units, space = sentence.split(" "), " "
    if max(map(len, units)) > WORD_POINTS:
        units, space = list(_units(units)), ""
    out, start, n = [], 0, len(units)
    while n - start > LEAST_WORDS:
        end = start + LEAST_WORDS
        while end < n and end - start < MOST_WORDS and _hash(units[end - 1]) & 1:
            end += 1
        if end == n:
            break
        out.append(space.join(units[start:end]) + space)
        start = end
    out.append(space.join(units[start:]) if start else sentence)
    return out


def _leaves(sentence: str) -> list[bytes]:
    """Digests of a sentence's leaves; all but the last end in a line feed, which no sentence holds."""
    at, found = 0, []
    for end in END.finditer(sentence) if SIGN.search(sentence) else ():
        if end.end() < len(sentence):
            found += _runs(sentence[at:end.end()])
            at = end.end()
    found += _runs(sentence[at:] if at else sentence)
    return [_digest(x.encode() + b"\n", LEAF_BYTES) for x in found[:-1]] + [_digest(found[-1].encode(), LEAF_BYTES)]


class Tree:
    """root (bytes); sections: list of (digest, paragraphs: list of (digest, leaves: list of digests))."""

    __slots__ = ("leaves_of", "n_leaves", "root", "sections")

    def __init__(self, text: str, *known: Tree):
        """``known`` trees save digesting their sentences again."""
        self.sections, paragraphs = [], []
        self.leaves_of = own = {}
        for line in text.split("\n"):
            leaves = []
            for sentence in line.split(". ") if line else ():
                found = own.get(sentence)
                if found is None:
                    found = own[sentence] = next((t.leaves_of[sentence] for t in known if sentence in t.leaves_of), None) or _leaves(sentence)
                leaves += found
            digest = _digest(b"P" + b"".join(leaves))
            paragraphs.append((digest, leaves))
            if not line or not digest[-1] & 3:
                self._close(paragraphs)
                paragraphs = []
        if paragraphs:
            self._close(paragraphs)
        self._finish()

    def _close(self, paragraphs: list) -> None:
        self.sections.append((_digest(b"S" + b"".join(d for d, _ in paragraphs)), paragraphs))

    def _finish(self) -> None:
        self.root = _digest(b"R" + b"".join(d for d, _ in self.sections))
        self.n_leaves = sum(len(leaves) for _, ps in self.sections for _, leaves in ps)

    def fingerprint(self) -> str:
        return self.root.hex() + ":" + "".join(
            "".join(urlsafe_b64encode(b"".join(leaves)).decode() + "." for _, leaves in ps) + "/" for _, ps in self.sections)

    @classmethod
    def parse(cls, fingerprint: str) -> Tree:
        """The tree of a printed fingerprint; ValueError if its root is not that of its leaves."""
        root, _, printed = fingerprint.partition(":")
        tree = cls.__new__(cls)
        tree.leaves_of, tree.sections = {}, []
        for section in printed.split("/")[:-1]:
            paragraphs = []
            for paragraph in section.split(".")[:-1]:
                data = urlsafe_b64decode(paragraph)
                leaves = [data[i:i + LEAF_BYTES] for i in range(0, len(data), LEAF_BYTES)]
                paragraphs.append((_digest(b"P" + data), leaves))
            tree._close(paragraphs)
        tree._finish()
        if tree.root.hex() != root:
            raise ValueError("not a fingerprint: its root is not that of its leaves")
        return tree


def _unpaired(mine: list, other: list) -> list:
    """The branches of ``mine`` that no equal branch of ``other`` pairs with."""
    left = Counter(d for d, _ in other)
    out = []
    for branch in mine:
        if left[branch[0]] > 0:
            left[branch[0]] -= 1
        else:
            out.append(branch)
    return out


def differing(a: Tree, b: Tree) -> tuple[Counter, Counter]:
    """The leaves of each text in no branch that the other has: where the edits are."""
    if a.root == b.root:
        return Counter(), Counter()
    lone = [_unpaired(a.sections, b.sections), _unpaired(b.sections, a.sections)]
    ps = [[p for _, s in sections for p in s] for sections in lone]
    ps = [_unpaired(ps[0], ps[1]), _unpaired(ps[1], ps[0])]
    x, y = (Counter(leaf for _, leaves in p for leaf in leaves) for p in ps)
    return x - y, y - x


def likeness(a: Tree, b: Tree) -> float:
    if a.root == b.root:
        return 1.0
    if not a.n_leaves or not b.n_leaves:
        return float(a.n_leaves == b.n_leaves)
    x, y = differing(a, b)
    return 1.0 - (x.total() + y.total()) / (a.n_leaves + b.n_leaves)


def compare(a: str, b: str) -> float:
    """The likeness of two printed fingerprints."""
    return 1.0 if a == b else likeness(Tree.parse(a), Tree.parse(b))


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the next document."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _compare(doc_id, text: str, tree: Tree, next_text: str, next_tree: Tree) -> tuple:
    changed = edited(text, next_text)
    own = tree if changed == text else Tree(changed, tree, next_tree)
    # a tree holds what its fingerprint prints, so this is compare() of the strings
    return (doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), tree.fingerprint(), own.fingerprint(),
            likeness(tree, own), likeness(tree, next_tree))


def _columns(rows: list[tuple]) -> dict:
    names = [f.split(" ")[0] for f in RESULT.split(", ")]
    return dict(zip(names, map(list, zip(*rows, strict=True)), strict=True))


def fingerprint(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> doc_id, n_chars, fingerprint of each row."""
    def run(batches) -> Iterator[dict]:
        for batch in slices(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            yield {"doc_id": batch.column("doc_id"), "n_chars": [len(t) for t in texts],
                   "fingerprint": [Tree(t).fingerprint() for t in texts]}

    return mapped(docs.select("doc_id", "text"), run, "doc_id long, n_chars long, fingerprint string")


def compare_with_next(docs: DataFrame, partition_bytes: int = 32 << 20) -> DataFrame:
    """Each document's fingerprint against its edited text's and the next document's (see RESULT).

    One range partitioning by (doc_id, hash of the text) puts neighbours side by side. Within a
    partition the next document is the next row; only the last row of each partition meets the first
    of the next partition, over two rows per partition. Both use the same exchange.
    """
    n = parts(total_bytes(docs, "text"), partition_bytes)
    tie = F.xxhash64("text")
    ordered = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).repartitionByRange(
        n, "doc_id", tie).sortWithinPartitions("doc_id", tie)

    def inner(batches) -> Iterator[dict]:
        held = None
        for batch in slices(batches, "text"):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                tree = Tree(text)
                if held:
                    rows.append(_compare(*held, text, tree))
                held = (doc_id, text, tree)
            if rows:
                yield _columns(rows)

    def ends(batches) -> Iterator[dict]:
        first = last = None
        for batch in batches:
            if batch.num_rows:
                first = first or batch.slice(0, 1).to_pylist()[0]
                last = batch.slice(batch.num_rows - 1).to_pylist()[0]
        if first:
            yield {"part": [first["part"], first["part"]], "end": [0, 1], "doc_id": [first["doc_id"], last["doc_id"]],
                   "text": [first["text"], last["text"]]}

    edges = mapped(ordered.select(F.spark_partition_id().alias("part"), "doc_id", "text"), ends, "part long, end int, doc_id long, text string")
    # the order of the partitions alone, without texts; the last is followed by the first
    by = Window.orderBy("part")
    every = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = edges.where("end = 0").select("part", F.coalesce(
        F.lead("part").over(by), F.first("part").over(every)).alias("next"))
    # the last row of a partition and the first of the next one meet under the latter's number
    row = F.when(F.col("end") == 1, F.struct("doc_id", "text"))
    meet = edges.join(order, "part").groupBy(F.when(F.col("end") == 1, F.col("next")).otherwise(F.col("part")).alias("at")).agg(
        F.max(row).alias("last"), F.max(F.when(F.col("end") == 0, F.col("text"))).alias("next_text")).select("last.*", "next_text")

    def across(batches) -> Iterator[dict]:
        for batch in batches:
            rows = [_compare(r["doc_id"], r["text"], Tree(r["text"]), r["next_text"], Tree(r["next_text"]))
                    for r in batch.to_pylist()]
            if rows:
                yield _columns(rows)

    return mapped(ordered, inner, RESULT).unionByName(mapped(meet, across, RESULT))
