"""Token ids as Simple-8b words: 4 bits of selector and 60 bits of ids in each 64-bit word.

Selectors 2 to 15 pack from 60 ids of one bit to one id of 60 bits; selector 1 is a run (32 bits
of length, 28 of id); selector 0 is an escape: the next word holds a raw 64-bit id.

A file is a sequence of little-endian 64-bit words::

    magic, part, sequence number, ids in file, documents, blocks, ids per block
    word offset of each block, and of the end
    coded length of the document table
    the document table: ids as zig-zag differences, then id counts, coded with Simple-8b
    the blocks
    end mark (8 bytes, put there by the writer as its line separator)

Blocks hold a fixed number of ids, so any range of ids is found from the offsets and decoded on its
own. A file ends after the document that takes it past its size; no document spans two files.

Defined cases. Null text is empty and gives the end id only. Equal document ids keep the order of a
hash of their texts; null ids come first. An empty table gives no file. Very long texts make one
larger file.
"""
from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakehold.llm._base import mapped, parts, slices, total_bytes
from lakehold.sources.scratch import materialise

# ---- fixed values of the code: how many ids of how many bits a selector packs ----
PACKED = {2: (60, 1), 3: (30, 2), 4: (20, 3), 5: (15, 4), 6: (12, 5), 7: (10, 6), 8: (8, 7),
          9: (7, 8), 10: (6, 10), 11: (5, 12), 12: (4, 15), 13: (3, 20), 14: (2, 30), 15: (1, 60)}
ESCAPE, RUN = 0, 1
RUN_ID_BITS, RUN_MOST = 28, (1 << 32) - 1
# ---- end of fixed values ----

MAGIC = int.from_bytes(b"LH-S8B01", "little")
END_MARK = "S8B-END\n"
HEADER_WORDS = 7
IDS_PER_BLOCK = 1 << 16
IDS_PER_FILE = 1 << 22


# ---- the code -------------------------------------------------------------------------------

def pack(ids: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit integers to Simple-8b words."""
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64)
    limits = np.array([(1 << bits) - 1 for _, bits in PACKED.values()], np.uint64)
    kind = np.searchsorted(limits, ids).astype(np.int8)  # the narrowest selector that an id fits, 14: none
    padded_kind = np.concatenate((kind, np.zeros(60, np.int8)))  # the end of the ids may leave slots empty
    step, chosen = np.ones(n, np.int64), np.full(n, ESCAPE, np.int8)
    # from wide ids to narrow ones: where a selector fits, all wider ones do
    fit = np.arange(n)
    for k, (selector, (count, _)) in reversed(list(enumerate(PACKED.items()))):
        if kind.max() > k:
            if len(fit) * count > 2 * n:
                over = np.zeros(n + 61, np.int32)
                np.cumsum(padded_kind > k, out=over[1:])
                fit = fit[over[fit + count] == over[fit]]
            else:
                fit = fit[(padded_kind[fit[:, None] + np.arange(count)] <= k).all(1)]
            if not len(fit):
                break
        step[fit], chosen[fit] = count, selector
    at = np.arange(n)
    step = np.minimum(step, n - at)
    edges = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1], [True])))
    run = np.repeat(edges[1:], np.diff(edges)) - at
    long = (run > step) & (run <= RUN_MOST) & (ids < np.uint64(1 << RUN_ID_BITS))
    step[long], chosen[long] = run[long], RUN

    starts, i, after = [], 0, (at + step).tolist()
    while i < n:
        starts.append(i)
        i = after[i]
    first = np.array(starts, np.int64)
    how = chosen[first]
    width = 1 + (how == ESCAPE)
    slot = np.cumsum(width) - width
    out = np.zeros(int(width.sum()), np.uint64)
    padded = np.concatenate((ids, np.zeros(60, np.uint64)))
    for selector, (count, bits) in PACKED.items():
        of = first[how == selector]
        if len(of):
            word = np.full(len(of), selector, np.uint64) << np.uint64(60)
            for j in range(count):
                word |= padded[of + j] << np.uint64(j * bits)
            out[slot[how == selector]] = word
    of = first[how == RUN]
    out[slot[how == RUN]] = (np.uint64(RUN) << np.uint64(60)) | (step[of].astype(np.uint64) << np.uint64(RUN_ID_BITS)) | ids[of]
    out[slot[how == ESCAPE] + 1] = ids[first[how == ESCAPE]]
    return out


def unpack(words: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` integers of Simple-8b words; all words of one selector are decoded together."""
    out = np.empty(n, np.uint64)
    if not n:
        return out
    words = np.ascontiguousarray(words, dtype=np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int8)
    maybe = np.flatnonzero(selector == ESCAPE)
    raw = np.zeros(len(words), bool)  # raw ids, whose upper bits are no selector
    for i in maybe.tolist():  # escapes are rare, and a raw id may itself look like one
        if not raw[i]:
            raw[i + 1] = True
    count = np.zeros(len(words), np.int64)
    for s, (c, _) in PACKED.items():
        count[selector == s] = c
    run = (selector == RUN) & ~raw
    count[run] = ((words[run] >> np.uint64(RUN_ID_BITS)) & np.uint64(RUN_MOST)).astype(np.int64)
    escape = (selector == ESCAPE) & ~raw
    count[escape], count[raw] = 1, 0
    start = np.cumsum(count) - count
    for s, (c, bits) in PACKED.items():
        of = np.flatnonzero((selector == s) & ~raw)
        mask = np.uint64((1 << bits) - 1)
        for j in range(c if len(of) else 0):
            to = start[of] + j
            keep = to < n
            out[to[keep]] = (words[of[keep]] >> np.uint64(j * bits)) & mask
    for i in np.flatnonzero(run).tolist():
        out[start[i]:start[i] + count[i]] = words[i] & np.uint64((1 << RUN_ID_BITS) - 1)
    of = np.flatnonzero(escape)
    out[start[of]] = words[of + 1]
    return out


# ---- files ----------------------------------------------------------------------------------

def file_bytes(part: int, number: int, doc_ids: list[int | None], counts: list[int], ids: np.ndarray,
               ids_per_block: int = IDS_PER_BLOCK) -> bytes:
    """One file, without its end mark."""
    blocks = [pack(ids[i:i + ids_per_block]) for i in range(0, len(ids), ids_per_block)]
    offsets = np.concatenate(([0], np.cumsum([len(b) for b in blocks], dtype=np.int64))).astype(np.uint64)
    known = np.array([d or 0 for d in doc_ids], np.int64)
    steps = np.diff(known, prepend=np.int64(0))
    zigzag = ((steps << np.int64(1)) ^ (steps >> np.int64(63))).view(np.uint64)
    nulls = np.array([d is None for d in doc_ids], np.uint64)
    documents = pack(np.concatenate((nulls, zigzag, np.array(counts, np.uint64))))
    head = np.array([MAGIC, part, number, len(ids), len(doc_ids), len(blocks), ids_per_block], np.uint64)
    return np.concatenate((head, offsets, [np.uint64(len(documents))], documents, *blocks)).astype("<u8").tobytes()


class File:
    """A file's header, its documents and, on demand, its ids."""

    def __init__(self, content: bytes):
        words = np.frombuffer(content, "<u8")
        if len(words) < HEADER_WORDS or int(words[0]) != MAGIC or content[-8:] != END_MARK.encode():
            raise ValueError("not a Simple-8b token file, or not whole")
        self.part, self.number, self.n_ids, self.n_docs, self.n_blocks, self.per_block = map(int, words[1:HEADER_WORDS])
        at = HEADER_WORDS + self.n_blocks + 1
        self.offsets = words[HEADER_WORDS:at].astype(np.int64)
        self._documents, self._blocks = words[at + 1:at + 1 + int(words[at])], words[at + 1 + int(words[at]):-1]

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        """Document ids and their numbers of ids."""
        nulls, zigzag, counts = np.split(unpack(self._documents, 3 * self.n_docs), 3)
        steps = (zigzag >> np.uint64(1)).view(np.int64) ^ -((zigzag & np.uint64(1)).view(np.int64))
        ids = np.cumsum(steps).tolist()
        return [None if null else d for d, null in zip(ids, nulls.tolist(), strict=True)], counts.astype(np.int64)

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """The ids from ``start`` to ``stop``; only the blocks that hold them are decoded."""
        stop = self.n_ids if stop is None else min(stop, self.n_ids)
        lo, hi = start // self.per_block, -(-stop // self.per_block)
        found = [unpack(self._blocks[self.offsets[b]:self.offsets[b + 1]],
                        min(self.per_block, self.n_ids - b * self.per_block)) for b in range(lo, hi)]
        whole = np.concatenate(found) if found else np.zeros(0, np.uint64)
        return whole[start - lo * self.per_block:stop - lo * self.per_block]


# ---- encoding -------------------------------------------------------------------------------

class WordEncoder:
    """The ids of texts, by a cache of space-separated words.

    A byte-level tokenizer starts a new piece at a space between two other characters, whatever
    stands around; so each word with its leading space can be encoded on its own, and repeated words
    once. Texts with other white space next to a space, special tokens or very long words are given
    to the tokenizer whole. New words go to the tokenizer as one text.

    Arrow splits the texts and finds the distinct words of a batch; only those are looked up, and
    their ids are gathered into those of the texts.
    """

    def __init__(self, path: str, most: int = 700_000):
        import re

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._beside = re.compile(r"\s \s|^ \s|\s $|^ $")
        self._most = most
        self._after, self._first = {}, {}  # words after a space; words at a text's start
        # of each id: whether its token starts with a space
        vocabulary = self._tokenizer.get_vocab()
        self._starts = np.zeros(max(vocabulary.values()) + 1, bool)
        self._starts[[i for t, i in vocabulary.items() if t.startswith("Ġ")]] = True

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_after_space(self, words: list[str]) -> list[bytes]:
        """Words with a space before each, in one text: a token with a space starts each word."""
        if not words:
            return []
        text = "".join([" " + w for w in words])
        ids = np.array(self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        cuts = (np.flatnonzero(self._starts[ids]) * 4).tolist()
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip(cuts, [*cuts[1:], len(raw)], strict=True)]

    @staticmethod
    def _strings(words: pa.Array) -> list[str]:
        """Words without spaces, by one split: many times faster than one conversion each."""
        import pyarrow.compute as pc

        return pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), " ")[0].as_py().split(" ")

    def _learn(self, words: list[str], alone: list[str]) -> None:
        """Put words after a space into the cache. Those in ``alone`` start or end with white space
        and would join up with their neighbours."""
        after = self._after
        after.update(zip(alone, self._encode([" " + w for w in alone]), strict=True))
        new = [w for w in words if w not in after] if alone else words
        after.update(zip(new, self._encode_after_space(new), strict=True))

    def __call__(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        import pyarrow.compute as pc

        if len(self._after) + len(self._first) > self._most:
            self._after, self._first = {}, {}
        texts = pc.fill_null(pa.array(texts, pa.string()) if isinstance(texts, list) else texts, "")
        n_words = pc.add(pc.count_substring(texts, " "), 1).to_numpy(zero_copy_only=False)
        whole = pc.utf8_length(texts).to_numpy(zero_copy_only=False) > 64 * n_words
        for token in self._special:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        out: list[bytes] = [b""] * len(texts)
        kept = np.flatnonzero(~whole)
        if len(kept):
            cut = pc.split_pattern(texts.take(pa.array(kept)), " ")
            offsets = cut.offsets.to_numpy().astype(np.int64)
            offsets -= offsets[0]
            flat = cut.flatten()
            coded = flat.dictionary_encode()
            words, which = self._strings(coded.dictionary), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            heads = flat.take(pa.array(offsets[:-1])).dictionary_encode()
            first_words = heads.dictionary.to_pylist()
            trimmed = pc.utf8_trim_whitespace(coded.dictionary)
            edge = (pc.not_equal(trimmed, coded.dictionary).to_numpy(zero_copy_only=False)
                    | pc.equal(coded.dictionary, "").to_numpy(zero_copy_only=False))
            if edge.any():
                for i in np.flatnonzero(np.add.reduceat(edge[which], offsets[:-1])).tolist():
                    whole[kept[i]] = bool(self._beside.search(texts[int(kept[i])].as_py()))
            self._learn([w for w in words if w not in self._after],
                        [words[i] for i in np.flatnonzero(edge).tolist() if words[i] not in self._after])
            new = [w for w in first_words if w and w not in self._first]
            self._first[""] = b""
            self._first.update(zip(new, self._encode(new), strict=True))

            which[offsets[:-1]] = len(words) + heads.indices.to_numpy(zero_copy_only=False)
            pieces = pa.array([*map(self._after.__getitem__, words), *map(self._first.__getitem__, first_words)], pa.large_binary())
            found = pieces.take(pa.array(which))
            ends = np.frombuffer(found.buffers()[1], np.int64)[found.offset:found.offset + len(found) + 1]
            raw, bounds = memoryview(found.buffers()[2] or b""), ends[offsets].tolist()
            for i, a, b in zip(kept.tolist(), bounds[:-1], bounds[1:], strict=True):
                out[i] = bytes(raw[a:b])
        for i in np.flatnonzero(whole).tolist():
            out[i] = self._encode([texts[i].as_py()])[0]
        return out


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One per Python worker, whose cache serves all its tasks."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0,
                      partition_bytes: int = 64 << 20, ids_per_file: int = IDS_PER_FILE) -> None:
    """Encode ``(doc_id, text)`` and write files in ascending order of doc_id.

    Texts are range-partitioned by (doc_id, hash of the text) once; encoding, coding and writing
    follow in the same tasks.
    """
    n = parts(total_bytes(docs, "text"), partition_bytes)
    tie = F.xxhash64("text")
    ordered = docs.select("doc_id", "text").repartitionByRange(n, "doc_id", tie).sortWithinPartitions("doc_id", tie)
    end = np.array([end_id], "<u4").tobytes()

    def build(batches) -> Iterator[dict]:
        part, number, encode = 0, 0, encoder(tokenizer)
        docs_, counts, held, size = [], [], [], 0

        def flush() -> dict:
            ids = np.frombuffer(b"".join(held), "<u4")
            return {"file": [file_bytes(part, number, docs_, counts, ids)]}

        for batch in slices(batches, "text"):
            part = batch.column("part")[0].as_py()
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text")), strict=True):
                coded = ids + end
                docs_.append(doc)
                counts.append(len(coded) // 4)
                held.append(coded)
                size += counts[-1]
                if size >= ids_per_file:
                    yield flush()
                    number, docs_, counts, held, size = number + 1, [], [], [], 0
        if docs_:
            yield flush()

    mapped(ordered.select(F.spark_partition_id().alias("part"), "doc_id", "text"), build, "file binary").select(F.col("file").cast("string").alias("value")).write.option(
        "lineSep", END_MARK).option("maxRecordsPerFile", 1).text(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files below ``path``: doc_id, start, n_tokens, ids_crc32."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def rows(batches) -> Iterator[dict]:
        for batch in batches:
            for content in batch.column("content"):
                if not len(content.as_buffer()):
                    continue
                f = File(content.as_py())
                docs, counts = f.documents()
                ids = f.ids().astype("<u4")
                ends = np.cumsum(counts)
                starts = ends - counts
                yield {"part": [f.part] * len(docs), "number": [f.number] * len(docs), "doc_id": docs,
                       "local": starts.tolist(), "n_tokens": counts.tolist(),
                       "ids_crc32": [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]}

    found = materialise(mapped(files, rows, "part long, number long, doc_id long, local long, n_tokens long, ids_crc32 long"),
                        "token-files")
    # where each file starts: running sums of file sizes within a part, and of parts
    sizes = found.groupBy("part", "number").agg(F.sum("n_tokens").alias("n_ids"))
    before = lambda w: F.coalesce(F.sum("n_ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = sizes.withColumn("in_part", before(Window.partitionBy("part").orderBy("number"))).join(
        sizes.groupBy("part").agg(F.sum("n_ids").alias("n_ids")).select(
            "part", before(Window.orderBy("part")).alias("of_part")), "part").select(
        "part", "number", (F.col("in_part") + F.col("of_part")).alias("base"))
    return found.join(base, ["part", "number"]).select(
        "doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")
