"""SentencePiece BPE encoding by a prefix table, and decoding.

BPE is compositional: a token sequence is the encoding of its text exactly if every two neighbours
are, by themselves, the encoding of theirs (they are *compatible*). So each prefix of a text has one
last token: of the tokens that end there, the one compatible with the last token of the prefix
before it. An Aho-Corasick automaton over the pieces lists the tokens that end at each position; the
table of last tokens is filled from the left, and the ids are read off it from the end backwards.
The work is linear in the text, with no merge queue.

Compatibility is tested by replaying the merges of the two tokens' text, once per pair of tokens.

Pieces of this kind of model never run on from a letter into a space mark, so texts are cut before
each run of space marks and every distinct word is encoded once per worker (a bounded cache). Pieces
made of space marks alone all have the lowest score and are merged last, leftmost first: they are
handled after the words' own merges. Characters without a piece become their UTF-8 bytes.

Nothing merges across two neighbouring characters that no piece holds side by side, so a word that is
not known is cut there as well: one with a comma or a line break comes from the parts before and after.

Defined cases. Null text is empty: the end id only. Unknown ids and control ids decode as the
library does (the unknown surface; nothing). Byte pieces that are not valid UTF-8 decode to U+FFFD
each. Rows repeat as they are. Very long texts and words are encoded whole.
"""
from __future__ import annotations

import re
import string
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehold.llm._base import mapped, slices

SPACE = "▁"
# ---- fixed values: piece types of the model format ----
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_SURFACE = " ⁇ "
# ---- end of fixed values ----
MARKS = string.punctuation
PAIR = 32  # bits of a token's id in a pair


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protobuf message."""
    def number(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[i] & 127) << shift
            i, shift = i + 1, shift + 7
            if data[i - 1] < 128:
                return value, i

    i = 0
    while i < len(data):
        key, i = number(i)
        if key & 7 == 0:
            value, i = number(i)
        elif key & 7 == 2:
            n, i = number(i)
            value, i = data[i:i + n], i + n
        else:
            n = 4 if key & 7 == 5 else 8
            value, i = data[i:i + n], i + n
        yield key >> 3, value


def _packed(ids: list[int]) -> bytes:
    """Little-endian 32-bit integers."""
    return struct.pack(f"<{len(ids)}i", *ids)


class Pieces:
    """The pieces of a BPE model file, and what encoding and decoding need of them."""

    def __init__(self, path: str, most_words: int = 120_000, most_pairs: int = 200_000):
        import ahocorasick

        with open(path, "rb") as f:
            fields = list(_fields(f.read()))
        self.text, self.score, self.kind = [], [], []
        for field, value in fields:
            if field == 1:
                piece = dict(_fields(value))
                self.text.append(piece[1].decode())
                self.score.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kind.append(piece.get(3, NORMAL))
        if USER_DEFINED in self.kind or UNUSED in self.kind:
            raise ValueError("models with user-defined or unused pieces are not supported")
        normal = [i for i, k in enumerate(self.kind) if k == NORMAL]
        self.id = {self.text[i]: i for i in normal}
        self.byte = {int(self.text[i][3:5], 16): i for i, k in enumerate(self.kind) if k == BYTE}
        self.unknown, self.end = self.kind.index(UNKNOWN), self.text.index("</s>")
        self.runs = {len(t): i for t, i in self.id.items() if set(t) == {SPACE}}
        if any(SPACE in t.lstrip(SPACE) or t.startswith(SPACE * 2) and set(t) != {SPACE} for t in self.id):
            raise ValueError("pieces that run across words are not supported")
        # rank of every piece that words' own merges can make
        made = sorted((i for i in normal if len(self.text[i]) > 1 and set(self.text[i]) != {SPACE}), key=lambda i: -self.score[i])
        self.rank = {self.text[i]: r for r, i in enumerate(made)}
        self.automaton = ahocorasick.Automaton()
        for t, i in self.id.items():
            if set(t) != {SPACE} or len(t) == 1:
                self.automaton.add_word(t, (i, len(t) - 1, i << PAIR))
        self.automaton.make_automaton()
        # two neighbouring characters of pieces; between others nothing merges
        self.joined = {t[i:i + 2] for t in self.id for i in range(len(t) - 1)} | {SPACE * 2}
        self.pairs: dict[int, bool] = {}   # by the second token's id << PAIR, plus the first's
        self.words: dict[str, bytes] = {}   # used since ``older`` was set aside
        self.older: dict[str, bytes] = {}
        self.most_words, self.most_pairs = most_words, most_pairs

        self.surface = [
            b"" if k == CONTROL else UNKNOWN_SURFACE.encode() if k == UNKNOWN else bytes([int(t[3:5], 16)]) if k == BYTE
            else t.replace(SPACE, " ").encode() for t, k in zip(self.text, self.kind, strict=True)]
        self.surfaces = pa.array(self.surface, pa.large_binary())
        # of each id: whether a text that begins with it has one space too many
        self.begins = [k == NORMAL and t[0] == SPACE for t, k in zip(self.text, self.kind, strict=True)]

    # ---- encoding ----

    def _merge(self, text: str) -> list[str]:
        """What merging by rank, leftmost first, leaves of a short text."""
        parts, rank, never = list(text), self.rank.get, 1 << 60
        ranks = [rank(x + y, never) for x, y in zip(parts, parts[1:], strict=False)]
        while ranks and (best := min(ranks)) != never:
            at = ranks.index(best)
            parts[at] += parts.pop(at + 1)
            del ranks[at]
            if at:
                ranks[at - 1] = rank(parts[at - 1] + parts[at], never)
            if at < len(ranks):
                ranks[at] = rank(parts[at] + parts[at + 1], never)
        return parts

    def compatible(self, a: int, b: int) -> bool:
        """Whether two tokens side by side are the encoding of their text; ``a`` = -1: ``b`` alone."""
        if len(self.pairs) > self.most_pairs:
            self.pairs.clear()
        x, y = [self.text[a]] if a >= 0 else [], self.text[b]
        self.pairs[(b << PAIR) + a] = fits = self._merge("".join(x) + y) == [*x, y]
        return fits

    def last_tokens(self, text: str) -> list[int]:
        """For each prefix of a text its last token; -1 for the empty prefix, and where the prefix
        ends with a character without a piece, with which nothing merges."""
        last, known = [-1] * (len(text) + 1), self.pairs.get
        fixed = -1  # the last token is known up to here
        for end, (token, more, pair) in self.automaton.iter(text):
            if end > fixed:
                before = last[end - more]
                fits = known(pair + before)
                if fits is None:
                    fits = self.compatible(before, token)
                if fits:
                    last[end + 1] = token
                    fixed = end
        return last

    def encode_word(self, word: str) -> list[int]:
        """The ids of one word with its leading space marks."""
        last, at, ids = self.last_tokens(word), len(word), []
        while at:
            token = last[at]
            if token >= 0:
                ids.append(token)
                at -= len(self.text[token])
            else:
                at -= 1
                ids += [self.byte[b] for b in reversed(word[at].encode())] if self.byte else [self.unknown]
        ids.reverse()
        mark = self.runs.get(1)
        lone = 0
        while lone < len(ids) and ids[lone] == mark:
            lone += 1
        return self._spaces(lone) + ids[lone:] if lone > 1 else ids

    def _spaces(self, n: int) -> list[int]:
        """Lone space marks, merged leftmost first with equal scores."""
        done: list[int] = []
        for _ in range(n):
            size = 1
            while done and done[-1] + size in self.runs:
                size += done.pop()
            done.append(size)
        return [self.runs[size] for size in done]

    def encode(self, text: str | None) -> bytes:
        """The ids of a text, without the end id, as little-endian 32-bit integers."""
        if not text:
            return b""
        marked = text.replace(" ", SPACE)
        if SPACE * 2 not in marked and marked[0] != SPACE and marked[-1] != SPACE:
            words = marked.split(SPACE)
        else:
            words = [w[1:] for w in re.findall(f"{SPACE}+[^{SPACE}]*", SPACE + marked)]
        if len(self.words) > self.most_words:
            self.older, self.words = self.words, {}
        return b"".join(self._word_ids(words))

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """The ids of words that a space stands before."""
        known, out = self.words, []
        for w in words:
            ids = known.get(w)
            if ids is None:
                ids = self._part(SPACE + w, w) if w.isalpha() else self._parts(w)
            out.append(ids)
        return out

    def encode_batch(self, texts: pa.Array) -> list[bytes]:
        """``encode`` of each text; Arrow splits them and finds the distinct words, only those are looked up."""
        import pyarrow.compute as pc

        texts = pc.fill_null(texts, "")
        if pc.any(pc.match_substring(texts, SPACE)).as_py():
            texts = pc.replace_substring(texts, SPACE, " ")
        other = pc.or_(pc.or_(pc.starts_with(texts, " "), pc.ends_with(texts, " ")), pc.or_(pc.match_substring(texts, "  "), pc.equal(texts, "")))
        other = other.to_numpy(zero_copy_only=False)
        out: list[bytes] = [b""] * len(texts)
        kept = np.flatnonzero(~other)
        if len(kept):
            if len(self.words) > self.most_words:
                self.older, self.words = self.words, {}
            cut = pc.split_pattern(texts.take(pa.array(kept)), " ")
            offsets = cut.offsets.to_numpy().astype(np.int64)
            coded = cut.flatten().dictionary_encode()
            words = pc.binary_join(pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary), " ")[0].as_py().split(" ")
            found = pa.array(self._word_ids(words), pa.large_binary()).take(coded.indices)
            ends = np.frombuffer(found.buffers()[1], np.int64)[found.offset:found.offset + len(found) + 1]
            raw, bounds = memoryview(found.buffers()[2] or b""), ends[offsets - offsets[0]].tolist()
            for i, a, b in zip(kept.tolist(), bounds, bounds[1:], strict=False):
                out[i] = bytes(raw[a:b])
        for i in np.flatnonzero(other).tolist():
            out[i] = self.encode(texts[i].as_py())
        return out

    def _part(self, part: str, name: str) -> bytes:
        """The ids of a part of a word, known as ``name`` from then on."""
        ids = self.older.get(name)
        if ids is None:
            ids = _packed(self.encode_word(part))
        if len(name) <= 64:
            self.words[name] = ids
        return ids

    def _parts(self, word: str) -> bytes:
        """The ids of a word by its parts; a part inside a word is named with a space before it, as no word is."""
        marked, joined = SPACE + word, self.joined
        n = len(word.rstrip(MARKS))
        if word[:n].isalpha() and marked[n:n + 2] not in joined:
            cuts = [n + 1]
        else:
            cuts = [i for i in range(1, len(marked)) if marked[i - 1:i + 1] not in joined]
        if not cuts:
            return self._part(marked, word)
        out, known = [], self.words
        for a, b in zip([0, *cuts], [*cuts, len(marked)], strict=True):
            part = marked[a:b]
            name = " " + part if a else part[1:]
            ids = known.get(name)
            out.append(self._part(part, name) if ids is None else ids)
        return b"".join(out)

    def forget(self) -> None:
        self.words.clear()
        self.older.clear()
        self.pairs.clear()

    # ---- decoding ----

    def decode(self, ids: list[int]) -> str:
        """The text of ids, without the space that encoding puts first."""
        data = b"".join(map(self.surface.__getitem__, ids))
        try:
            text = data.decode()
        except UnicodeDecodeError:
            text = self._decode_by_runs(ids)
        first = next((i for i in ids if self.kind[i] != CONTROL), None)
        return text[1:] if first is not None and self.kind[first] == NORMAL and self.text[first][0] == SPACE else text

    def _decode_by_runs(self, ids: list[int]) -> str:
        """Byte pieces are decoded by their own runs; a byte that starts no character is U+FFFD."""
        out, held = [], bytearray()

        def flush() -> None:
            data = bytes(held)
            held.clear()
            while data:
                try:
                    out.append(data.decode())
                    return
                except UnicodeDecodeError as e:
                    out.append(data[:e.start].decode() + "�")
                    data = data[e.start + 1:]

        for i in ids:
            if self.kind[i] == BYTE:
                held += self.surface[i]
            else:
                flush()
                out.append(self.surface[i].decode())
        flush()
        return "".join(out)


_models: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """One per Python worker; a task forgets its words when it ends."""
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


def _encoded(p: Pieces, batches, end: bool) -> Iterator[dict]:
    tail = np.array([p.end] * end, "<i4").tobytes()
    for batch in slices(batches, "text", 2 << 20):
        coded = [ids + tail for ids in p.encode_batch(batch.column("text"))]
        ends = np.cumsum([0, *(len(c) // 4 for c in coded)])
        flat = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(coded))])
        yield {"doc_id": batch.column("doc_id"), "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)}
    p.forget()


def _decoded(p: Pieces, ids: pa.ListArray) -> list[str | None]:
    """The texts of lists of ids, from the bytes of all their surfaces at once."""
    flat, cuts = ids.values.to_numpy(), ids.offsets.to_numpy()
    found = p.surfaces.take(ids.values)
    ends = np.frombuffer(found.buffers()[1], np.int64)[found.offset:found.offset + len(found) + 1]
    raw, bounds, out = memoryview(found.buffers()[2] or b""), ends[cuts].tolist(), []
    cuts = cuts.tolist()
    for i, ok in enumerate(ids.is_valid().to_pylist()):
        a, b = cuts[i], cuts[i + 1]
        if not ok or a == b:
            out.append("" if ok else None)
        elif p.kind[flat[a]] == CONTROL:
            out.append(p.decode(flat[a:b].tolist()))
        else:
            try:
                out.append(str(raw[bounds[i] + p.begins[flat[a]]:bounds[i + 1]], "utf-8"))
            except UnicodeDecodeError:
                out.append(p.decode(flat[a:b].tolist()))
    return out


def encode(docs: DataFrame, model: str, end: bool = True) -> DataFrame:
    """(doc_id, text) -> doc_id, ids (array of int)."""
    def run(batches) -> Iterator[dict]:
        yield from _encoded(pieces(model), batches, end)

    return mapped(docs.select("doc_id", "text"), run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids) -> doc_id, ids, text."""
    def run(batches) -> Iterator[dict]:
        p = pieces(model)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                yield {"doc_id": batch.column("doc_id"), "ids": batch.column("ids"), "text": _decoded(p, batch.column("ids"))}

    return mapped(encoded.select("doc_id", "ids"), run, "doc_id long, ids array<int>, text string")


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) -> doc_id, ids, text: ``decode(encode(docs))`` in one worker instead of two a task."""
    def run(batches) -> Iterator[dict]:
        p = pieces(model)
        for row in _encoded(p, batches, True):
            yield {**row, "text": _decoded(p, row["ids"])}

    return mapped(docs.select("doc_id", "text"), run, "doc_id long, ids array<int>, text string")


def digests(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row's encoding and its decoding."""
    coded = round_trip(docs, model)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
