"""Language ID: script ranges narrow the candidates, Viterbi over per-word scores labels the words.

Learning counts letter pairs, letter triples and short words by language over a bounded sample of
labelled documents (``max_docs`` of each language, chosen by a hash of the id). A word's score for a
language is the sum of the log probabilities of its grams; languages that do not use the word's
script are ruled out first, by the share of their training letters in that script. The best path over
a document's words, where each change of language costs ``switch``, gives spans of one language.

All documents of a record batch take the same step of the path together: one row per document in
numpy, longest documents first, so the work per word is a few vector operations.

Defined cases. Null texts and texts without a letter are ``und`` with score 0. Words without letters
take the language around them and carry no weight. Words in a script that no learned language uses
score alike for all. Ties go to the language first by name. Without any training document every
text is ``und``. Null ids are never held out, nor learned from.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehold.llm._base import give_back, mapped, slices

MAX_DOCS = 1500
SWITCH = 6.0
WORDS_AT_ONCE = 16_384  # words whose grams are in memory at a time
MOST = 12.0  # a word's scores lie at most this far apart
UND = "und"

# ---- fixed values: first and last code point of the blocks of the main scripts ----
SCRIPTS = {
    "Latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF)],
    "Greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "Cyrillic": [(0x400, 0x52F)],
    "Armenian": [(0x531, 0x58F)],
    "Hebrew": [(0x591, 0x5F4)],
    "Arabic": [(0x600, 0x6FF), (0x750, 0x77F)],
    "Devanagari": [(0x900, 0x97F)],
    "Bengali": [(0x980, 0x9FF)],
    "Tamil": [(0xB80, 0xBFF)],
    "Thai": [(0xE00, 0xE7F)],
    "Georgian": [(0x10A0, 0x10FF)],
    "Hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7A3)],
    "Kana": [(0x3040, 0x30FF)],
    "Han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF)],
}
# ---- end of fixed values ----


def script(letter: int) -> int:
    """The number of a code point's script, in the order of SCRIPTS; the next number for others."""
    return next((i for i, ranges in enumerate(SCRIPTS.values()) if any(a <= letter <= b for a, b in ranges)), len(SCRIPTS))


class Alphabet:
    """Script number of each code point, -1 where it is no letter; filled as code points appear."""

    def __init__(self):
        self.of = np.full(0x110000, -2, np.int8)

    def __call__(self, points: np.ndarray) -> np.ndarray:
        for c in np.unique(points[self.of[points] == -2]).tolist():
            self.of[c] = script(c) if chr(c).isalpha() else -1
        return self.of[points]


# a gram is one 64-bit code: two or three code points of 21 bits, or a hash of a short word with the top bit set
POINT, START, END, SHORT = np.uint64(21), 1, 2, 5
WHOLE = np.uint64(1 << 63)


def grams(words: list[str], alphabet: Alphabet) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, word numbers) of all grams, then (script, word number) of all letters.

    Words are lower-cased and reduced to their letters. Grams are letter pairs and triples with
    word ends, and words of up to five letters whole."""
    points = np.frombuffer("\n".join(words).lower().encode("utf-32-le"), np.uint32)
    scripts = alphabet(points)
    letter = scripts >= 0
    of = np.cumsum(points == 10)[letter]
    size = np.bincount(of, minlength=len(words))
    some = np.flatnonzero(size)
    # every word with letters as: start, letters, end
    begin = np.cumsum(size[some] + 2) - size[some] - 2
    line = np.full(int((size[some] + 2).sum()), END, np.uint64)
    line[begin] = START
    rank = np.zeros(len(words), np.int64)
    rank[some] = np.arange(len(some))
    line[np.arange(len(of)) + 2 * rank[of] + 1] = points[letter]
    word = np.repeat(some, size[some] + 2)
    two = word[:-1] == word[1:]
    three = word[:-2] == word[2:]
    pair = (line[:-1] << POINT) | line[1:]
    triple = (line[:-2] << (POINT + POINT)) | pair[1:]
    short = np.flatnonzero(size[some] <= SHORT)
    whole = np.zeros(len(short), np.uint64)
    for j in range(1, SHORT + 1):
        inside = size[some[short]] >= j
        whole[inside] = (whole[inside] + line[begin[short][inside] + j]) * np.uint64(0x9E3779B97F4A7C15)
    return (np.concatenate((pair[two], triple[three], whole | WHOLE)),
            np.concatenate((word[:-1][two], word[:-2][three], some[short])), scripts[letter], of)


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def _order(codes: np.ndarray) -> np.ndarray:
    """0 for pairs, 1 for triples, 2 for whole words: each is a distribution of its own."""
    return (codes >= np.uint64(1 << 42)).astype(int) + (codes >= WHOLE)


class Model:
    """Gram scores by language, and which languages use a script."""

    def __init__(self, counts: dict[str, dict[int, int]], scripts: dict[str, dict[int, int]]):
        self.languages = sorted(counts)
        self.codes = np.unique(np.array([c for own in counts.values() for c in own], np.uint64))
        order = _order(self.codes)
        table = np.zeros((len(self.codes), len(self.languages)))
        for k, lang in enumerate(self.languages):
            codes = np.array(list(counts[lang]), np.uint64)
            own = np.zeros(len(self.codes))
            own[np.searchsorted(self.codes, codes)] = list(counts[lang].values())
            total, size = np.bincount(order, own, 3), np.bincount(order, minlength=3)
            table[:, k] = np.log((own + 0.5) / (total + 0.5 * size)[order])
        self.table = (table - table.max(1, keepdims=True)).astype(np.float32) if table.size else table.astype(np.float32)
        self.uses = np.array([[scripts[lang].get(s, 0) >= 0.005 * max(1, sum(scripts[lang].values())) for lang in self.languages]
                              for s in range(len(SCRIPTS) + 1)], bool).reshape(len(SCRIPTS) + 1, -1)

    def words(self, words: list[str], alphabet: Alphabet) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores of words by language, best 0, their numbers of letters, and of letters in a script that a language uses."""
        n, k = len(words), len(self.languages)
        if not n or not k:
            return np.zeros((n, max(1, k)), np.float32), np.zeros(n, np.int64), np.zeros(n, np.int64)
        codes, of, scripts, letter_of = grams(words, alphabet)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        known = self.codes[at] == codes
        rows, of = at[known], of[known]
        scores = np.stack([np.bincount(of, self.table[rows, j], n) for j in range(k)], 1)
        candidates = np.zeros((n, k), bool)
        for s in np.unique(scripts).tolist():
            candidates[letter_of[scripts == s]] |= self.uses[s]
        scores = np.where(candidates, scores, -np.inf)
        some = candidates.any(1)
        scores[~some] = 0
        return (np.maximum(scores - scores.max(1, keepdims=True), -MOST).astype(np.float32), np.bincount(letter_of, minlength=n),
                np.bincount(letter_of[self.uses.any(1)[scripts]], minlength=n))


def learn(docs: DataFrame, max_docs: int = MAX_DOCS) -> Model:
    """Fit on at most about ``max_docs`` documents of each language that are not held out."""
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    number = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not number:
        return Model({}, {})
    share = F.create_map(*[x for lang, n in number.items() for x in (F.lit(lang), F.lit(min(1.0, max_docs / n)))])
    sample = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000)

    def count(batches) -> Iterator[dict]:
        seen: dict[str, Counter] = {}
        for batch in slices(batches, "text"):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                seen.setdefault(lang, Counter()).update((text or "").split())
        alphabet = Alphabet()
        for lang, counted in seen.items():
            if not counted:
                continue
            times = np.array(list(counted.values()), np.int64)
            codes, of, scripts, letter_of = grams(list(counted), alphabet)
            code, which = np.unique(codes, return_inverse=True)
            letters = np.bincount(scripts.astype(int), times[letter_of], len(SCRIPTS) + 1)
            yield {"lang": [lang] * (len(code) + len(letters)), "gram": [True] * len(code) + [False] * len(letters),
                   "code": code.view(np.int64).tolist() + list(range(len(letters))),
                   "n": np.concatenate((np.bincount(which, times[of], len(code)), letters)).astype(np.int64).tolist()}

    found = mapped(sample.select("lang", "text"), count, "lang string, gram boolean, code long, n long").groupBy(
        "lang", "gram", "code").agg(F.sum("n").alias("n"))
    # what comes back is bounded by the alphabet's triples and the short words of a bounded sample
    counts, scripts = {lang: {} for lang in number}, {lang: {} for lang in number}
    for lang, gram, code, n in found.where("n > 1 or not gram").collect():
        (counts if gram else scripts)[lang][code % (1 << 64)] = n
    return Model(counts, scripts)


def viterbi(scores: np.ndarray, words: list[np.ndarray], switch: float = SWITCH) -> list[np.ndarray]:
    """The best path of languages through each document's words (row numbers of ``scores``)."""
    order = sorted(range(len(words)), key=lambda i: -len(words[i]))
    lengths = np.array([len(words[i]) for i in order])
    start = np.cumsum(lengths) - lengths
    flat = np.concatenate([words[i] for i in order]) if order else np.zeros(0, np.int32)
    most = int(lengths.max(initial=0))
    active = np.searchsorted(-lengths, -np.arange(most), side="left")  # documents with more than t words
    stay = np.zeros((len(flat), scores.shape[1]), bool)
    best = np.zeros(len(flat), np.int16)
    value = np.zeros((len(order), scores.shape[1]), np.float32)
    for t in range(most):
        a = active[t]
        at = start[:a] + t
        v = value[:a]
        top = v.argmax(1)
        change = v[np.arange(a), top][:, None] - switch * (t > 0)
        keep = v >= change
        stay[at], best[at] = keep, top
        v[:] = np.where(keep, v, change) + scores[flat[at]]
        v -= v.max(1, keepdims=True)
    path = np.zeros(len(flat), np.int16)
    last = value.argmax(1).astype(np.int16)
    for t in range(most - 1, -1, -1):
        a = active[t]
        at = start[:a] + t
        path[at] = last[:a]
        last[:a] = np.where(stay[at, last[:a]], last[:a], best[at])
    out = [np.zeros(0, np.int16)] * len(words)
    for k, i in enumerate(order):
        out[i] = path[start[k]:start[k] + lengths[k]]
    return out


class Labeller:
    """Labels lists of texts; keeps the scores of words it has seen, up to a number of them.

    The score of a text is the share of its letters in spans of the predicted language, times the
    probability of that language against the next best over those words.
    """

    def __init__(self, model: Model, switch: float = SWITCH, most_words: int = 200_000):
        self.model, self.switch, self.most, self.alphabet = model, switch, most_words, Alphabet()
        self._forget()

    def _forget(self) -> None:
        self.known, (self.scores, self.sizes, self.learned) = {}, self.model.words([], self.alphabet)

    def __call__(self, texts: list[str | None]) -> Iterator[tuple[str, float, list[dict]]]:
        return (found[:3] for found in self.judged(texts))

    def judged(self, texts: list[str | None]) -> Iterator[tuple[str, float, list[dict], float]]:
        """As a call, and the share of the letters that are in a script of a learned language."""
        names = self.model.languages
        if len(self.known) > self.most:
            self._forget()
        words = [text.split() if text and names else [] for text in texts]
        new = list(set().union(*words).difference(self.known))
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        # a batch can hold more than 100,000 new words, whose grams take many times the room of their scores
        scored = [self.model.words(new[i:i + WORDS_AT_ONCE], self.alphabet) for i in range(0, len(new), WORDS_AT_ONCE)]
        self.scores, self.sizes, self.learned = map(np.concatenate, zip((self.scores, self.sizes, self.learned), *scored, strict=True))
        del scored, new
        get = self.known.__getitem__
        rows = [np.array(list(map(get, ws)), np.int32) for ws in words]
        del words
        table, sizes, learned = self.scores, self.sizes, self.learned
        for row, path in zip(rows, viterbi(table, rows, self.switch), strict=True):
            weight = sizes[row]
            total = int(weight.sum())
            if not total:
                yield UND, 0.0, [], 0.0
                continue
            by = np.bincount(path, weight, minlength=len(names))
            k = int(by.argmax())
            sums = table[row[path == k]].sum(0, dtype=np.float64)
            rival = np.delete(sums, k).max(initial=-np.inf)
            sure = 1 / (1 + np.exp(min(50.0, rival - sums[k])))
            cuts = (np.flatnonzero(np.diff(path)) + 1).tolist()
            spans = [{"first": a, "last": b - 1, "lang": names[path[a]]} for a, b in zip([0, *cuts], [*cuts, len(path)], strict=True)]
            yield names[k], float(by[k] / total * sure), spans, int(learned[row].sum()) / total


def predict(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """doc_id, lang_pred, score, spans (first word, last word, language) of each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample it was learned from

    def label(batches) -> Iterator[dict]:
        labels = Labeller(shared.value, switch)
        for batch in slices(batches, "text"):
            found = list(labels(batch.column("text").to_pylist()))
            yield {"doc_id": batch.column("doc_id"), "lang_pred": [x for x, _, _ in found],
                   "score": [x for _, x, _ in found], "spans": [x for _, _, x in found]}

    return mapped(docs.select("doc_id", "text"), label, "doc_id long, lang_pred string, score double, "
                  "spans array<struct<first:int,last:int,lang:string>>")


def identify(docs: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """Learn from ``docs`` and label all of them: doc_id, held_out, lang_pred, score, spans."""
    return predict(docs, learn(docs, max_docs)).withColumn("held_out", held_out())


def accepted(docs: DataFrame, least_score: float = 0.25, max_docs: int = MAX_DOCS) -> DataFrame:
    """The rows of ``docs``, all columns kept, that have a language.

    Texts that are ``und``, or whose main language scores below ``least_score``, go. So do those with
    most letters in scripts that no learned language uses: they score alike for all languages.
    """
    import pyarrow as pa

    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, max_docs))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels = Labeller(shared.value)
        for batch in slices(batches, "text"):
            yield batch.filter(pa.array([lang != UND and score >= least_score and learned >= 0.5
                                         for lang, score, _, learned in labels.judged(batch.column("text").to_pylist())], pa.bool_()))
        del labels
        give_back()

    return docs.mapInArrow(keep, docs.schema)
