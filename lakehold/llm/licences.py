"""Licence scan: a paragraph classifier, calibrated for what it does not know, confirmed by templates.

Paragraphs (lines) are scored by multinomial logistic regression over hashed word unigrams and
bigrams; class 0 is "no licence". It learns from notices altered by dropped, changed and added
words, against a bounded sample of corpus paragraphs (``max_paragraphs``) that are far from every
template. A held-out part calibrates it: one temperature fits the probabilities, and a paragraph
below the probability that all but one in a thousand corpus paragraphs stay under is unknown. A
predicted family is confirmed by the share of its best template's word bigrams in the paragraph.

Notices inside longer paragraphs, and those wrapped over lines, are found by the same model in
windows of 4, 8, 16 and 24 words that slide over the whole text. The threshold is set for paragraphs
and windows are many, so a window counts only where two thirds of a template are in it, and nothing
it shares with a better match. It is reported with the lines that the matched words stand in.

Scoring is one pass over the texts in place; nothing is shuffled. The model is of fixed size.

Defined cases. Null and empty texts have no paragraph. Every document gives one row; documents
without a licence have family null, an empty list and score 0. The family of a document is that of
its best confirmed paragraph, the first of equals. Repeated rows repeat. Very long paragraphs are
scored whole and in windows. Without corpus paragraphs the model learns from the notices and fixed negatives alone.
"""
from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehold.llm._base import mapped, slices

FEATURE_BITS, MAX_PARAGRAPHS, VARIANTS = 14, 4000, 60
FEATURES = 1 << FEATURE_BITS
CONFIRM, CONFIRM_WINDOW = 0.5, 2 / 3
WINDOWS = {4: 1, 8: 2, 16: 4, 24: 6}  # words of a window: words from one to the next
WINDOW_CHUNK = 1 << 15  # words whose sums are held at a time

# ---- fixed values: usual notices of the licence families ----
TEMPLATES = {
    "AGPL": ["This program is licensed under the GNU Affero General Public License, version 3."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "You may not use this file except in compliance with the Apache License, Version 2.0."],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted.",
            "Released under the BSD 3-Clause License."],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.",
                 "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "GPL": ["This work is licensed under the GNU General Public License, version 3.",
            "You can redistribute it under the terms of the GNU General Public License as published by the Free Software Foundation."],
    "LGPL": ["This library is licensed under the GNU Lesser General Public License, version 2.1."],
    "MIT": ["Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "public-domain": ["This is free and unencumbered software released into the public domain.",
                      "To the extent possible under law, the author has waived all copyright under CC0 1.0."],
    "reserved": ["All rights reserved.", "Copyright by the authors. All rights reserved."],
}
NEGATIVES = ["This program is under test.", "Released in version 3.", "The work of the authors is subject to change.",
             "All of it was permitted.", "You can use this file.", "The terms of the foundation were free.", "a", "1 2 3"]
# ---- end of fixed values ----

FAMILIES = [None, *sorted(TEMPLATES)]

WORD = re.compile(r"\d+(?:\.\d+)+|[^\W_]+")
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


class Features:
    """Feature numbers of paragraphs; keeps the hashes of up to a number of words."""

    def __init__(self, most_words: int = 300_000):
        self.most, self.hashes = most_words, _Hashes()

    def __call__(self, paragraphs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(feature numbers, paragraph numbers), in order of the paragraphs."""
        return self.of_words([WORD.findall(p.lower()) for p in paragraphs])[:2]

    def of_words(self, words: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """As above, of words; then the feature of each word, and of it and the next of all words."""
        if len(self.hashes) > self.most:
            self.hashes.clear()
        get = self.hashes.__getitem__
        h = np.array([x for ws in words for x in map(get, ws)], np.uint64)
        of = np.repeat(np.arange(len(words)), np.array([len(ws) for ws in words], np.int64))
        pair = ((h[:-1] * _A) ^ h[1:]) * _B
        inside = of[:-1] == of[1:]
        shift = np.uint64(64 - FEATURE_BITS)
        found = np.concatenate((h * _A, pair[inside])) >> shift
        both = np.concatenate((of, of[:-1][inside]))
        order = np.argsort(both, kind="stable")
        return found[order].astype(np.int64), both[order], (h * _A >> shift).astype(np.int64), (pair >> shift).astype(np.int64)


def bigrams(paragraph: str) -> set[str]:
    words = WORD.findall(paragraph.lower())
    return set(map(" ".join, zip(words, words[1:], strict=False))) or set(words)


_TEMPLATE_GRAMS = {f: [bigrams(t) for t in ts] for f, ts in TEMPLATES.items()}


def template_share(paragraph: str, family: str | None = None) -> float:
    """The largest share of a template's bigrams that the paragraph has."""
    own = bigrams(paragraph)
    return max((len(t & own) / len(t) for f, ts in _TEMPLATE_GRAMS.items() if family in (None, f) for t in ts), default=0.0)


def matched(words: list[str], family: str) -> tuple[float, int, int]:
    """The share of the family's best template among the words' bigrams, and the first and last word of it."""
    grams = list(map(" ".join, zip(words, words[1:], strict=False))) or words
    best = max(_TEMPLATE_GRAMS[family], key=lambda t: len(t.intersection(grams)) / len(t))
    at = [i for i, g in enumerate(grams) if g in best]
    share = len(best.intersection(grams)) / len(best)
    return (share, at[0], min(at[-1] + 1, len(words) - 1)) if at else (0.0, 0, len(words) - 1)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


class Classifier:
    """Weights (last row: intercept), temperature and threshold; of fixed size."""

    def __init__(self, weights: np.ndarray, temperature: float = 1.0, least: float = 0.5):
        self.weights, self.temperature, self.least = weights.astype(np.float32), temperature, least

    def logits(self, features: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros((n, self.weights.shape[1]), np.float32)
        if len(features):
            some, starts, sizes = np.unique(of, return_index=True, return_counts=True)
            out[some] = np.add.reduceat(self.weights[features], starts, axis=0) / np.sqrt(sizes)[:, None]
        return out + self.weights[-1]

    def probabilities(self, features: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
        return _softmax(self.logits(features, of, n) / self.temperature)


    def windows(self, single: np.ndarray, pair: np.ndarray, end: np.ndarray, rank: np.ndarray) -> list[tuple[int, int]]:
        """(first word, word after the last) of the windows that may reach the threshold.

        ``end`` is the word after the last of each word's text, ``rank`` a word's number in its text.
        """
        out, n = set(), len(single)
        # 1 - p0 >= least needs a class that is so far above class 0
        need = (np.log(self.least / max(1 - self.least, 1e-12)) - np.log(self.weights.shape[1] - 1)) * self.temperature - 1e-3
        for base in range(0, n, WINDOW_CHUNK):
            stop = min(n, base + WINDOW_CHUNK)
            last = min(n, stop + max(WINDOWS))
            ones, twos = (np.zeros((last - base + 1, self.weights.shape[1])) for _ in range(2))
            np.cumsum(self.weights[single[base:last]], axis=0, dtype=np.float64, out=ones[1:])
            np.cumsum(self.weights[pair[base:last - 1]], axis=0, dtype=np.float64, out=twos[1:last - base])
            for size, step in WINDOWS.items():
                a = np.flatnonzero(rank[base:stop] % step == 0)
                b = np.minimum(a + size, end[base + a] - base)
                z = (ones[b] - ones[a] + twos[b - 1] - twos[a]) / np.sqrt(2 * (b - a) - 1)[:, None] + self.weights[-1]
                some = z[:, 1:].max(1) - z[:, 0] >= need
                out.update(zip((a[some] + base).tolist(), (b[some] + base).tolist(), strict=True))
        return sorted(out)


def _variants(notice: str, others: list[str], rng: random.Random, n: int) -> list[str]:
    """A notice with words dropped, changed or added, and in other letter cases."""
    words, out = notice.split(" "), [notice, notice.upper(), notice.lower()]
    for _ in range(n):
        kept = [w for w in words if rng.random() > 0.08] or words
        kept = [rng.choice(others).split(" ")[0] if rng.random() < 0.04 else w for w in kept]
        around = rng.choice(others).split(" ")
        a, b = rng.choice([0, 0, 2, 6]), rng.choice([0, 0, 2, 6])
        out.append(" ".join([*around[:a], *kept, *around[len(around) - b:]]))
    return out


def fit(paragraphs: list[str], seed: int = 11, steps: int = 150, rate: float = 20.0, ridge: float = 1e-4) -> Classifier:
    """Logistic regression by accelerated gradient steps on the bounded sample, then calibration."""
    rng = random.Random(seed)
    negatives = [p for p in paragraphs if template_share(p) < 0.3] + NEGATIVES
    texts, labels = list(negatives), [0] * len(negatives)
    for k, family in enumerate(FAMILIES):
        for notice in TEMPLATES.get(family, []):
            found = _variants(notice, negatives, rng, VARIANTS)
            texts += found
            labels += [k] * len(found)
    numbers, of = Features()(texts)
    y = np.array(labels)
    held = np.array([rng.random() < 0.25 for _ in texts])
    train = np.flatnonzero(~held)
    position = np.cumsum(~held) - 1
    kept = ~held[of]
    flat, row = numbers[kept], position[of[kept]]
    size = np.bincount(row, minlength=len(train))
    scale = 1 / np.sqrt(np.maximum(size, 1))
    onehot = np.eye(len(FAMILIES))[y[train]]
    used, column = np.unique(flat, return_inverse=True)  # weights of other features stay zero
    order = np.argsort(column, kind="stable")
    cuts = np.searchsorted(column[order], np.arange(len(used)))
    some = np.flatnonzero(size)
    starts = (np.cumsum(size) - size)[some]
    w = np.zeros((len(used) + 1, len(FAMILIES)))
    ahead, t = w, 1.0
    for _ in range(steps):
        z = np.zeros((len(train), len(FAMILIES)))
        z[some] = np.add.reduceat(ahead[column], starts, axis=0) * scale[some][:, None]
        error = (_softmax(z + ahead[-1]) - onehot) / len(train)
        part = (error * scale[:, None])[row[order]]
        slope = np.vstack((np.add.reduceat(part, cuts, axis=0), error.sum(0))) + ridge * ahead
        new, t_new = ahead - rate * slope, (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    weights = np.zeros((FEATURES + 1, len(FAMILIES)))
    weights[used], weights[-1] = w[:-1], w[-1]

    model, truth = Classifier(weights), y[held]
    logits = model.logits(numbers, of, len(texts))[held].astype(np.float64)
    grid = np.geomspace(0.1, 5, 40)
    loss = [-np.log(_softmax(logits / g)[np.arange(len(truth)), truth] + 1e-12).mean() for g in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    licence = 1 - _softmax(logits / model.temperature)[:, 0]
    model.least = float(max(0.5, np.quantile(licence[truth == 0], 0.999))) if (truth == 0).any() else 0.5
    return model


def sample_paragraphs(docs: DataFrame, most: int = MAX_PARAGRAPHS) -> list[str]:
    """About ``most`` paragraphs of the corpus, chosen by a hash of what they say; each once."""
    lines = docs.select(F.explode(F.split("text", "\n")).alias("p")).where("p <> ''")
    n = lines.count()
    if not n:
        return []
    share = int(min(1.0, most / n) * (1 << 30))
    picked = lines.where(F.pmod(F.xxhash64("p"), F.lit(1 << 30)) < share).distinct().orderBy(F.xxhash64("p"), "p").limit(2 * most)
    return [r["p"] for r in picked.collect()]


RESULT = ("doc_id long, family string, score double, n_confirmed int, "
          "notices array<struct<paragraph:int,start:int,end:int,family:string,score:double,template_share:double,confirmed:boolean>>")


def scan(docs: DataFrame, model: Classifier) -> DataFrame:
    """(doc_id, text) -> one row per document (see RESULT); start and end are code points."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches) -> Iterator[dict]:
        model, features = shared.value, Features()
        for batch in slices(batches, "text", 1 << 20):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            lines = [(i, j, line) for i, t in enumerate(texts) for j, line in enumerate(t.split("\n")) if line]
            words = [WORD.findall(line.lower()) for _, _, line in lines]
            numbers, of, single, pair = features.of_words(words)
            p = model.probabilities(numbers, of, len(lines))
            hits: dict[int, list[dict]] = {}
            taken: dict[int, list[tuple[int, int]]] = {}  # by text: first and last word of each confirmed match
            first = np.cumsum([0, *map(len, words)])  # word of each line

            def hit(i: int, at: int, to: int, k: int, score: float, share: float, confirm: float) -> dict:
                """A hit in lines ``at`` to ``to``."""
                before = texts[i].split("\n")
                start = sum(len(x) + 1 for x in before[:lines[at][1]])
                return {"paragraph": lines[at][1], "start": start,
                        "end": start + len("\n".join(before[lines[at][1]:lines[to][1] + 1])), "family": FAMILIES[k],
                        "score": score, "template_share": share, "confirmed": share >= confirm}

            for at in np.flatnonzero(1 - p[:, 0] >= model.least).tolist():
                k = 1 + int(p[at, 1:].argmax())
                share = template_share(lines[at][2], FAMILIES[k])
                hits.setdefault(lines[at][0], []).append(hit(lines[at][0], at, at, k, float(p[at, k]), share, CONFIRM))
                if share >= CONFIRM:
                    _, a, b = matched(words[at], FAMILIES[k])
                    taken.setdefault(lines[at][0], []).append((int(first[at]) + a, int(first[at]) + b))

            flat = [w for ws in words for w in ws]
            of_word = np.repeat(np.arange(len(words)), np.diff(first))
            text_of = np.array([i for i, _, _ in lines], np.int64)[of_word]
            begin, end = (np.searchsorted(text_of, text_of, side) for side in ("left", "right"))
            spans = model.windows(single, pair, end, np.arange(len(flat)) - begin)
            parts = [flat[a:b] for a, b in spans]
            q = model.probabilities(*features.of_words(parts)[:2], len(parts))
            found = []
            for m in np.flatnonzero(1 - q[:, 0] >= model.least).tolist():
                k = 1 + int(q[m, 1:].argmax())
                share, a, b = matched(parts[m], FAMILIES[k])
                if share >= CONFIRM_WINDOW:
                    found.append((-share, -float(q[m, k]), spans[m][0] + a, spans[m][0] + b, k))
            for share, score, a, b, k in sorted(found):
                i = int(text_of[a])
                if all(b < x or y < a for x, y in taken.get(i, ())):
                    taken.setdefault(i, []).append((a, b))
                    hits.setdefault(i, []).append(hit(i, int(of_word[a]), int(of_word[b]), k, -score, -share, CONFIRM_WINDOW))
                    hits[i].sort(key=lambda x: x["start"])
            best = [max((h for h in hits.get(i, []) if h["confirmed"]), key=lambda h: h["score"], default=None) for i in range(len(texts))]
            yield {"doc_id": batch.column("doc_id"), "family": [h and h["family"] for h in best],
                   "score": [h["score"] if h else 0.0 for h in best],
                   "n_confirmed": [sum(h["confirmed"] for h in hits.get(i, [])) for i in range(len(texts))],
                   "notices": [hits.get(i, []) for i in range(len(texts))]}

    return mapped(docs.select("doc_id", "text"), run, RESULT)


def scan_corpus(docs: DataFrame, max_paragraphs: int = MAX_PARAGRAPHS) -> DataFrame:
    return scan(docs, fit(sample_paragraphs(docs, max_paragraphs)))
