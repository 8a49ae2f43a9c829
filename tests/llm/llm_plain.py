"""Plain, slow versions that the operators are held against."""
import collections
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")

TEXTS = [None, "", " ", "a", "a b", "One line. Two.\nAnother, line\n\nlast", "  two  spaces \n x ", "ß é 中文 ▁mark ☃ \x00 end.",
         "word " * 3000, "x" * 5000, "same text here again and again", "same text here again and again",
         "tab\tand\r\nnewline", "<|endoftext|> </s> <unk> <0x41>", "no spaces\u00a0but\u2003others", "don't, can't, 12.5 won't."]


def docs(spark, rows=None):
    """Documents with null, empty, long, repeated and odd texts, and columns whose names clash."""
    rows = [(i, t, None if i % 5 == 1 else "en", None if i % 4 == 2 else f"s{i % 3}") for i, t in enumerate(TEXTS)] if rows is None else rows
    return spark.createDataFrame(
        [(*r, None if r[1] is None else len(r[1]), 1, "x", 2, "y") for r in rows],
        "doc_id long, text string, lang string, source string, n_chars long, key int, component string, row int, shard string")


def empty(spark):
    return docs(spark, [])


def components(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, k):
    words = (text or "").encode().lower().split()
    return frozenset([tuple(words)] if 0 < len(words) < k else [tuple(words[i:i + k]) for i in range(len(words) - k + 1)])


def jaccard_components(rows, k, num, den):
    """{doc_id: (set size, component)} of (doc_id, text) rows."""
    sets = {d: shingles(t, k) for d, t in rows}
    posting, edges = collections.defaultdict(list), []
    for d, s in sets.items():
        shared = collections.Counter(e for x in s for e in posting[x])
        edges += [(d, e) for e, n in shared.items() if den * n >= num * (len(s) + len(sets[e]) - n)]
        for x in s:
            posting[x].append(d)
    of = components(sets, edges)
    return {d: (len(sets[d]), of[d]) for d in sets}


def targets(size_of, weights=(5, 2, 1), share=1.5, most=2):
    """Target words by source."""
    order = sorted(size_of, key=lambda s: (s is None, (s or "").encode()))
    weight, full = {s: weights[i % len(weights)] for i, s in enumerate(order)}, set()
    while True:
        rest = [s for s in order if s not in full]
        level = (share * sum(size_of.values()) - sum(most * size_of[s] for s in full)) / max(1, sum(weight[s] for s in rest))
        now = {s for s in rest if weight[s] * level > most * size_of[s]}
        if not now:
            return {s: most * size_of[s] if s in full else weight[s] * level for s in order}
        full |= now
