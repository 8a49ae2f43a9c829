import collections
import random
import re
import zlib

import numpy as np
import pytest
from llm_plain import docs, empty

from lakehold.llm import variant_trie as vt


def plain_words(rows, least_length=6, least_count=5):
    n = collections.Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc}:{run}".encode())
            if doc is not None and h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= least_length and c >= least_count}


def plain_variants(n):
    """By the deletion neighbourhoods of all words."""
    by = collections.defaultdict(set)
    for w in n:
        for key in {w} | {w[:i] + w[i + 1:] for i in range(len(w))}:
            by[key].add(w)

    def one_apart(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    near = collections.defaultdict(set)
    for group in by.values():
        for a in group:
            near[a] |= {b for b in group if one_apart(a, b)}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def got(df):
    rows = df.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


def some_text(rng, alphabet, count):
    fixed = random.Random(alphabet)
    stems = ["".join(fixed.choice(alphabet) for _ in range(fixed.randint(5, 9))) for _ in range(60)]
    words = []
    for _ in range(count):
        w = stems[min(int(rng.paretovariate(0.4)) - 1, 59)]
        if rng.random() < 0.5:
            i = rng.randrange(len(w))
            w = w[:i] + rng.choice(["", w[i], rng.choice(alphabet), w[i] + rng.choice(alphabet)]) + w[i + 1:]
        words.append(w.title() if rng.random() < 0.2 else w)
    return " ".join(words)


@pytest.mark.parametrize(("depths", "part_words"), [((4, 6, 8, 12), 32_768), ((4,), 7), ((4, 6), 3)])
def test_equals_brute_force(spark, depths, part_words):
    rng = random.Random(7)
    rows = [(i, some_text(rng, "abcé", 400), None, None) for i in range(30)] + [(100 + i, some_text(rng, "aeinrstéß÷Ðklz", 400), None, None) for i in range(30)]
    rows += [(None, "nullid nullid nullid nullid nullid nullit", None, None), (3, "again again twice twice", None, None),
             (4, "chainword " * 200 + "chaimword " * 30 + "chaimwore " * 5, None, None)]
    want = plain_variants(plain_words(rows))
    assert sum(v[0] is not None for v in want.values()) > 50 and max(v[3] for v in want.values()) > 10
    assert any(v[1] != (v[0] or w) for w, v in want.items())  # a chain of forms
    assert got(vt.variants(docs(spark, rows), depths=depths, part_words=part_words)) == want


def test_long_words_and_odd_texts(spark):
    long = "ab" * 300
    rows = [(1, None, None, None), (2, "", None, None)] + [(10 + i, f"{long} {'x' * 60} 12 {'x' * 59}y", None, None) for i in range(6)]
    rows += [(30 + i, f"{long}b", None, None) for i in range(31)] + [(70 + i, "x" * 59 + " " + "x" * 61, None, None) for i in range(35)]
    assert got(vt.variants(docs(spark, rows))) == plain_variants(plain_words(rows))


def test_empty_tables(spark):
    assert vt.variants(empty(spark)).collect() == []
    assert vt.variants(docs(spark)).count() == len(plain_words([(i, t) for i, t in enumerate(__import__("llm_plain").TEXTS)]))


def test_leaves_of_many_anagrams_do_not_meet_as_a_product():
    """Permutations of the same letters share one vector; they are joined by their halves."""
    rng = random.Random(2)
    words = sorted({"".join(rng.sample("abcdefgh", 8)) for _ in range(3000)})
    group = {c: i % vt.LEVELS % 4 for i, c in enumerate(vt.ORDER)}
    mixed = sorted({w[:i] + x + w[i + 1:] for w in words[:40] for i in (0, 7) for x in "ijklmnop" if group[x] == group[w[i]]} | set(words))
    by = [w.encode("latin-1") for w in mixed]
    n = np.arange(len(by), dtype=np.int64) + 5
    zero = np.zeros(len(by), np.int64)
    out = vt.near_words(zero, zero, by, n, zero.astype(bool), 4)
    want = plain_variants({w: int(c) for w, c in zip(mixed, n, strict=True)})
    assert dict(zip(out["word"], out["n_near"], strict=True)) == {w: v[3] for w, v in want.items() if v[3]}


def test_search_follows_few_branches():
    """The budget prunes: a search sees a small part of the trie's branches."""
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abcdefghijklmnop") for _ in range(8)) for _ in range(4000)})
    keys = np.column_stack((np.zeros(len(words), np.int64), vt.vectors([w.encode() for w in words])))
    trie = vt.Trie(keys)
    trie.search(keys, np.zeros((len(keys), 4), np.int64), 4)
    assert trie.visited < 0.02 * len(words) * sum(len(codes) for codes, _ in trie.levels)


def test_query_on_the_table(spark):
    from lakehold.llm.queries import op12_variant_trie

    sf = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(op12_variant_trie(spark, sf)) == plain_variants(plain_words(rows))
