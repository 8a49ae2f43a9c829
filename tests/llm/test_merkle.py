import hashlib

import llm_plain as plain
import pytest

from lakehold.llm import merkle as M

TEXT = "\n".join(f"Line {i} says this. It says more {i * i}. The end of {i}" for i in range(60))


def test_roots_and_located_edits():
    assert M.Tree(TEXT).fingerprint() == M.Tree(TEXT).fingerprint()
    changed = TEXT.replace("It says more 400", "It says less 400")
    a, b = M.Tree(TEXT), M.Tree(changed)
    assert a.root != b.root and 0.98 < M.likeness(a, b) < 1
    gone, new = M.differing(a, b)
    assert (gone.total(), new.total()) == (1, 1)
    assert M._digest(b"It says more 400", M.LEAF_BYTES) in gone and M._digest(b"It says less 400", M.LEAF_BYTES) in new


@pytest.mark.parametrize("text", ["", "\n", "a", "a\n\nb", TEXT, TEXT.replace("\n", "\n\n"), "x" * 5000, "? / . : - _ " * 99])
def test_a_fingerprint_holds_its_tree(text):
    tree = M.Tree(text)
    again = M.Tree.parse(tree.fingerprint())
    assert (again.root, again.sections, again.n_leaves) == (tree.root, tree.sections, tree.n_leaves)
    assert again.fingerprint() == tree.fingerprint()


def test_edits_are_located_from_stored_fingerprints():
    a, b = (M.Tree.parse(M.Tree(t).fingerprint()) for t in (TEXT, TEXT.replace("It says more 400", "It says less 400")))
    gone, new = M.differing(a, b)
    assert list(gone) == [M._digest(b"It says more 400", M.LEAF_BYTES)] and new.total() == 1


def test_a_changed_fingerprint_is_refused():
    printed = M.Tree("some words here").fingerprint()
    with pytest.raises(ValueError):
        M.Tree.parse(printed[:-3] + ("A" if printed[-3] != "A" else "B") + printed[-2:])


def test_inserted_lines_shift_nothing():
    lines = TEXT.split("\n")
    moved = M.Tree("\n".join([*lines[:10], "A new line", *lines[10:]]))
    assert M.likeness(M.Tree(TEXT), moved) > 0.98
    assert M.likeness(M.Tree(TEXT), M.Tree("Quite another text. With other lines")) == 0


@pytest.mark.parametrize(("a", "b"), [("", "\n"), ("a", "a\n"), ("a. b", "a.\nb"), ("a\nb", "a\n\nb"), ("a. b", "a.  b"), (" ", "")])
def test_different_texts_have_different_roots(a, b):
    assert M.Tree(a).root != M.Tree(b).root


def test_likeness_without_leaves():
    assert M.likeness(M.Tree(""), M.Tree("")) == M.likeness(M.Tree(""), M.Tree("\n")) == 1
    assert M.likeness(M.Tree(""), M.Tree("a")) == 0


def words(seed, n):
    return " ".join(hashlib.sha256(f"{seed} {i}".encode()).hexdigest()[:3 + i % 5] for i in range(n))


@pytest.mark.parametrize("text", [
    words(1, 400), "word " * 400, "x" * 5000, " " * 300, "".join(chr(0x4E00 + i * i % 9973) for i in range(2000)),
    "\u3002".join(words(i, 3).replace(" ", "") for i in range(60)), "\u0964 ".join(words(i, 3) for i in range(60)),
    "? ".join(words(i, 3) for i in range(60)), "! ".join(words(i, 3) for i in range(60))])
def test_half_of_a_text_without_full_stops_is_found(text):
    a, b, other = M.Tree(text), M.Tree(M.edited(text, words(2, 3000))), M.Tree(words(3, 400))
    assert 0.4 < M.likeness(a, b) < 0.7  # leaves of words are longer than those of repeated signs
    assert M.likeness(a, other) < 0.02


def test_a_long_word_moves_no_other_cuts():
    text = words(1, 200)
    assert M.likeness(M.Tree(text), M.Tree(text + " " + "y" * 40)) > 0.9


def test_a_word_inside_a_long_paragraph_is_located():
    text = words(1, 400)
    at = text.split(" ")
    changed = " ".join([*at[:200], "anotherword", "andmore", *at[200:]])
    gone, new = M.differing(M.Tree(text), M.Tree(changed))
    assert 1 <= gone.total() <= 6 and 1 <= new.total() <= 6
    assert M.likeness(M.Tree(text), M.Tree(changed)) > 0.9


def test_cuts_keep_separators():
    a = words(1, 12)
    texts = [a, a.replace(" ", "  ", 1), a.replace(" ", "\t"), a.replace(" ", ". ", 5), a.replace(" ", " . ", 5), a.replace(" ", "? "),
             a.replace(" ", "?  "), a.replace(" ", "?"), a.replace(" ", ".\n"), a + " ", a + ". ", a + "? "]
    assert len({M.Tree(t).root for t in texts}) == len(texts)


def expected(rows):
    out, rows = {}, sorted(rows)
    for i, (doc, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1] or ""
        text = text or ""
        half = len(text) // 2
        changed = text[:len(text) - half] + after[:half]
        out[doc] = (len(text), hashlib.sha256(changed.encode()).hexdigest(), M.Tree(text).fingerprint(), M.Tree(changed).fingerprint(),
                    M.likeness(M.Tree(text), M.Tree(changed)), M.likeness(M.Tree(text), M.Tree(after)))
    return out


@pytest.mark.parametrize("size", [1 << 20, 2000])
def test_neighbours_across_partitions(spark, size):
    rows = [(3 * i - 8, t) for i, t in enumerate(plain.TEXTS)]
    df = plain.docs(spark, [(*r, None, None) for r in rows]).repartition(4)
    got = {r[0]: tuple(r)[1:] for r in M.compare_with_next(df, partition_bytes=size).collect()}
    assert got == expected(rows)


def test_empty_single_and_repeated(spark):
    assert M.compare_with_next(plain.empty(spark)).collect() == []
    one = M.compare_with_next(plain.docs(spark, [(1, "abcd. x", None, None)])).collect()
    assert (one[0]["near_next"], one[0]["edited_sha256"]) == (1.0, hashlib.sha256(b"abcdabc").hexdigest())
    same = M.compare_with_next(plain.docs(spark, [(1, "abcd", None, None)] * 3 + [(None, None, None, None)])).collect()
    assert sorted((r["doc_id"] or 0, r["n_chars"]) for r in same) == [(0, 0), (1, 4), (1, 4), (1, 4)]


def test_query(spark):
    from lakehold.llm.queries import op6_merkle_fingerprint

    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = op6_merkle_fingerprint(spark, sf).collect()
    assert len(got) == len(rows) and {r[0]: tuple(r)[1:] for r in got} == expected(rows)
    prints = {r["doc_id"]: r["fingerprint"] for r in got}
    ids = sorted(prints)
    following = dict(zip(ids, [*ids[1:], ids[0]], strict=True))
    for r in got:  # likeness from the returned strings alone
        assert r["near_edited"] == M.compare(r["fingerprint"], r["edited_fingerprint"])
        assert r["near_next"] == M.compare(r["fingerprint"], prints[following[r["doc_id"]]])
    texts = dict(rows)
    assert len({(r["fingerprint"], texts[r["doc_id"]]) for r in got}) == len({r["fingerprint"] for r in got}) == len(set(texts.values()))
