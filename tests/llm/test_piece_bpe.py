import hashlib
import random

import llm_plain as plain
import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from lakehold.llm import piece_bpe as B
from lakehold.llm.queries import PIECE_BPE, op9_piece_prefix_table, vocabulary

PATH = vocabulary(PIECE_BPE)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def ids_of(text):
    import numpy as np

    return np.frombuffer(B.pieces(PATH).encode(text), "<i4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" ▁aehinrst.,\n\té中ñ"), st.characters(exclude_categories=("Cs",))), max_size=60))
def test_equals_the_library(text):
    ids = ids_of(text)
    assert ids == LIBRARY.encode(text)
    assert B.pieces(PATH).decode([*ids, 2]) == LIBRARY.decode([*ids, 2])


@pytest.mark.parametrize("text", [*[" " * n for n in range(40)], *[f"a{' ' * n}中" for n in range(20)], "▁▁▁the", "x" * 3000, "the " * 2000,
                                  "a\u2581b", "a b ", " a", "\x00", "internationalization's", "…—“q”", "\ufffd"])
def test_spaces_and_long_texts(text):
    assert ids_of(text) == LIBRARY.encode(text)


def test_decoding_of_any_ids():
    rng = random.Random(2)
    for _ in range(300):
        ids = [rng.choice([rng.randrange(32_000), rng.randrange(3, 259), rng.randrange(3)]) for _ in range(rng.randrange(12))]
        assert B.pieces(PATH).decode(ids) == LIBRARY.decode(ids), ids


def expected(rows):
    out = []
    for doc, text in rows:
        ids = LIBRARY.encode(text or "", add_eos=True)
        out.append((doc, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()))
    return sorted(out, key=str)


def test_documents(spark):
    rows = [(i, t) for i, t in enumerate(plain.TEXTS)] + [(None, "x"), (3, "a")]
    got = B.digests(plain.docs(spark, [(*r, None, None) for r in rows]), PATH).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)
    assert B.digests(plain.empty(spark), PATH).collect() == []
    texts = {r["doc_id"]: r["text"] for r in B.decode(B.encode(plain.docs(spark), PATH), PATH).collect()}
    assert texts == {i: (t or "").replace("▁", " ") for i, t in enumerate(plain.TEXTS)}


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, op9_piece_prefix_table(spark, sf).collect()), key=str) == expected(rows)


def test_words_come_from_known_parts(monkeypatch):
    p, asked = B.Pieces(PATH), []
    encode_word = p.encode_word
    monkeypatch.setattr(p, "encode_word", lambda w: asked.append(w) or encode_word(w))
    p.encode("house house, house. (house) house,")
    # a mark after a word is cut off: no piece holds both
    assert asked[:3] == ["▁house", ",", "."] and "▁house," not in asked


def test_batches_encode_and_decode_as_single_texts():
    texts = ["the house, the house.\nThe end", None, "", " ", "▁", "a  b", " a", "a ", "a▁b", "日本\n語。x", "don't!!", "e.g.,", "\U0001d518\x00 é", "house"]
    p = B.Pieces(PATH, most_words=3)
    found = [np.frombuffer(x, "<i4").tolist() for x in p.encode_batch(pa.array(["skipped", *texts, *texts]).slice(1))]
    assert found == [LIBRARY.encode(t or "") for t in texts] * 2
    lists = pa.array([[0], None, [], *found, [p.end], [*found[0], p.end], [p.end, *found[0]]], pa.list_(pa.int32()))
    assert B._decoded(p, lists) == [None if x is None else LIBRARY.decode(x) for x in lists.to_pylist()]
