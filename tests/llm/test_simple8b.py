import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakehold.llm import simple8b as S
from lakehold.llm.queries import BYTE_BPE, vocabulary
import llm_plain as plain


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 60_000), st.integers(0, 2**64 - 1),
                          st.sampled_from([2**60 - 1, 2**60, 0, 5])), max_size=400), st.integers(1, 300))
def test_round_trip(ids, repeat):
    ids = np.array(ids + ids[:1] * repeat, np.uint64)
    words = S.pack(ids)
    assert (S.unpack(words, len(ids)) == ids).all()


def test_packing_density():
    assert len(S.pack(np.ones(60, np.uint64) - np.arange(60, dtype=np.uint64) % 2)) == 1
    assert len(S.pack(np.arange(30_000, 30_400, dtype=np.uint64))) == 100  # four ids of 15 bits a word
    assert len(S.pack(np.full(100_000, 7, np.uint64))) == 1  # a run
    assert len(S.pack(np.full(1, 2**63, np.uint64))) == 2  # an escape


def test_file_and_random_access():
    ids = np.random.default_rng(1).integers(0, 50_000, 1000).astype(np.uint64)
    f = S.File(S.file_bytes(3, 4, [-5, None, 2**62, 7], [1, 0, 900, 99], ids, ids_per_block=64) + S.END_MARK.encode())
    assert (f.part, f.number, f.n_ids, f.n_blocks) == (3, 4, 1000, 16)
    docs, counts = f.documents()
    assert (docs, counts.tolist()) == ([-5, None, 2**62, 7], [1, 0, 900, 99])
    assert (f.ids() == ids).all() and (f.ids(130, 517) == ids[130:517]).all() and not len(f.ids(5, 5))
    with pytest.raises(ValueError):
        S.File(S.file_bytes(0, 0, [], [], ids[:0]))  # the end mark is missing


def expected(rows):
    from tokenizers import Tokenizer

    t, start, out = Tokenizer.from_file(vocabulary(BYTE_BPE)), 0, []
    for doc, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("size", [1 << 20, 64])
def test_documents(spark, tmp_path, size):
    rows = [(7 * i - 20, t) for i, t in enumerate(plain.TEXTS)]
    df = plain.docs(spark, [(*r, None, None) for r in rows]).repartition(3)
    S.write_token_files(df, str(tmp_path / "t"), vocabulary(BYTE_BPE), partition_bytes=size * 64, ids_per_file=size)
    got = S.read_token_files(spark, str(tmp_path / "t")).collect()
    assert sorted(map(tuple, got)) == sorted(expected(rows))


def test_empty_null_and_repeated_ids(spark, tmp_path):
    S.write_token_files(plain.empty(spark), str(tmp_path / "a"), vocabulary(BYTE_BPE))
    assert S.read_token_files(spark, str(tmp_path / "a")).collect() == []
    rows = [(None, "a b", None, None), (1, "c", None, None), (1, "c", None, None), (1, "d e f", None, None)]
    S.write_token_files(plain.docs(spark, rows), str(tmp_path / "b"), vocabulary(BYTE_BPE))
    got = sorted(map(tuple, S.read_token_files(spark, str(tmp_path / "b")).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, 1, 1, 1]
    assert [r[1] for r in got] == np.cumsum([0, *(r[2] for r in got[:-1])]).tolist()


def test_query(spark):
    from lakehold.llm.queries import op3_simple8b

    sf = "/root/testdata/sf0.001"
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    assert sorted(map(tuple, op3_simple8b(spark, sf).collect())) == expected(rows)
