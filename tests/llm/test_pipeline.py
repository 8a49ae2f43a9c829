import collections
import hashlib

import corpus_pipeline
import llm_plain as plain
import pytest
import sentencepiece

from lakehold.llm import language
from lakehold.llm.queries import PIECE_BPE, vocabulary
from lakehold.sources.scratch import materialise

SF = "/root/testdata/sf0.001"


def through(spark, docs):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF), name)
        out.append(docs)
    return out


def test_against_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    labels = {r["doc_id"]: r for r in language.identify(docs).collect()}
    kept = [r for r in rows if labels[r["doc_id"]]["lang_pred"] != "und" and labels[r["doc_id"]]["score"] >= 0.25]
    component = plain.jaccard_components([(r["doc_id"], r["text"]) for r in kept], 5, 4, 5)
    kept = {r["doc_id"]: r for r in kept if component[r["doc_id"]][1] == r["doc_id"]}

    stages = through(spark, docs)
    for out in stages[:3]:
        assert out.columns == docs.columns
    assert {r["doc_id"]: r for r in stages[1].collect()} == kept
    size, taken = collections.Counter(), collections.Counter()
    for r in kept.values():
        size[r["source"]] += len(plain.WORD.findall(r["text"]))
    mixed = stages[2].collect()
    for r in mixed:
        assert r == kept[r["doc_id"]]
        taken[r["source"]] += len(plain.WORD.findall(r["text"]))
    for s, aim in plain.targets(size).items():
        least = min(len(plain.WORD.findall(r["text"])) for r in kept.values() if r["source"] == s)
        assert abs(taken[s] - aim) <= 0.05 * aim + least
    assert max(collections.Counter(r["doc_id"] for r in mixed).values()) <= 2
    m = sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECE_BPE))
    want = collections.Counter((r["doc_id"], hashlib.sha256(" ".join(map(str, m.encode(r["text"], add_eos=True))).encode()).hexdigest()) for r in mixed)
    assert collections.Counter((r["doc_id"], r["ids_sha256"]) for r in stages[3].collect()) == want
    again = collections.Counter((r["doc_id"], r["ids_sha256"]) for r in corpus_pipeline.run(spark, SF).collect())
    assert again == want


@pytest.mark.parametrize("rows", [[], None])
def test_defined_cases(spark, rows):
    df = plain.docs(spark, rows)
    assert [len(out.columns) for out in through(spark, df)[:3]] == [len(df.columns)] * 3
