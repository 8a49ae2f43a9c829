import zlib

import numpy as np
import llm_plain as plain

from lakehold.llm import language as L
from lakehold.llm.queries import op4_language_viterbi

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, score double, spans int"


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(5)
    scores = rng.normal(size=(40, 3)).astype(np.float32) * 3
    words = [rng.integers(0, 40, n).astype(np.int32) for n in (7, 0, 1, 6, 7)]
    for row, path in zip(words, L.viterbi(scores, words, 2.0), strict=True):
        def value(p, row=row):
            return sum(scores[w, k] for w, k in zip(row, p, strict=True)) - 2.0 * sum(a != b for a, b in zip(p, p[1:], strict=False))
        best = max((value(p) for p in np.ndindex(*[3] * len(row))), default=0) if len(row) else 0
        assert abs(value(path.tolist()) - best) < 1e-4


def test_held_out_accuracy(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op4_language_viterbi(spark, SF).collect()
    assert len(rows) == len(docs) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"] and docs[r["doc_id"]]["lang"]]
    assert sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held) >= 0.98 * len(held)


def test_mixed_text_and_scripts(spark):
    said = {"en": "the cat and the dog were in this house with that other man", "de": "der Hund und die Katze waren nicht mit ihm im Haus",
            "ru": "кошка и собака были в этом доме вместе с ним"}
    rows = [(k * 10 + i, text, lang, 0.0, 0) for k in range(30) for i, (lang, text) in enumerate(said.items())]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = L.learn(docs)
    asked = [(1, said["en"] + " " + said["de"], None, 0.0, 0), (2, "собака 123 !!", None, 0.0, 0), (3, "12 ... ☃", None, 0.0, 0),
             (4, None, None, 0.0, 0), (5, "ελληνικά", None, 0.0, 0)]
    got = {r["doc_id"]: r for r in L.predict(spark.createDataFrame(asked, SCHEMA), model).collect()}
    assert [tuple(s) for s in got[1]["spans"]] == [(0, 12, "en"), (13, 23, "de")]
    assert got[1]["score"] < 0.7 < got[2]["score"]
    assert [got[i]["lang_pred"] for i in (2, 3, 4)] == ["ru", "und", "und"]
    assert got[5]["lang_pred"] in said and got[4]["score"] == got[3]["score"] == 0


def test_defined_cases(spark):
    docs = plain.docs(spark)
    got = {r["doc_id"]: r for r in L.identify(docs).collect()}
    assert len(got) == len(plain.TEXTS)
    assert {i for i, r in got.items() if r["lang_pred"] == "und"} == {i for i, t in enumerate(plain.TEXTS) if not any(map(str.isalpha, t or ""))}
    assert L.identify(plain.empty(spark)).collect() == []
    unlabelled = plain.docs(spark, [(1, "some text", None, None), (None, "more", "en", None), (1, "some text", None, None)])
    assert {(r["lang_pred"], r["score"]) for r in L.identify(unlabelled).collect()} == {("und", 0.0)}
    kept = L.accepted(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["lang_pred"] != "und"}


def test_texts_in_scripts_that_were_not_learned_are_not_accepted(spark):
    rows = [(k, "the cat and the dog were in this house", "en", 0.0, 0) for k in range(30)]
    asked = {100: "ελληνικά και άλλα λόγια", 101: "ελληνικά και άλλα λόγια with this", 102: "собака 中文 हिन्दी",
             103: "the house with ελληνικά and dogs", 104: "the dog"}
    docs = spark.createDataFrame(rows + [(i, t, None, 0.0, 0) for i, t in asked.items()], SCHEMA)
    assert {r["doc_id"] for r in L.accepted(docs).collect()} == {*range(30), 103, 104}
    labels = {r["doc_id"]: r for r in L.identify(docs).collect()}
    assert all(labels[i]["lang_pred"] == "en" and labels[i]["score"] > 0 for i in asked)


def test_learning_ignores_held_out_and_other_columns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    from pyspark.sql import functions as F

    wrong = docs.withColumn("lang", F.when(L.held_out(), F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit(None))
    a, b = (sorted((r["doc_id"], r["lang_pred"]) for r in L.identify(d).collect()) for d in (docs, wrong))
    assert a == b


def test_new_words_are_scored_in_parts(monkeypatch):
    # the grams of all new words of a batch at once took more than 100 MB a worker
    codes = L.grams(["house", "haus", "casa"], L.Alphabet())[0].tolist()
    model, asked = L.Model({"a": dict.fromkeys(codes[:6], 3), "b": dict.fromkeys(codes[4:], 2)}, {"a": {0: 9}, "b": {0: 9}}), []
    texts = ["house haus casa hau", None, "", "sa ca 12 us house", "καλα haus", "casa casa ho"]
    whole = list(L.Labeller(model).judged(texts))
    words = model.words
    monkeypatch.setattr(model, "words", lambda some, alphabet: asked.append(len(some)) or words(some, alphabet))
    monkeypatch.setattr(L, "WORDS_AT_ONCE", 2)
    assert list(L.Labeller(model).judged(texts)) == whole
    assert max(asked) == 2 and sum(asked) == len(set(" ".join(t or "" for t in texts).split()))
