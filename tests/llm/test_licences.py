import llm_plain as plain

from lakehold.llm import licences as L
from lakehold.llm.queries import op8_licence_classifier

PLANTED = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC", "Released under the MIT License.": "MIT", "All rights reserved.": "reserved",
           "This work is licensed under the GNU General Public License, version 3.": "GPL",
           "Licensed under the Apache License, Version 2.0.": "Apache-2.0"}


def test_planted_notices_are_found_and_others_left_alone(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op8_licence_classifier(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = {f for notice, f in PLANTED.items() if notice in texts[r["doc_id"]]}
        confirmed = [n for n in r["notices"] if n["confirmed"]]
        assert {n["family"] for n in confirmed} == want and r["n_confirmed"] == len(confirmed)
        assert (r["family"] in want) if want else (r["family"] is None and r["score"] == 0)
        for n in confirmed:
            assert texts[r["doc_id"]][n["start"]:n["end"]] in texts[r["doc_id"]].split("\n")


def test_held_out_variants_and_unknown_text():
    import random

    negatives = [f"Some words {i} about the house and the work of version {i}." for i in range(300)]
    model = L.fit(negatives)
    rng, right, total = random.Random(99), 0, 0
    for family, notices in L.TEMPLATES.items():
        for text in [v for n in notices for v in L._variants(n, negatives, rng, 10)]:
            p = model.probabilities(*L.Features()([text]), 1)[0]
            right += L.FAMILIES[1 + int(p[1:].argmax())] == family and 1 - p[0] >= model.least
            total += 1
    assert right >= 0.9 * total
    other = ["We took the licence plate off the car.", "The general public was free to work.", "", "1 2 3", "Nothing here is planted at all."]
    p = model.probabilities(*L.Features()(other), len(other))
    # unknown to the classifier, or not confirmed by the predicted family's templates
    for text, row in zip(other, p, strict=True):
        assert 1 - row[0] < model.least or L.template_share(text, L.FAMILIES[1 + int(row[1:].argmax())]) < L.CONFIRM
    assert sum(1 - row[0] < model.least for row in p) >= 4


def test_notices_inside_long_and_wrapped_paragraphs(spark):
    prose = " ".join(f"the house of word{i % 40} was near a river and" for i in range(17)).split(" ")[:150]
    rows, want = [], {}
    for family, notices in L.TEMPLATES.items():
        for notice in notices:
            k, words = len(want), notice.split(" ")
            rows += [(2 * k, " ".join([*prose, notice, *prose])), (2 * k + 1, "Some words\n" + "\n".join(
                " ".join(words[i:i + 4]) for i in range(0, len(words), 4)) + "\nand other words")]
            want[k] = family
    rows += [(-1, " ".join([*prose, "Released under the MIT License. All rights reserved.", *prose])), (-2, " ".join([*prose, *prose])),
             (-3, " ".join([*prose, "it was released under the name of a river and all rights of way", *prose]))]
    corpus = [(1000 + i, f"Some words {i} about the house and the work of version {i}.") for i in range(300)]
    model = L.fit([text for _, text in corpus + rows[:2]])
    texts = dict(rows)
    got = {r["doc_id"]: r for r in L.scan(plain.docs(spark, [(*r, None, None) for r in rows]), model).collect()}
    for doc, text in rows:
        found = {n["family"] for n in got[doc]["notices"] if n["confirmed"]}
        expect = {-1: {"MIT", "reserved"}, -2: set(), -3: set()}.get(doc, {want.get(doc // 2)})
        assert found == expect, text
        for n in got[doc]["notices"]:
            assert 0 <= n["start"] < n["end"] <= len(texts[doc])
            assert (n["start"] == 0 or text[n["start"] - 1] == "\n") and (n["end"] == len(text) or text[n["end"]] == "\n")


def test_defined_cases(spark):
    df = plain.docs(spark, [(1, None, None, None), (2, "", None, None), (3, "All rights reserved.", None, None), (3, "All rights reserved.", None, None),
                            (None, "x\n\nReleased under the MIT License.\nAll rights reserved.", None, None), (4, "word " * 20_000, None, None)])
    got = L.scan_corpus(df).collect()
    assert len(got) == 6
    by = {r["doc_id"]: r for r in got}
    assert (by[1]["family"], by[2]["notices"], by[4]["family"], by[3]["family"]) == (None, [], None, "reserved")
    assert [(n["paragraph"], n["start"], n["family"]) for n in by[None]["notices"]] == [(2, 3, "MIT"), (3, 35, "reserved")]
    assert L.scan_corpus(plain.empty(spark)).collect() == []
