import collections
import hashlib
import math
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from llm_plain import TEXTS, docs, empty

from lakehold.llm import disclosure as ds

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
            "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def fine(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m.split(".")),
            "card": lambda: 14 <= len(d) <= 19 and luhn(d), "phone": lambda: 10 <= len(d) <= 15}[kind]()


def plain_base(text):
    """Sorted (start, kind number, end)."""
    return sorted((m.start(), i, m.end()) for i, (k, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if fine(k, m.group()))


def plain_scan(rows, window=8, support=3, generalise_at=0.85, remove_at=0.95):
    """Spans of every row, with statistics over all distinct texts by plain counting."""
    texts = {t or "" for _, t, *_ in rows}
    anything = "|".join(f"(?:{PATTERNS[k]})" for k in ("email", "phone", "ip", "card"))

    def contexts(text):
        found, ends = list(re.finditer(anything, text)), []
        for i, m in enumerate(found):
            v = m.group()
            kind = "email" if "@" in v else "phone" if v[0] == "+" else "ip" if re.fullmatch(PATTERNS["ip"], v) else "card"
            if not fine(kind, v):
                continue
            lo, hi = found[i - 1].end() if i else 0, found[i + 1].start() if i + 1 < len(found) else len(text)
            words = [w for w in re.finditer(r"[^\W\d_]+", text) if len(w.group()) >= 3]
            left = [w for w in words if lo <= w.start() and w.end() <= m.start()][-window:]
            right = [w for w in words if m.end() <= w.start() and w.end() <= hi][:window]
            ends.append((f"{kind}:{v.lower() if kind in ('email', 'ip') else re.sub('[^0-9]', '', v)}", left + right))
        return ends

    of = {t: contexts(t) for t in texts}
    df_e = collections.Counter(e for t in texts for e in {e for e, w in of[t] if w})
    df_te = collections.Counter(p for t in texts for p in {(e, w.group().lower()) for e, ws in of[t] for w in ws})
    df_t = collections.Counter(w for t in texts for w in set(re.findall(r"[^\W\d_]+", t.lower())))
    n, share = len(texts), {}
    for (e, w), k in df_te.items():
        if k >= support and df_e[e] < n:
            share[e, w] = math.log2(k * n / (df_t[w] * df_e[e])) / math.log2(n / df_e[e])
    out = []
    for _, t, *_ in rows:
        extra = {}
        for e, ws in of[t or ""]:
            for w in ws:
                if (s := share.get((e, w.group().lower()), 0)) >= generalise_at - 1e-12:
                    extra[w.start(), w.end()] = min(extra.get((w.start(), w.end()), 9), 4 if s >= remove_at - 1e-12 else 5)
        out.append(sorted(plain_base(t) + [(s, k, e) for (s, e), k in extra.items()]))
    return out


def got(df):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, [tuple(s) for s in r["spans"]], [tuple(s) for s in r["base"]]) for r in df.collect())


ODD = ["a@b.c", "x.y%z+1@a-b.co.uk_c@d.e", "@b.c a@.c a@b a@b..c", "a@b.com%x@y.com@z.org", "1.2.3.4.5.6.7.8", "1.2.3.256 001.02.3.0255 1..2.3.4",
       "4111 1111 1111 1111 and 4111-1111-1111-1112", "41111111111111111111111111", "45241322646528 6", "+1 (386) 555-3733.", "+1 386", "++1 3865553733--",
       "+1234567890123456", "+12 (((( 3", "ﬁ é☃ 4111111111111111 \U0001f600 a@b.cd", "4111 1111 1111 1111 4@x.com", "+1 4111 1111 1111 1111", "1" * 3000, "a" * 3000,
       "9." * 2000, "a@b" + ".c" * 3000, "1 " * 3000, "+1" + "(" * 3000, "a.b@" * 1500, " ".join(f"u{i}@h{i}.org" for i in range(700))]


def test_base_spans_equal_plain_matching(spark):
    rows = [(i, t, None, None) for i, t in enumerate([*ODD, *TEXTS])]
    found = {r["doc_id"]: [tuple(s) for s in r["base"]] for r in ds.find(docs(spark, rows)).collect()}
    assert found == {i: plain_base(t) for i, t, *_ in rows}


@settings(max_examples=12, deadline=None)
@given(st.lists(st.text("a1@.+- ()9_é\n", max_size=60), min_size=20, max_size=60))
def test_base_spans_on_random_texts(spark, texts):
    texts = [t.replace("9", "4111 1111 1111 1111").replace("(", "+1 386 555 3733 ") for t in texts]
    rows = [(i, t, None, None) for i, t in enumerate(texts)]
    found = {r["doc_id"]: [tuple(s) for s in r["base"]] for r in ds.find(docs(spark, rows)).collect()}
    assert found == {i: plain_base(t) for i, t, *_ in rows}


def corpus():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdeé") for _ in range(5)) for _ in range(60)]
    rows = []
    for i in range(200):
        text = " ".join(rng.choice(words) for _ in range(40))
        if i % 10 == 0:  # Zorblatt stands near this address only, Quimby mostly
            text += " Doctor Zorblatt and quimby write from zor@example.com, or call."
        if i % 40 == 1:
            text += " quimby was here"
        if i % 25 == 2:
            text += f" reach person number at u{i}@example.org today"
        rows.append((i, text, None, None))
    rows += [(300 + i, "copy with hapaxword near same@example.net", None, None) for i in range(20)]  # copies are no evidence
    rows += [(None, rows[0][1], None, None), (5, "Zorblatt alone", None, None), (0, rows[10][1], None, None), (400, None, None, None),
             (401, "4111 1111 1111 1111 4@x.com.", None, None)]
    return rows


def test_disclosing_terms_equal_plain_counting(spark):
    rows = corpus()
    want = plain_scan(rows)
    assert got(ds.scan(docs(spark, rows))) == sorted((d is None, d or 0, s, plain_base(t)) for (d, t, *_), s in zip(rows, want, strict=True))
    marked = {(t or "")[a:b] for (_, t, *_), s in zip(rows, want, strict=True) for a, k, b in s if k >= 4}
    assert "Zorblatt" in marked and "hapaxword" not in marked
    assert all(not s for (_, t, *_), s in zip(rows, want, strict=True) if "@" not in (t or ""))  # clean documents stay


def test_sanitised_texts(spark):
    rows = corpus()
    out = ds.sanitised(docs(spark, rows))
    assert out.columns == docs(spark, rows).columns and out.count() == len(rows)
    text = {r["doc_id"]: r["text"] for r in out.where("doc_id in (10, 5, 300, 400, 401)").collect()}
    assert "zor@example.com" not in text[10] and "Zorblatt" not in text[10] and "<email>" in text[10]
    assert text[5] is not None and text[300] == "copy with hapaxword near <email>" and text[400] is None
    assert text[401] == "4111 1111 1111 1111 <email>."
    whole = ds.sanitised(docs(spark, [(1, "4111 1111 1111 1111@x.com.", None, None)])).first()["text"]
    assert whole == "<card>."


def test_report_and_defined_cases(spark):
    rows = [(i, t, None, None) for i, t in enumerate([*ODD, None, "", "a@b.c a@b.c"])] + [(1, "a@b.c", None, None)] * 2 + [(None, "a@b.c", None, None)] * 2
    out = ds.report(docs(spark, rows)).collect()
    assert len(out) == len(rows)
    names = [*PATTERNS]
    want = collections.Counter()
    for d, t, *_ in rows:
        base = plain_base(t)
        n = collections.Counter(k for _, k, _ in base)
        text = ",".join(f"{names[k]}:{s}:{e}" for s, k, e in base)
        want[d, n[0], n[1], n[2], n[3], hashlib.sha256(text.encode()).hexdigest()] += 1
    assert collections.Counter((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in out) == want


def test_empty_table(spark):
    assert ds.report(empty(spark)).collect() == []
    assert ds.sanitised(empty(spark)).collect() == []


def test_no_python_in_the_plan(spark):
    from lakehold.llm.queries import op11_disclosure

    plan = op11_disclosure(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
