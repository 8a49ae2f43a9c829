import random

import llm_plain as plain
import pytest

from lakehold.llm import redirects as R
from lakehold.llm._graph import components
from lakehold.llm.queries import RULES, op5_redirect_equivalence

PAGES = "page_id long, url string, html string, host string, component string"


def link(href):
    return f"<html><head><link href='{href}' rel=canonical></head></html>"


def refresh(url):
    return f'<meta content="0; URL={url}" http-equiv="refresh">'


def judged(spark, rows, rules=RULES):
    return {r["page_id"]: r for r in R.judge(spark.createDataFrame([(*r, "h", "c") for r in rows], PAGES), rules).collect()}


def plain_rule(host, path, rules):
    fit = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    return max(fit, key=lambda r: len(r[1] + r[2]), default=None)


def test_hosts_paths_and_rules(spark):
    urls = ["http://WWW.Example.com/en/x?y#z", "https://example.com/en/", "example.com/en/", None, "http://example.com", "u://net/es/a://b",
            "http://notnet/es/", "http://a.net?/es/", "http://a.net#/fr/", "http://m.example.com/en", "http://A.NET/fr/q", "://x", "", "É://É.com/É"]
    got = judged(spark, [(i, u, None) for i, u in enumerate(urls)])
    for i, u in enumerate(urls):
        rest = (u or "").partition("://")[2] if "://" in (u or "") else ""
        host = rest.split("/")[0].split("?")[0].split("#")[0]
        path = rest[len(host):].split("?")[0].split("#")[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
        rule = plain_rule(host, path, RULES)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule and rule[1] + rule[2]), u
        assert got[i]["verdict"] == (rule[0] if rule else "allow")


def test_blocks_reach_aliases_and_allow_comes_first(spark):
    rules = [("block", "bad.org", "/"), ("allow", "good.org", "/")]
    got = judged(spark, [
        (1, "http://bad.org/a", None), (2, "http://x.org/a", link("http://bad.org/a")),  # an alias of a blocked page
        (3, "http://x.org/b", refresh("http://x.org/a")), (4, "https://x.org/b/?utm_source=q#f", None),  # and its aliases
        (5, "http://good.org/p", link("http://bad.org/z")),  # allowed itself, though it points to a blocked one
        (6, "http://y.org/", refresh("/q")), (7, "http://y.org/q.html", link("//bad.org/q")), (8, "http://y.org/r", None),
        (9, "http://z.org/1", link("http://bad.org/2")), (10, "http://z.org/1", refresh("http://good.org/3")),  # both: allow
        (11, "http://y.org/d/e", refresh("f")), (12, "http://y.org/d/f", link("http://bad.org/")), (13, None, link("http://bad.org/"))], rules)
    assert {i: r["verdict"] for i, r in got.items()} == {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "block", 7: "block",
                                                         8: "allow", 9: "allow", 10: "allow", 11: "block", 12: "block", 13: "allow"}


LINKS = [
    (link("/login?next=http://bad.org/"), "allow"), (link("../c"), "block"), (link("./../d/../c"), "block"), (link("?p=2"), "block"),
    ("<!-- " + link("http://bad.org/") + " -->", "allow"), ("<!-- open " + link("http://bad.org/"), "allow"),
    ("<base href='http://bad.org/x/'>" + link("y"), "block"), (link("#part"), "allow"), (link("mailto:a@bad.org"), "allow"),
    (link("http:/c"), "allow"), (refresh("../c"), "block"), (link("/../../c"), "block"), (link("HTTP://BAD.ORG/q"), "block"),
    ("x" * 200_000 + link("//bad.org/q"), "block"), (None, "allow"), ("", "allow")]


@pytest.mark.parametrize("spellings", [True, False])
def test_links_resolve(spark, spellings):
    """Each case on a host of its own, whose ``/c`` is blocked and has the alias ``/a/b?p=2``."""
    rules = [("block", "bad.org", "/")] + [("block", f"x{i}.org", "/c") for i in range(len(LINKS))]
    rows = [(i, f"http://x{i}.org/a/b", html, "h", "c") for i, (html, _) in enumerate(LINKS)]
    rows += [(100 + i, f"http://x{i}.org/a/b?p=2", link("/c"), "h", "c") for i in range(len(LINKS))]
    got = {r["page_id"]: r["verdict"] for r in R.judge(spark.createDataFrame(rows, PAGES), rules, spellings).collect()}
    assert got == {i: verdict for i, (_, verdict) in enumerate(LINKS)} | {100 + i: "block" for i in range(len(LINKS))}


RESOLVED = [
    ("http://a/b/c/d?q", "g", "http://a/b/c/g"), ("http://a/b/c/d?q", "./g/", "http://a/b/c/g/"), ("http://a/b/c/d?q", "/g", "http://a/g"),
    ("http://a/b/c/d?q", "//g", "http://g"), ("http://a/b/c/d?q", "?y", "http://a/b/c/d?y"), ("http://a/b/c/d?q", "g?y/./x", "http://a/b/c/g?y/./x"),
    ("http://a/b/c/d?q", ".", "http://a/b/c/"), ("http://a/b/c/d?q", "../..", "http://a/"), ("http://a/b/c/d?q", "../../../g", "http://a/g"),
    ("http://a/b/c/d?q", "g#s/../x", "http://a/b/c/g#s/../x"), ("http://a", "g", "http://a/g"), ("http://a/b", "..g", "http://a/..g"),
    ("http://a/b/c", "", None), (None, "g", None), ("http://a/b", None, None)]


def test_resolved(spark):
    df = spark.createDataFrame(RESOLVED, "base string, link string, url string")
    got = df.select("*", R.resolved(df["base"], df["link"]).alias("got")).collect()
    assert [(r["base"], r["link"], r["got"]) for r in got] == [(r["base"], r["link"], r["url"]) for r in got]


def test_table_with_links_against_brute_force(spark):
    rng = random.Random(5)
    rules = [("block", "bad.org", "/"), ("allow", "good.org", "/")]
    host = lambda: rng.choice(["bad.org", "good.org", *[f"h{i}.org" for i in range(30)]])
    rows = [(i, f"http://{host()}/{rng.randrange(40)}", "") for i in range(600)]
    rows = [(i, u, rng.choice([link, refresh])(rng.choice(rows)[1]) if rng.random() < 0.4 else None) for i, u, _ in rows]
    edges = [(u, html.split("'")[1] if "'" in html else html.split("URL=")[1].split('"')[0]) for _, u, html in rows if html]
    of = plain.components({x for e in edges for x in e}, edges)
    own = {u: rule[0] for u in {*[r[1] for r in rows], *[v for e in edges for v in e]} if (rule := plain_rule(u.split("/")[2], "/", rules))}
    said = {}
    for u, verdict in own.items():
        said.setdefault(of.get(u, u), set()).add(verdict)
    expect = {}
    for i, u, _ in rows:
        found = said.get(of.get(u, u), set())
        expect[i] = own.get(u) or ("allow" if "allow" in found or not found else "block")
    pages = spark.createDataFrame([(*r, "h", "c") for r in rows], PAGES)
    got = {r["page_id"]: r["verdict"] for r in R.judge(pages, rules, spellings=False).collect()}
    assert got == expect
    assert sum(got[i] == "block" and u not in own for i, u, _ in rows) > 5  # by their aliases alone


def test_empty_and_repeated(spark):
    assert judged(spark, []) == {}
    rows = R.judge(spark.createDataFrame([(1, "http://a.net/es/", "", "", "")] * 3 + [(None, None, None, None, None)], PAGES), RULES).collect()
    assert sorted((r["page_id"] or 0, r["verdict"]) for r in rows) == [(0, "allow")] + [(1, "block")] * 3


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 200)], [(i, 500) for i in range(50)] + [(600, 601), (601, 600)],
    [(i * 7 % 101, i * 13 % 101) for i in range(80)], [(None, 3), (4, 5)]])
def test_components(spark, edges):
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    assert got == plain.components({x for e in real for x in e}, real)


def test_query_against_plain_rules(spark):
    rows = op5_redirect_equivalence(spark, "/root/testdata/sf0.01").collect()
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        rule = plain_rule(r["host"], r["path"], RULES)
        assert r["rule"] == (rule and rule[1] + rule[2]) and (rule is None or r["verdict"] == rule[0])
