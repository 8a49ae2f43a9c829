import gzip
import hashlib
import io

import pytest

from lakehold.llm import arc_warc as A

PAGES = "page_id long, url string, html string, record_id string, key int"


def result(spark, pages, tmp_path):
    path = str(tmp_path / "warc")
    A.write_warc(A.from_arc(A.pages_to_arc(pages)), path)
    return path, {r["key"]: r for r in A.resolve_revisits(A.read_warc(spark, path)).collect()}


def test_pages_through_both_formats(spark, tmp_path):
    long = "é☃ html " * 40
    rows = [(5, "http://a.example/x y", long), (3, "http://a.example/é", long), (9, None, long), (4, "u://b", "short"),
            (1, "u://b", "short"), (7, "http://c/", None), (8, "http://d/", ""), (10, "http://e/", "z" * 3_000_000),
            (11, "http://f/", "<p>\r\n\r\nWARC/1.1\r\n\r\n</p>" * 10)]
    path, got = result(spark, spark.createDataFrame([(*r, "x", 0) for r in rows], PAGES), tmp_path)
    assert len(got) == len(rows)
    for page, _, html in rows:
        data, r = (html or "").encode(), got[page]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), hashlib.sha256(data).hexdigest())
        revisit = html == long and page != 3
        assert (r["warc_type"], r["refers_to"]) == (("revisit", 3) if revisit else ("response", None))
        assert r["digest_ok"]
    assert got[5]["url"] == "http://a.example/x%20y"


def test_files_are_warc(spark, tmp_path):
    path, _ = result(spark, spark.createDataFrame([(1, "http://a/", "x" * 200, "", 0), (2, "http://b/", "x" * 200, "", 0)], PAGES), tmp_path)
    data = b"".join(gzip.decompress(f["content"]) for f in spark.read.format("binaryFile").load(path).collect())
    records = list(A.parse_warc(io.BytesIO(data)))
    assert [h["warc-type"] for h, _ in sorted(records, key=lambda r: r[0]["warc-target-uri"])] == ["response", "revisit"]
    first, again = sorted(records, key=lambda r: r[0]["warc-target-uri"])
    assert again[0]["warc-refers-to"] == first[0]["warc-record-id"] and again[0]["warc-profile"].endswith("identical-payload-digest")
    assert first[1].endswith(b"\r\n\r\n" + b"x" * 200) and again[1].endswith(b"\r\n\r\n")


def test_empty_table_and_null_keys(spark, tmp_path):
    _, got = result(spark, spark.createDataFrame([], PAGES), tmp_path / "a")
    assert got == {}
    path = str(tmp_path / "b")
    A.write_warc(A.from_arc(A.pages_to_arc(spark.createDataFrame([(None, None, "y" * 300, "", 0), (2, None, "y" * 300, "", 0)], PAGES))), path)
    got = A.resolve_revisits(A.read_warc(spark, path)).collect()
    assert sorted((r["warc_type"], r["key"], r["refers_to"]) for r in got) == [("response", 2, None), ("revisit", None, 2)]


def test_another_layout_of_the_scan_changes_no_id(spark, tmp_path):
    """The scan is split anew between the two passes over the records, as when executors come or go."""
    source = str(tmp_path / "pages")
    spark.createDataFrame([(i, f"http://a/{i}", "y" * 300, "", 0) for i in range(40)], PAGES).repartition(4).write.parquet(source)
    size, cost = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    old = {k: spark.conf.get(k) for k in (size, cost)}
    pages = spark.read.parquet(source)
    records = A.from_arc(A.pages_to_arc(pages))
    seen = []
    try:
        for n in ("128m", "1k"):
            spark.conf.set(size, n)
            spark.conf.set(cost, n)
            seen.append(sorted(r["record_id"] for r in records.select("record_id").collect()))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert seen[0] == seen[1] and len(set(seen[0])) == 40


def test_repeated_pages(spark, tmp_path):
    path = str(tmp_path / "w")
    A.write_warc(A.from_arc(A.pages_to_arc(spark.createDataFrame([(2, "http://a/", "y" * 300, "", 0)] * 3, PAGES))), path)
    got = A.resolve_revisits(A.read_warc(spark, path)).collect()
    assert sorted((r["warc_type"], r["refers_to"]) for r in got) == [("response", None), ("revisit", 2), ("revisit", 2)]


@pytest.mark.parametrize("version", [1, 2])
def test_foreign_archives(spark, tmp_path, version):
    """dns records, plain blocks, damaged lines, a short last record; plain and gzipped."""
    docs = [("dns:a.example", "text/dns", b"20200101 a 1.2.3.4"), ("http://a/", "text/html", b"HTTP/1.0 200 OK\nX: 1\n\nbody\n"),
            ("ftp://b/", "text/plain", b"\n\nplain"), ("http://c/", "text/html", b"HTTP/1.1 404 no\r\n\r\n")]
    data = A.arc_bytes("x.arc", version, "19991231235959", docs)
    damaged = data.replace(b"\nftp://b/", b"\nnot a header line\nftp://b/", 1) + b"http://late/ 0.0.0.0 2001 text/html 100\nhalf"
    folder = tmp_path / "arc"
    folder.mkdir()
    (folder / "x.arc").write_bytes(damaged)
    (folder / "y.arc.gz").write_bytes(gzip.compress(data))
    rows = A.from_arc(A.read_arc_files(spark, str(folder))).collect()
    assert len({r["record_id"] for r in rows}) == len(rows)
    plain = [r for r in rows if r["archive"].endswith("x.arc")]
    want = [("dns:a.example", "resource", 18), ("http://a/", "response", 5), ("ftp://b/", "resource", 7), ("http://c/", "response", 0)]
    assert [(r["url"], r["warc_type"], r["payload_bytes"]) for r in plain][:4] == want
    assert {r["warc_date"] for r in plain[:4]} == {"1999-12-31T23:59:59Z"}
    assert [r["truncated"] for r in plain[:4]] == [False] * 4
    if version == 1:  # the late line is one of version 1
        assert (plain[4]["truncated"], plain[4]["payload"], plain[4]["warc_date"]) == (True, b"half", A.NO_DATE)
    assert [(r["url"], r["warc_type"], r["payload_bytes"]) for r in rows if r["archive"].endswith("gz")] == want


def test_query_matches_plain_python(spark):
    from lakehold.llm.queries import op1_arc_to_warc

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    got = {r["page_id"]: r for r in op1_arc_to_warc(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(pages)
    assert all(got[p["page_id"]]["payload_digest"] == hashlib.sha256((p["html"] or "").encode()).hexdigest() for p in pages)
