"""Legacy archive converter: ARC version 1 and 2 files to WARC 1.1 files, and a WARC reader.

An ARC file opens with a version block whose second line names the fields of every later header
line; each record is one header line and as many bytes as its last field declares. ``from_arc``
reads such files and synthesises what WARC asks for: record ids (from archive name, offset and
date, so a rerun gives the same), ISO dates, record types and payload digests. ``write_warc``
stores payloads that occur more than once a single time; the others become ``revisit`` records.

Everything is written by Spark's own writer, so the target may be any store Spark can reach.
A WARC record ends with CR LF CR LF: that is the writer's line separator, and one record is one row.

Defined cases. Null or unparsable dates become 1970-01-01T00:00:00Z. White space and control bytes
in a URL are percent-encoded, a null URL becomes ``urn:nil``. A header line that does not parse is
skipped up to the next line. A record whose declared length passes the end of its file is kept with
what there is and marked ``truncated``. Null payloads are empty. Of equal payloads the one with the
smallest key (nulls last; ties: record id) is stored. An empty input gives no records.
"""
from __future__ import annotations

import gzip
import hashlib
import io
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakehold.llm._base import mapped, parts, slices
from lakehold.sources.scratch import materialise, new_path

# ---- fixed values of the two formats ----
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
WARC_VERSION = "WARC/1.1"
WARC_RECORD_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# ---- end of fixed values ----

KEY_HEADER = "X-Archive-Key"
NO_DATE = "1970-01-01T00:00:00Z"

RECORDS = ("record_id string, archive string, offset long, version int, url string, warc_date string, "
           "warc_type string, content_type string, key long, head binary, payload binary, payload_bytes long, "
           "payload_digest string, truncated boolean")
READ = ("record_id string, warc_type string, url string, warc_date string, key long, refers_to_id string, "
        "payload_bytes long, payload_digest string, digest_ok boolean")


# ---- ARC ----------------------------------------------------------------------------------

def _clean_url(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url) if url else "urn:nil"


def arc_bytes(name: str, version: int, stamp: str, docs: list[tuple[str | None, str, bytes]]) -> bytes:
    """One ARC file of (url, content type, block) documents."""
    body = f"{version} 0 lakehold\n{ARC_FIELDS[version]}\n".encode()
    out, at = io.BytesIO(), 0

    def put(url: str, kind: str, block: bytes) -> None:
        head = [url, "0.0.0.0", stamp, kind.replace(" ", "")]
        if version == 2:
            head += ["200", "-", "-", str(out.tell()), name]
        out.write(" ".join([*head, str(len(block))]).encode() + b"\n" + block + b"\n")

    put(f"filedesc://{name}", "text/plain", body)
    for url, kind, block in docs:
        put(_clean_url(url), kind, block)
    return out.getvalue()


def pages_to_arc(pages: DataFrame, stamp: str = "20200101000000") -> DataFrame:
    """(page_id, url, html) -> ARC files as rows (archive, content), of about 4 MB, both versions in turn.

    The page id travels as an HTTP header of the archived response. The rows are stored, gzipped, in the
    shared folder: names and offsets follow the layout of the scan, which may differ from one planning
    to the next, and record ids follow names and offsets.
    """
    def render(batches) -> Iterator[dict]:
        for n, batch in enumerate(slices(batches, "html")):
            name, docs = f"pages-{batch.column('part')[0].as_py():06d}-{n:06d}.arc.gz", []
            for key, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                payload = (html or "").encode()
                head = f"HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n"
                head += f"{KEY_HEADER}: {key}\r\n" if key is not None else ""
                docs.append((url, "text/html", head.encode() + b"\r\n" + payload))
            yield {"archive": [name], "content": [gzip.compress(arc_bytes(name, 1 + n % 2, stamp, docs), 3, mtime=0)]}

    files = mapped(pages.select(F.spark_partition_id().alias("part"), "page_id", "url", "html"), render, "archive string, content binary")
    path = new_path(pages.sparkSession, "arc")
    # rows are large: the writer looks at its buffer after each
    files.write.option("parquet.page.size.row.check.min", 1).option("parquet.block.size.row.check.min", 1).option(
        "parquet.enable.dictionary", "false").option("compression", "none").parquet(path)
    return pages.sparkSession.read.schema(files.schema).parquet(path)


def read_arc_files(spark: SparkSession, path: str) -> DataFrame:
    """ARC files below a path as rows (archive, content)."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("archive"), "content")


def parse_arc(content: bytes) -> Iterator[tuple[int, int, list[str], bytes, bool]]:
    """(offset, version, header fields, block, truncated) of every record but the version block."""
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    version, at, end = 1, 0, len(content)
    while at < end:
        if content[at] in b"\r\n":  # what separates a block from the next header
            at += 1
            continue
        stop = content.find(b"\n", at)
        if stop < 0:
            return
        line = content[at:stop].decode("utf-8", "replace").rstrip("\r")
        described = line.startswith("filedesc:")
        fields = line.split(" ") if described else line.rsplit(" ", len(ARC_FIELDS[version].split(" ")) - 1)
        if not fields[-1].isdigit() or len(fields) < 5:
            at = stop + 1
            continue
        length = int(fields[-1])
        block = content[stop + 1:stop + 1 + length]
        if described:
            named = block.split(b" ", 1)[0]
            version = int(named) if named.isdigit() and int(named) in ARC_FIELDS else version
        else:
            yield at, version, fields, block, len(block) < length
        at = stop + 1 + length


def _iso(date: str) -> str:
    d = (date + "00000000000000")[:14] if date.isdigit() and len(date) >= 8 else ""
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:]}Z" if d else NO_DATE


def _key(head: bytes) -> int | None:
    m = re.search(rb"(?mi)^" + KEY_HEADER.encode() + rb":\s*(-?\d+)\s*$", head)
    return int(m[1]) if m else None


def _record_id(*named: object) -> str:
    x = hashlib.sha256("\n".join(map(str, named)).encode()).hexdigest()
    return f"urn:uuid:{x[:8]}-{x[8:12]}-8{x[13:16]}-a{x[17:20]}-{x[20:32]}"


def from_arc(arcs: DataFrame) -> DataFrame:
    """Rows (archive, content) -> one row per archived document, with its WARC fields (see RECORDS)."""
    names = [f.split(" ")[0] for f in RECORDS.split(", ")]

    def convert(batches) -> Iterator[dict]:
        for batch in batches:
            for archive, content in zip(batch.column("archive").to_pylist(), batch.column("content"), strict=True):
                rows = []
                for offset, version, f, block, cut in parse_arc(content.as_py() or b""):
                    url, kind, iso = f[0], f[3], _iso(f[2])
                    http = block.startswith(b"HTTP/")
                    ends = re.search(rb"\r?\n\r?\n", block) if http else None
                    head, payload = (block[:ends.end()], block[ends.end():]) if ends else (b"", block)
                    rows.append((_record_id(archive, offset, url, f[2]), archive, offset, version, url, iso,
                                 "response" if http else "resource",
                                 "application/http; msgtype=response" if http else kind, _key(head), head, payload,
                                 len(payload), hashlib.sha256(payload).hexdigest(), cut))
                if rows:
                    yield dict(zip(names, map(list, zip(*rows, strict=True)), strict=True))

    return mapped(arcs.select("archive", "content"), convert, RECORDS)


# ---- WARC ---------------------------------------------------------------------------------

def write_warc(records: DataFrame, path: str, min_revisit_bytes: int = 100, file_bytes: int = 16 << 20) -> None:
    """Write records (see RECORDS) as gzipped WARC files of about ``file_bytes`` uncompressed.

    Only ids and digests are grouped; payloads move once, by their unique record id, so neither a
    payload shared by a third of all records nor a long one gathers in one task.
    """
    meta = materialise(records.select("record_id", "key", "url", "warc_date", "warc_type", "payload_digest",
                                      "payload_bytes"), "warc-meta")
    can = meta.where((F.col("payload_bytes") >= min_revisit_bytes) & (F.col("warc_type") == "response"))
    first = can.groupBy("payload_digest").agg(
        F.min(F.struct(F.col("key").isNull().alias("none"), "key", "record_id", "url", "warc_date")).alias("first"),
        F.count(F.lit(1)).alias("n")).where("n > 1")
    again = can.select("record_id", "payload_digest").join(first, "payload_digest").where(
        "record_id <> first.record_id").select(
        "record_id", F.col("first.record_id").alias("to_id"), F.col("first.url").alias("to_url"),
        F.col("first.warc_date").alias("to_date"))
    n = parts(meta.agg(F.sum("payload_bytes")).first()[0] or 0, file_bytes)
    columns = ["record_id", "url", "warc_date", "warc_type", "content_type", "payload_digest", "head", "payload"]
    rows = records.select(*columns).repartition(n, "record_id").join(again, "record_id", "left")

    def render(batches) -> Iterator[dict]:
        for batch in slices(batches, "payload"):
            out = []
            for r in batch.to_pylist():
                kind = "revisit" if r["to_id"] else r["warc_type"]
                block = r["head"] if r["to_id"] else r["head"] + r["payload"]
                lines = [WARC_VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: <{r['record_id']}>",
                         f"WARC-Date: {r['warc_date']}", f"WARC-Target-URI: {r['url']}",
                         f"WARC-Payload-Digest: sha256:{r['payload_digest']}"]
                if r["to_id"]:
                    lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{r['to_id']}>",
                              f"WARC-Refers-To-Target-URI: {r['to_url']}", f"WARC-Refers-To-Date: {r['to_date']}"]
                lines += [f"Content-Type: {r['content_type']}", f"Content-Length: {len(block)}"]
                out.append("\r\n".join(lines).encode() + b"\r\n\r\n" + block)
            yield {"record": out}

    # the cast keeps the bytes as they are; the text writer puts them out unchanged
    mapped(rows, render, "record binary").select(F.col("record").cast("string").alias("value")).write.option(
        "lineSep", WARC_RECORD_END).option("compression", "gzip").text(path)


def parse_warc(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of every record of an uncompressed stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        yield headers, stream.read(int(headers.get("content-length", 0)))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the WARC files below ``path`` (see READ).

    Length and digest of a stored payload are taken from its bytes; a revisit has its header's
    digest, and no length of its own.
    """
    names = [f.split(" ")[0] for f in READ.split(", ")]

    def read(batches) -> Iterator[dict]:
        for batch in batches:
            for content in batch.column("content"):
                data = content.as_buffer()
                stream = io.BytesIO(data) if data is not None else io.BytesIO()
                zipped = stream.getvalue()[:2] == b"\x1f\x8b"
                rows = []
                for h, block in parse_warc(gzip.GzipFile(fileobj=stream) if zipped else stream):
                    ends = re.search(rb"\r?\n\r?\n", block) if block.startswith(b"HTTP/") else None
                    head, payload = (block[:ends.end()], block[ends.end():]) if ends else (b"", block)
                    kind, said = h.get("warc-type"), h.get("warc-payload-digest", "").removeprefix("sha256:")
                    stored = kind != "revisit"
                    digest = hashlib.sha256(payload).hexdigest() if stored else said
                    rows.append((h.get("warc-record-id", "").strip("<>"), kind, h.get("warc-target-uri"),
                                 h.get("warc-date"), _key(head), h.get("warc-refers-to", "").strip("<>") or None,
                                 len(payload) if stored else None, digest, digest == said))
                if rows:
                    yield dict(zip(names, map(list, zip(*rows, strict=True)), strict=True))

    return mapped(spark.read.format("binaryFile").load(path).select("content"), read, READ)


def resolve_revisits(read: DataFrame) -> DataFrame:
    """Give revisits the key and payload length of the record they refer to."""
    stored = read.where("warc_type <> 'revisit'").select(
        F.col("record_id").alias("refers_to_id"), F.col("key").alias("refers_to"), F.col("payload_bytes").alias("full"))
    return read.join(stored, "refers_to_id", "left").withColumn(
        "payload_bytes", F.coalesce("payload_bytes", "full")).drop("full")
