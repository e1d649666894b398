"""WARC derivatives: metadata and plain-text conversion records of responses.

A response record is (record_id, target_uri, date, http, block): its id, the
source headers, and the HTTP message as bytes. Each response gives

* a ``metadata`` record (``application/warc-fields``): title, language,
  character set, the response's HTTP headers, its digests and one ``outlink``
  line per link, resolved against the target URI;
* a ``conversion`` record (``text/plain``): the visible text.

Both refer to the response (``WARC-Refers-To``), repeat its target URI and
date, and carry the digest of their own block and of the response's payload.
Ids are name-based, so a task that runs again makes the same records; equal
responses have equal ids. ``record`` is the record as WARC/1.1 bytes.

Defined results: null html is an empty payload, its conversion record has an
empty block; a null url gives records without ``WARC-Target-URI`` and leaves
links as written; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import html as htmllib
import re
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, whole_text
from .wrappers import INLINE, TOKEN

DATE = "1970-01-01T00:00:00Z"  # of responses that bring none
CRLF = "\r\n"
CONTROL = re.compile(r"[\x00-\x1f\x7f]")
LINK = re.compile(r"\b(href|src)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
LANG = re.compile(r"\blang\s*=\s*[\"']?([A-Za-z0-9-]+)", re.I)
CHARSET = re.compile(r"\bcharset\s*=\s*[\"']?([A-Za-z0-9_:.-]+)", re.I)

RECORDS = ("page_id long, record_type string, record_id string, refers_to string, target_uri string, date string, "
           "content_type string, content_length long, block_digest string, source_digest string, block string, record binary")


def record_uuid(*parts: Column) -> Column:
    """urn:uuid of a name (version 5 layout over an MD5 of the parts)."""
    h = F.md5(F.concat_ws("\x01", *[F.coalesce(p.cast("string"), F.lit("\x02")) for p in parts]))
    return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3),
                    F.lit("-a"), F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12), F.lit(">"))


def _uuid(name: str) -> str:
    h = hashlib.md5(name.encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-5{h[13:16]}-a{h[17:20]}-{h[20:32]}>"


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Response records (page_id, record_id, target_uri, date, block) of pages."""
    payload = F.encode(whole_text(F.col("html")), "UTF-8")
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.octet_length(payload).cast("string"), F.lit(CRLF * 2))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), record_uuid(F.lit("response"), F.col("page_id"), F.col("url"), F.sha2(payload, 256))
        .alias("record_id"), F.col("url").cast("string").alias("target_uri"), F.lit(date).alias("date"),
        F.concat(F.encode(head, "UTF-8"), payload).alias("block"))


def split_http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and payload of an HTTP message."""
    head, _, payload = block.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split(CRLF)
    return lines[0], [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in lines[1:] if x)], payload


def convert(page: str, base: str | None) -> tuple[str, dict[str, str], list[tuple[str, str]]]:
    """Visible text, facts (title, language, charset) and links (uri, how) of a page."""
    blocks: list[str] = []
    run: list[str] = []
    facts: dict[str, str] = {}
    links: list[tuple[str, str]] = []

    def flush():
        if run:
            text = " ".join(htmllib.unescape("".join(run)).split())
            run.clear()
            if text:
                blocks.append(text)

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            run.append(page[at:m.start()])
        at = m.end()
        raw = (m.group(1) or "").lower()
        if raw:
            if raw == "title" and "title" not in facts:
                inner = m.group(0)
                facts["title"] = " ".join(htmllib.unescape(inner[inner.find(">") + 1:inner.rfind("<")]).split())
            continue
        name = (m.group(3) or "").lower()
        if not name:
            continue
        if name not in INLINE or name == "br":
            flush()
        if not m.group(2) and m.group(4):
            if name == "html" and (x := LANG.search(m.group(4))):
                facts["language"] = x.group(1)
            elif name == "meta" and (x := CHARSET.search(m.group(4))):
                facts["charset"] = x.group(1)
            if name in ("a", "img", "link", "area", "iframe", "source", "script"):
                for k, v in LINK.findall(m.group(4)):
                    uri = htmllib.unescape(v.strip("\"'")).strip()
                    if uri:
                        try:
                            uri = urljoin(base, uri) if base else uri
                        except ValueError:
                            pass  # not a URI reference: kept as written
                        links.append(("".join(uri.split()), f"{name}/@{k.lower()}"))
    if at < len(page):
        run.append(page[at:])
    flush()
    return "\n".join(blocks), facts, links


def safe(value: str) -> str:
    """A field's name or value with control characters percent-encoded, so that it stays one line."""
    return CONTROL.sub(lambda m: f"%{ord(m.group()):02X}", value)


def serialise(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A record as WARC/1.1 bytes; fields without a value are left out, control characters in values are percent-encoded."""
    head = "".join(f"{k}: {safe(v)}{CRLF}" for k, v in fields if v is not None)
    return f"WARC/1.1{CRLF}{head}{CRLF}".encode() + block + b"\r\n\r\n"


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Fields and block of a serialised record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split(CRLF)
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k: v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    return fields, rest[:int(fields["Content-Length"])]


def derive(page_id, record_id: str, uri: str | None, date: str, block: bytes) -> list[tuple]:
    """The metadata and the conversion record of one response."""
    uri = uri if uri is None else safe(uri)
    status, headers, payload = split_http(block)
    source = "sha256:" + hashlib.sha256(payload).hexdigest()
    charset = next((x.group(1) for k, v in headers if k.lower() == "content-type" and (x := CHARSET.search(v))), "utf-8")
    try:
        page = payload.decode(charset, "replace")
    except LookupError:
        page = payload.decode("utf-8", "replace")
    text, facts, links = convert(page, uri)
    told = [("source-status", status), *[(f"source-header-{k.lower()}", v) for k, v in headers], ("source-payload-digest", source),
            ("source-block-digest", "sha256:" + hashlib.sha256(block).hexdigest()), ("source-payload-length", str(len(payload))),
            *facts.items(), *[("outlink", f"{u} L {how}") for u, how in links]]
    out = []
    for kind, content, body in (("metadata", "application/warc-fields", "".join(f"{safe(k)}: {safe(v)}{CRLF}" for k, v in told)),
                                ("conversion", "text/plain; charset=utf-8", text)):
        raw = body.encode("utf-8", "replace")
        own = _uuid(f"{kind}\x01{record_id}")
        digest = "sha256:" + hashlib.sha256(raw).hexdigest()
        record = serialise([("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Date", date), ("WARC-Target-URI", uri),
                            ("WARC-Refers-To", record_id), ("WARC-Block-Digest", digest), ("WARC-Source-Payload-Digest", source),
                            ("Content-Type", content), ("Content-Length", str(len(raw)))], raw)
        out.append((page_id, kind, own, record_id, uri, date, content, len(raw), digest, source, body, record))
    return out


def derivatives(records: DataFrame) -> DataFrame:
    """Metadata and conversion records of response records."""
    ship(records.sparkSession)
    names = [x.split()[0] for x in RECORDS.split(", ")]
    kinds = [pa.int64(), *[pa.string()] * 6, pa.int64(), *[pa.string()] * 3, pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                rows = [r for x in zip(*[c.to_pylist() for c in part.columns], strict=True) for r in derive(*x)]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    return records.select("page_id", "record_id", "target_uri", "date", "block").mapInArrow(run, RECORDS)
