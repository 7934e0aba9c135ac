"""WARC derivatives: metadata and plain-text conversion records (operator 7).

Every response record becomes two records that refer to it: a ``metadata``
record with a JSON description (the response's own headers, its HTTP status
line and headers, digests, title and links) and a ``conversion`` record with
the page's plain text.  Both carry WARC-Refers-To (with target URI and date)
and a block digest; record ids are UUIDs derived from the response's id and
the record's type, so that a rerun gives the same ids.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html as entities
import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches
from .html_extract import parse

RECORD = "record_id string, warc_type string, target_uri string, headers array<struct<name:string,value:string>>, " \
         "block binary"
HEADERS = pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))
CRLF = b"\r\n"
#: capture date of responses made from a page table, which has none
PAGE_DATE = "2024-01-01T00:00:00Z"
#: bytes of blocks in one batch of records read, about
BATCH = 16 << 20


def digest(data: bytes) -> str:
    """Labelled digest as WARC files write it: SHA-1 in base 32."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def derived_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join(parts))}>"


def serialize(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record as it stands in a file."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers)]
    return "\r\n".join(lines).encode() + CRLF * 2 + block + CRLF * 2


def _lines(f: io.BufferedIOBase) -> Iterator[bytes]:
    """Lines up to a blank one; nothing if the file ends before it."""
    lines = []
    while (line := f.readline()) not in (b"", b"\r\n", b"\n"):
        lines.append(line)
    if line:
        yield from lines


def split_records(data: bytes) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """Headers and block of each record of a file, gzipped or not; gzip
    members are unpacked as they are read.  Of a file that is cut off or
    damaged the records before that place come."""
    raw = io.BytesIO(data)
    f = gzip.GzipFile(fileobj=raw) if data[:2] == b"\x1f\x8b" else raw
    try:
        while line := f.readline():
            if not line.startswith(b"WARC/"):
                continue
            headers: list[tuple[str, str]] = []
            for h in _lines(f):
                h = h.decode("utf-8", "replace").rstrip("\r\n")
                if h[:1] in (" ", "\t") and headers:  # continued line
                    headers[-1] = (headers[-1][0], f"{headers[-1][1]} {h.strip()}")
                elif ":" in h:
                    k, _, v = h.partition(":")
                    headers.append((k.strip(), v.strip()))
            size = next((int(v) for k, v in headers if k.lower() == "content-length" and v.isdigit()), 0)
            block = f.read(size)
            if headers and len(block) == size:
                yield headers, block
    except (EOFError, gzip.BadGzipFile, zlib.error):
        return


def read_warc(files: DataFrame) -> DataFrame:
    """Records of ``spark.read.format("binaryFile")`` rows, in batches of
    about ``BATCH`` bytes."""
    get = lambda h, name: next((v for k, v in h if k.lower() == name), None)

    def batch_of(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([get(h, "warc-record-id") for h, _ in rows], pa.string()),
             pa.array([get(h, "warc-type") for h, _ in rows], pa.string()),
             pa.array([get(h, "warc-target-uri") for h, _ in rows], pa.string()),
             pa.array([[{"name": k, "value": v} for k, v in h] for h, _ in rows], HEADERS),
             pa.array([b for _, b in rows], pa.binary())],
            ["record_id", "warc_type", "target_uri", "headers", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                held, size = [], 0
                for record in split_records(content.as_py() or b""):
                    held.append(record)
                    size += len(record[1])
                    if size >= BATCH:
                        yield batch_of(held)
                        held, size = [], 0
                if held:
                    yield batch_of(held)
    return files.select("content").mapInArrow(run, RECORD)


def response_headers(url: str | None, payload: bytes, key: str, date: str) -> tuple[list[tuple[str, str]], bytes]:
    """Headers and block of a response record for a page."""
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
             + str(len(payload)).encode() + CRLF * 2 + payload)
    payload_digest = digest(payload)
    return [("WARC-Type", "response"), ("WARC-Record-ID", derived_id("response", key, url or "", payload_digest)),
            ("WARC-Target-URI", url or ""), ("WARC-Date", date), ("WARC-Payload-Digest", payload_digest),
            ("WARC-Block-Digest", digest(block)), ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", str(len(block)))], block


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              date: str = PAGE_DATE) -> DataFrame:
    """Response records of a page table, with page_id.  A null page has an
    empty payload, a null url an empty target URI."""
    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [response_headers(u, (h or "").encode("utf-8", "surrogatepass"), str(i), date) for i, u, h in zip(
            *(c.to_pylist() for c in batch.columns), strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([h[1][1] for h, _ in rows], pa.string()),
             pa.array(["response"] * len(rows), pa.string()), pa.array([h[2][1] for h, _ in rows], pa.string()),
             pa.array([[{"name": k, "value": v} for k, v in h] for h, _ in rows], HEADERS),
             pa.array([b for _, b in rows], pa.binary())],
            ["page_id", "record_id", "warc_type", "target_uri", "headers", "block"])
    return map_batches(pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"),
                                    F.col(html_col).alias("html")), fn, "page_id bigint, " + RECORD)


def _http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and payload of an HTTP message."""
    head, _, payload = block.partition(CRLF * 2)
    lines = head.decode("utf-8", "replace").split("\r\n")
    return lines[0], [(k.strip(), v.strip()) for k, s, v in (x.partition(":") for x in lines[1:]) if s], payload


def _field(http: list[tuple[str, str]], name: str) -> str:
    """Values of a header, joined by commas, in lower case."""
    return ",".join(v for k, v in http if k.lower() == name).lower()


def _dechunked(payload: bytes) -> bytes:
    """The payload without the framing of chunks; as it is where it has none
    (some archives undo it and leave the header)."""
    out, at = [], 0
    while (end := payload.find(CRLF, at)) >= 0:
        size = payload[at:end].partition(b";")[0].strip()
        if not re.fullmatch(rb"[0-9a-fA-F]{1,15}", size):
            break
        if not int(size, 16):
            return b"".join(out)
        out.append(payload[end + 2:end + 2 + int(size, 16)])
        at = end + 2 + int(size, 16) + 2
    return b"".join(out) if out else payload


def _inflated(payload: bytes, wbits: int) -> bytes:
    """As much as can be unpacked, member by member."""
    out = []
    while payload:
        one = zlib.decompressobj(wbits)
        try:
            out.append(one.decompress(payload))
        except zlib.error:
            if wbits == zlib.MAX_WBITS and not out:  # deflate without its header, as some servers send it
                return _inflated(payload, -zlib.MAX_WBITS)
            break
        payload = one.unused_data
    return b"".join(out)


def _decoded(payload: bytes, http: list[tuple[str, str]]) -> tuple[bytes, bytes]:
    """The payload without its transfer encoding, and that without its
    content encodings (gzip, deflate and zstd; what is named otherwise, or
    can't be unpacked, stays as it is)."""
    entity = _dechunked(payload) if "chunked" in _field(http, "transfer-encoding") else payload
    body = entity
    for name in reversed([c.strip() for c in _field(http, "content-encoding").split(",")]):
        if name in ("gzip", "x-gzip"):
            body = _inflated(body, zlib.MAX_WBITS | 16) or body
        elif name == "deflate":
            body = _inflated(body, zlib.MAX_WBITS) or body
        elif name == "zstd":
            try:
                body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
            except zstandard.ZstdError:
                return entity, body
    return entity, body


def _text(payload: bytes, http: list[tuple[str, str]]) -> str:
    found = re.search(r"charset=[\"']?([\w.:-]+)", _field(http, "content-type"))
    try:
        return payload.decode(found[1] if found else "utf-8", "replace")
    except LookupError:  # an encoding nobody knows
        return payload.decode("utf-8", "replace")


TITLE = re.compile(r"<title[^>]*>(.*?)</title\s*>", re.I | re.S)


def derive(headers: list[tuple[str, str]], block: bytes) -> list[tuple[str, str, list[tuple[str, str]], bytes, dict]]:
    """(record id, type, headers, block, facts) of the two derived records.
    A response without an id refers to none; its records are named by its
    target, date and block."""
    own = {k.lower(): v for k, v in headers}
    source, uri = own.get("warc-record-id", ""), own.get("warc-target-uri", "")
    name = source or f"{uri} {own.get('warc-date', '')} {digest(block)}"
    status, http, payload = _http(block)
    payload, body = _decoded(payload, http)
    text = _text(body, http)
    page = parse(text)
    title = TITLE.search(text)
    payload_digest = own.get("warc-payload-digest") or digest(payload)
    described = {
        "source": {"warc-headers": [list(h) for h in headers], "block-digest": own.get("warc-block-digest")
                   or digest(block), "payload-digest": payload_digest},
        "http": {"status": status, "headers": [list(h) for h in http], "payload-length": len(payload)},
        "html": {"title": " ".join(entities.unescape(title[1]).split()) if title else None,
                 "links": [{"url": u, "text": t} for u, t in page.links]}}
    plain = "\n".join(b[2] for b in page.blocks)
    out = []
    for kind, mime, body in (
            ("metadata", "application/json", json.dumps(described, ensure_ascii=False).encode("utf-8", "replace")),
            ("conversion", "text/plain; charset=utf-8", plain.encode("utf-8", "replace"))):
        record_id = derived_id(kind, name)
        h = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Refers-To", source),
             ("WARC-Refers-To-Target-URI", uri), ("WARC-Refers-To-Date", own.get("warc-date", "")),
             ("WARC-Target-URI", uri), ("WARC-Date", own.get("warc-date", "")), ("WARC-Block-Digest", digest(body)),
             ("Content-Type", mime), ("Content-Length", str(len(body)))]
        out.append((record_id, kind, h, body, {"links": len(page.links), "payload_digest": payload_digest}))
    return out


DERIVED = ("record_id string, warc_type string, refers_to string, target_uri string, headers array<struct<name:string,"
           "value:string>>, block binary, n_links bigint, source_payload_digest string")


def derivatives(records: DataFrame, id_col: str | None = None) -> DataFrame:
    """Two records per response record (rows of other types are passed over):
    headers, block, links found and the source's payload digest; with
    ``id_col`` that column comes along as page_id.

    A response with a null block counts as an empty message.  Repeated
    responses give repeated records; other columns are not read."""
    ids = [F.col(id_col).cast("bigint").alias("page_id")] if id_col else []

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, at = [], []
        for i in range(batch.num_rows):
            h = [(x["name"], x["value"]) for x in batch.column("headers")[i].as_py() or []]
            rows += derive(h, batch.column("block")[i].as_py() or b"")
            at += [i, i]
        get = lambda h, name: next((v for k, v in h if k == name), None)
        arrays = [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()),
                  pa.array([get(r[2], "WARC-Refers-To") for r in rows], pa.string()),
                  pa.array([get(r[2], "WARC-Target-URI") for r in rows], pa.string()),
                  pa.array([[{"name": k, "value": v} for k, v in r[2]] for r in rows], HEADERS),
                  pa.array([r[3] for r in rows], pa.binary()), pa.array([r[4]["links"] for r in rows], pa.int64()),
                  pa.array([r[4]["payload_digest"] for r in rows], pa.string())]
        names = ["record_id", "warc_type", "refers_to", "target_uri", "headers", "block", "n_links",
                 "source_payload_digest"]
        if id_col:
            arrays, names = [batch.column("page_id").take(pa.array(at, pa.int64())), *arrays], ["page_id", *names]
        return pa.RecordBatch.from_arrays(arrays, names)
    rows = records.filter("warc_type = 'response'").select(*ids, "headers", "block")
    return map_batches(rows, fn, ("page_id bigint, " if id_col else "") + DERIVED)


def derivative_report(pages: DataFrame) -> DataFrame:
    """Two rows per page: the derived records' links, digests and sizes."""
    rows = derivatives(responses(pages), "page_id")
    value = lambda name: F.filter("headers", lambda h: h["name"] == name)[0]["value"]
    return rows.select(
        "page_id", "warc_type", "record_id", "refers_to", "target_uri", value("WARC-Date").alias("date"),
        value("Content-Type").alias("content_type"), F.octet_length("block").cast("bigint").alias("content_length"),
        value("WARC-Block-Digest").alias("block_digest"), "source_payload_digest", "n_links",
        F.sha2("block", 256).alias("block_sha256"))
