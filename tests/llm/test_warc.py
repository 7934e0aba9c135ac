import base64
import gzip
import hashlib
import json
import zlib

import pytest
import zstandard

from wavelake.llm import warc

SCHEMA = "page_id bigint, url string, html string, headers string, block string, record_id int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)


ROWS = [(1, "http://a.example/x?y=1", "<html><head><title>T &amp; t</title></head><body><p>One <a href='/l?a&amp;b'>link"
         "</a><p>two</body>"), (2, "http://b.example/", ""), (3, None, None), (None, "http://c.example/", "<p>é"),
        (1, "http://a.example/x?y=1", "<p>other"), (5, "u", "x" * 100_000)]


def value(row, name):
    return next(h["value"] for h in row["headers"] if h["name"] == name)


def test_records_are_linked_to_their_response(spark):
    source = {r.record_id: r for r in warc.responses(pages(spark, ROWS)).collect()}
    derived = warc.derivatives(warc.responses(pages(spark, ROWS)), "page_id").collect()
    assert len(source) == len(ROWS) and len(derived) == 2 * len(ROWS) == len({r.record_id for r in derived})
    for r in derived:
        of = source[r.refers_to]
        assert value(r, "WARC-Refers-To") == of.record_id and value(r, "WARC-Target-URI") == of.target_uri
        assert value(r, "WARC-Date") == value(of, "WARC-Date") and r.page_id == of.page_id
        assert int(value(r, "Content-Length")) == len(r.block)
        assert value(r, "WARC-Block-Digest") == "sha1:" + base64.b32encode(hashlib.sha1(r.block).digest()).decode()
        assert r.source_payload_digest == value(of, "WARC-Payload-Digest")
        if r.warc_type == "metadata":
            told = json.loads(r.block)
            assert told["source"]["warc-headers"] == [[h["name"], h["value"]] for h in of.headers]
            assert told["source"]["block-digest"] == value(of, "WARC-Block-Digest")
    meta = next(r for r in derived if r.page_id == 1 and r.warc_type == "metadata" and r.n_links)
    assert json.loads(meta.block)["html"] == {"title": "T & t", "links": [{"url": "/l?a&b", "text": "link"}]}
    assert next(r.block for r in derived if r.refers_to == meta.refers_to and r.warc_type == "conversion") == \
        b"One link\ntwo"


def test_written_records_read_back(spark, tmp_path):
    rows = warc.responses(pages(spark, ROWS)).collect()
    data = b"".join(warc.serialize([(h["name"], h["value"]) for h in r.headers], r.block) for r in rows)
    (tmp_path / "a.warc").write_bytes(data)
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(warc.serialize(
        [(h["name"], h["value"]) for h in r.headers], r.block)) for r in rows))
    read = warc.read_warc(spark.read.format("binaryFile").load(str(tmp_path))).collect()
    assert sorted((r.record_id, bytes(r.block), len(r.headers)) for r in read) == sorted(
        [(r.record_id, bytes(r.block), len(r.headers)) for r in rows] * 2)


def test_other_types_null_blocks_and_empty_tables(spark):
    odd = spark.createDataFrame([("a", "request", "u", None, b"x"), ("b", "response", None, None, None)], warc.RECORD)
    assert sorted(r.warc_type for r in warc.derivatives(odd).collect()) == ["conversion", "metadata"]
    assert warc.derivative_report(pages(spark, [])).collect() == []
    assert len(warc.derivative_report(pages(spark, ROWS)).collect()) == 2 * len(ROWS)


PAGE = "<title>Tïtle</title><p>Some <a href='/x'>text</a> here".encode()


def chunks(data, size=7):
    parts = [data[k:k + size] for k in range(0, len(data), size)]
    return b"".join(b"%x;a=b\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\nTrailer: 1\r\n\r\n"


def raw_deflate(data):
    one = zlib.compressobj(wbits=-zlib.MAX_WBITS)
    return one.compress(data) + one.flush()


@pytest.mark.parametrize("fields, payload, entity", [
    ("Transfer-Encoding: chunked", chunks(PAGE), PAGE),
    ("transfer-encoding: Chunked\r\nContent-Encoding: gzip", chunks(gzip.compress(PAGE)), gzip.compress(PAGE)),
    ("Content-Encoding: x-gzip", gzip.compress(PAGE[:20]) + gzip.compress(PAGE[20:]), None),
    ("Content-Encoding: deflate", zlib.compress(PAGE), None), ("Content-Encoding: deflate", raw_deflate(PAGE), None),
    ("Content-Encoding: deflate, gzip", gzip.compress(zlib.compress(PAGE)), None),
    ("Content-Encoding: zstd", zstandard.compress(PAGE), None),
    # named, but undone by whoever wrote the archive
    ("Transfer-Encoding: chunked\r\nContent-Encoding: gzip", PAGE, None)])
def test_encodings_are_undone(fields, payload, entity):
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{fields}\r\n\r\n".encode() + payload
    meta, text = warc.derive([("WARC-Record-ID", "<a>")], block)
    told = json.loads(meta[3])
    assert told["html"] == {"title": "Tïtle", "links": [{"url": "/x", "text": "text"}]}
    assert text[3].decode().split("\n")[-1] == "Some text here"
    assert told["source"]["payload-digest"] == warc.digest(entity or payload)


def test_unknown_and_broken_encodings_stay():
    for field, payload in (("br", b"\x0b\x02\x80abc\x03"), ("gzip", b"no gzip"), ("zstd", b"no zstd"), ("gzip", b"")):
        block = f"HTTP/1.1 200 OK\r\nContent-Encoding: {field}\r\n\r\n".encode() + payload
        assert len(warc.derive([], block)) == 2


def test_responses_without_ids_have_records_of_their_own():
    a, b = (warc.derive([("WARC-Target-URI", u)], b"HTTP/1.1 200 OK\r\n\r\nx") for u in ("u", "v"))
    assert len({r[0] for r in a + b}) == 4 and {dict(r[2])["WARC-Refers-To"] for r in a + b} == {""}


def test_a_cut_off_file_gives_the_records_before(spark, monkeypatch):
    monkeypatch.setattr(warc, "BATCH", 10)
    one = [warc.serialize([("WARC-Type", "response"), ("WARC-Record-ID", f"<{k}>"), ("Content-Length", "9"),
                           ("X", "a\r\n b")], b"WARC/\r\n\r\n"[:9]) for k in range(3)]
    whole, packed = b"".join(one), b"".join(map(gzip.compress, one))
    files = spark.createDataFrame([(d,) for d in (whole, packed, whole[:-30], packed[:-30], b"", None)],
                                  "content binary")
    got = sorted((r.record_id, r.headers[3]["value"], len(r.block)) for r in warc.read_warc(files).collect())
    assert got == sorted([("<0>", "a b", 9), ("<1>", "a b", 9)] * 4 + [("<2>", "a b", 9)] * 2)
