"""Archives against a plain reading of the pages, and archives of other writers."""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections import Counter, defaultdict

import pytest

from claimloom.llm.warc import archive_pages, assemble, read_records, write_pages

SCHEMA = "page_id bigint, url string, html string, sha256 string, payload string, n int, head string"
SAME = "<p>same</p>\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"


def page(page_id, url, html):
    return (page_id, url, html, "s", "p", 3, "h")


ROWS = [
    page(1, "http://a.example/x?y=1#z", "<p>one</p>"),
    page(2, "http://a.example", SAME),
    page(3, "http://b.example/ sp\r\nX: y", SAME),
    page(4, None, SAME),
    page(5, "no url", None),
    page(6, "http://c.example/", ""),
    page(7, "http://c.example/é", "漢字 \U0001f600 nul \0"),
    page(8, "", "x" * 3_000_000),
    page(8, "", "x" * 3_000_000),
    page(9, "http://d.example/", "two"),
    page(9, "http://e.example/", "two"),
    page(9, None, "two"),
    page(None, None, None),
    page(None, "http://f.example/", "only null"),
    page(None, None, "only null"),
] + [page(20, "http://copies.example/", "copies")] * 9


def brute(rows, least=0):
    groups = defaultdict(list)
    for page_id, _, html, *_ in rows:
        groups[html or ""].append(page_id)
    out = Counter()
    for html, ids in groups.items():
        data = html.encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        ids.sort(key=lambda i: (i is not None, i or 0))
        for k, i in enumerate(ids):
            response = k == len(ids) - 1 or len(data) < least
            out[(i, len(data), digest, "response" if response else "revisit", None if response else ids[-1])] += 1
    return out


def found(df):
    return Counter(tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())


@pytest.mark.parametrize("least", [0, 4, 1000])
def test_pages(spark, least):
    pages = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    assert found(archive_pages(pages, least)) == brute(ROWS, least)


def test_no_pages(spark):
    assert archive_pages(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_captures(spark, tmp_path, compression):
    pages = spark.createDataFrame(ROWS[:8], SCHEMA)
    write_pages(pages, str(tmp_path / "w"), compression=compression, records_per_file=2)
    captures = {r.metadata[0].fields["page-id"]: r for r in assemble(read_records(spark, str(tmp_path / "w"))).collect()}
    assert len(captures) == 8
    for page_id, url, html, *_ in ROWS[:8]:
        r = captures[str(page_id)]
        assert len(r.requests) == len(r.metadata) == 1
        if r.record_type == "response":
            assert bytes(r.response.payload) == (html or "").encode()
            assert r.response.payload_digest == r.response.payload_sha1
        else:
            assert bytes(r.response.payload) == b""
    assert captures["1"].requests[0].start_line == "GET /x?y=1 HTTP/1.1"
    assert captures["1"].requests[0].fields == {"host": "a.example"}
    assert captures["3"].uri == "http://b.example/%20sp%0D%0AX:%20y"
    assert captures["4"].uri is None
    refers = {k: r.refers_to for k, r in captures.items() if r.refers_to}
    assert refers == {"2": captures["4"].capture_id, "3": captures["4"].capture_id, "5": captures["6"].capture_id}


def raw(kind, name, block=b"", *headers):
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"warc-record-id: <{name}>", *headers, f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_other_writers(spark, tmp_path):
    http = "Content-Type: application/http; msgtype=response"
    records = [
        raw("warcinfo", "i", b"software: x\r\n", "Content-Type: application/warc-fields"),
        raw("response", "r1", b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nbody", http, "WARC-Concurrent-To: <q1>", "WARC-Concurrent-To: <m1>"),
        raw("request", "q1", b"GET / HTTP/1.1\r\n\r\n", "Content-Type: application/http"),
        raw("metadata", "m1", b"k: v\r\n", "Content-Type: application/warc-fields", "WARC-Concurrent-To: <r1>"),
        raw("response", "r2", b"plain"),
        raw("metadata", "m2", b"", "WARC-Concurrent-To: <nowhere>"),
    ]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records[:3]))
    (tmp_path / "b.warc").write_bytes(b"".join(records[3:]))
    read = read_records(spark, str(tmp_path))
    assert read.count() == 6
    captures = {r.capture_id: r for r in assemble(read).collect()}
    assert set(captures) == {"<r1>", "<r2>"}
    r1, r2 = captures["<r1>"], captures["<r2>"]
    assert [q.record_id for q in r1.requests] == ["<q1>"] and [m.fields for m in r1.metadata] == [{"k": "v"}]
    assert bytes(r1.response.payload) == b"body" and r1.response.fields == {"a": "b"}
    assert bytes(r2.response.payload) == b"plain" and r2.requests is None


@pytest.mark.parametrize("content", [b"no archive", raw("response", "r", b"cut short")[:-8], gzip.compress(raw("response", "r"))[:-12], b"WARC/1.1\r\n"])
def test_malformed(spark, tmp_path, content):
    (tmp_path / "x.warc").write_bytes(content)
    with pytest.raises(Exception, match=r"x\.warc: "):
        read_records(spark, str(tmp_path)).collect()
