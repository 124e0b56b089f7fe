from __future__ import annotations

import base64
import gzip
import hashlib
import io

import pytest

from airlake.llm.warc import assemble, parse_records, read_records, write_captures

LONG = "é<p>WARC/1.1\r\nWARC-Type: response\r\n\r\n</p>" * 20
PAGES = [
    (3, "http://a/1", LONG), (2, "http://a/2 \r\nX: y", LONG), (9, None, LONG), (2, "http://a/2", LONG), (None, "http://n", LONG),
    (4, "http://b", "short"), (5, "http://b", "short"), (6, "", ""), (7, "u", None), (8, "http://c", "other " * 40),
    (8, "http://c", "other " * 40), (10, "http://d", "\r\n\r\n" * 60), (11, "http://e", "x" * 300_000),
]


def expected(pages):
    firsts = {}
    for page, _, html in pages:
        if page is not None and len((html or "").encode()) >= 100:
            firsts[html] = min(page, firsts.get(html, page))
    out = []
    for page, url, html in pages:
        body = (html or "").encode()
        first = firsts.get(html) if len(body) >= 100 else None
        revisit = first is not None and first != page
        out.append((page, url, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response",
                    first if revisit else None, None if revisit else body))
    return out


def test_captures_come_back(spark, rows, tmp_path):
    path = str(tmp_path / "warc")
    frame = rows([(*p, "z") for p in PAGES], "page_id BIGINT, url STRING, html STRING, digest STRING")
    write_captures(frame, path)
    captures = assemble(read_records(spark, path)).collect()
    key = lambda t: tuple((x is None, x) for x in t)
    got = []
    named = lambda r: {x.name: x.value for x in r.metadata}
    names = {r.response.record_id: named(r).get("page") for r in captures if r.response.type == "response"}
    for r in captures:
        fields = named(r)
        url = None if "url" not in fields else base64.b64decode(fields["url"]).decode()
        first = int(fields["refers-to-page"]) if "refers-to-page" in fields else None
        got.append((int(fields["page"]) if "page" in fields else None, url, int(fields["payload-length"]),
                    r.response.payload_digest[7:], r.response.type, first, None if r.response.payload is None else bytes(r.response.payload)))
        assert r.request.http_head.startswith("GET ") and r.response.http_head.startswith("HTTP/1.1 200 OK")
        assert r.capture_id == r.request.record_id
        if first is not None:
            assert names[r.response.refers_to] == str(first)
    assert sorted(got, key=key) == sorted(expected(PAGES), key=key)


def test_foreign_archives_and_parts_that_are_missing(spark, tmp_path):
    def record(kind, number, to=None, block=b"", more=""):
        head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{number}>\r\n" + (f"WARC-Concurrent-To: <{to}>\r\n" if to else "")
        return (head + more + f"Content-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"

    http = "Content-Type: application/http; msgtype=response\r\n"
    parts = [
        record("warcinfo", "w", block=b"software: x\r\n"), record("metadata", "m1", "q1", b"k: v\r\nk: w\r\nother: a:b\r\n"),
        record("response", "s1", "q1", b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nbody\x00\xff\r\n\r\n", http), record("request", "q1"),
        record("request", "q2"), record("response", "s3", None, b"plain"), record("metadata", "m3", "s3", b"k: 3\r\n"),
        record("metadata", "m4", "nobody", b""),
    ]
    folder = tmp_path / "foreign"
    folder.mkdir()
    (folder / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, parts[:4])))
    (folder / "b.warc").write_bytes(b"".join(parts[4:]))
    by = {r.capture_id: r for r in assemble(read_records(spark, str(folder))).collect()}
    assert set(by) == {"<q1>", "<q2>", "<s3>", "<m4>"}
    assert bytes(by["<q1>"].response.payload) == b"body\x00\xff\r\n\r\n" and [tuple(x) for x in by["<q1>"].metadata] == [("k", "v"), ("k", "w"), ("other", "a:b")]
    assert by["<q2>"].response is None and by["<s3>"].request is None and [tuple(x) for x in by["<s3>"].metadata] == [("k", "3")]
    assert by["<m4>"].request is None and by["<m4>"].metadata == []


def test_damaged_records_are_errors():
    good = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [b for _, b in parse_records(io.BytesIO(good * 2))] == [b"abc", b"abc"]
    for bad in (good[:-6], b"junk\r\n" + good, b"WARC/1.1\r\n\r\n"):
        with pytest.raises(ValueError):
            list(parse_records(io.BytesIO(bad)))


def test_empty_table(spark, rows, tmp_path):
    path = str(tmp_path / "none")
    write_captures(rows([], "page_id BIGINT, url STRING, html STRING"), path)
    assert assemble(read_records(spark, path)).count() == 0
