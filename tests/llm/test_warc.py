import base64
import glob
import gzip
import hashlib
import os

import pytest

from vecforge.llm.warc import RECORD, SEGMENT, decode_http, read_warc, reassemble, write_warc


def sha(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


PAGES = [(1, "http://a/", "<p>same</p>"), (2, None, "<p>same</p>"), (5, "http://b/\r\nX: y", "<p>same</p>"),
         (7, "u", None), (8, "u", ""), (9, "u", "é" * 20000 + "\r\n\r\nWARC/1.1\r\n0\r\n\r\n"), (None, "u", "only"),
         (None, "u", "lone"), (None, "v", "lone"), (11, "u", "twice"), (11, "u", "twice"), (12, "u", "z" * 1000)]


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warc") / "out")
    rows = [(*p, "clash", 3) for p in PAGES]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string, winner int")
    write_warc(pages, path, "page_id", "url", "html", segment_bytes=700, chunk_bytes=97, records_per_file=5)
    return path


def test_round_trip(spark, archive):
    got = read_warc(spark, archive).collect()
    assert all(r.status == "ok" for r in got)
    best = {}
    for i, _, h in PAGES:
        best[h or ""] = max(best.get(h or "", -1), -1 if i is None else i)
    expect = []
    for i, _, h in PAGES:
        raw, top = (h or "").encode(), best[h or ""]
        response = top in (-1, i)
        expect.append((None if i is None else str(i), len(raw), sha(raw), "response" if response else "revisit",
                       None if response else str(top), bytes(raw) if response else None))
    key = repr
    assert sorted(((r.key, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to_key,
                    None if r.payload is None else bytes(r.payload)) for r in got), key=key) == sorted(expect, key=key)
    ids = {r.record_id for r in got}
    assert len(ids) == len(PAGES)
    assert {r.refers_to for r in got if r.record_type == "revisit"} <= ids


def test_archives_are_standard(archive):
    files = glob.glob(os.path.join(archive, "part-*"))
    assert len(files) > 1
    kinds = []
    for f in files:
        data = gzip.open(f).read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            lines = head.split(b"\r\n")
            assert lines[0] == b"WARC/1.1"
            fields = dict(x.split(b": ", 1) for x in lines[1:])
            assert {b"WARC-Type", b"WARC-Record-ID", b"WARC-Date", b"Content-Length"} <= set(fields)
            n = int(fields[b"Content-Length"])
            assert rest[n:n + 4] == b"\r\n\r\n"
            kinds.append(fields[b"WARC-Type"])
            data = rest[n + 4:]
    assert kinds.count(b"continuation") > 50


def test_min_revisit_bytes_and_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")],
                                  "page_id long, url string, html string")
    write_warc(pages, str(tmp_path / "a"), "page_id", "url", "html", min_revisit_bytes=3)
    got = {r.key: r.record_type for r in read_warc(spark, str(tmp_path / "a")).collect()}
    assert got == {"1": "response", "2": "response", "3": "revisit", "4": "response"}
    write_warc(pages.limit(0), str(tmp_path / "b"), "page_id", "url", "html")
    assert read_warc(spark, str(tmp_path / "b")).count() == 0


def test_broken_segments(spark):
    def seg(origin, n, block, total=None, cut=False):
        return (origin, n, total, "response" if n == 1 else "continuation", "k", None, None, cut, block)

    body = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3\r\nabc\r\n0\r\n\r\n"
    a, b = body[:20], body[20:]
    rows = [seg("ok", 2, b, len(body)), seg("ok", 1, a), seg("ok", 1, a), seg("gap", 1, a), seg("gap", 3, b, len(body)),
            seg("headless", 2, b, len(b)), seg("short", 1, a), seg("short", 2, b[:-3], len(body)), seg("untold", 1, a),
            seg("cut", 1, a), seg("cut", 2, b, len(body), True)]
    got = {r.record_id: r for r in reassemble(spark.createDataFrame(rows, SEGMENT)).collect()}
    assert {k: r.status for k, r in got.items()} == {"ok": "ok", "gap": "incomplete", "headless": "incomplete",
                                                     "short": "incomplete", "untold": "incomplete", "cut": "incomplete"}
    assert bytes(got["ok"].payload) == b"abc" and got["gap"].payload is None
    too = reassemble(spark.createDataFrame(rows[:2], SEGMENT), max_record_bytes=10).collect()
    assert [r.status for r in too] == ["too long"]
    assert reassemble(spark.createDataFrame([], SEGMENT)).columns == [x.split()[0] for x in RECORD.split(", ")]


def test_framing():
    head = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n"
    assert decode_http(head + b"2;x=y\r\nab\r\n1\r\nc\r\n0\r\n\r\n") == (b"abc", "ok")
    assert decode_http(head + b"5\r\nab") == (b"ab", "bad framing")
    assert decode_http(head + b"zz\r\n") == (b"", "bad framing")
    assert decode_http(b"HTTP/1.0 200 OK\r\nContent-Length: 2\r\n\r\nhi") == (b"hi", "ok")
    assert decode_http(b"plain") == (b"plain", "ok")


def test_truncated_file(spark, tmp_path):
    record = (b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nContent-Length: 50\r\n\r\nHTTP/1.1 200 OK\r\n\r\nhalf")
    (tmp_path / "x.warc").write_bytes(record)
    assert [r.status for r in read_warc(spark, str(tmp_path)).collect()] == ["truncated"]
