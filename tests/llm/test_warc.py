"""Archives and index: records, binary search, round trips."""

import base64
import gzip
import hashlib
import random

import pytest

from sluice.llm import warc as W


def test_reversed_host():
    assert W.reversed_host("https://WWW.a.org:81/x?y=1#z") == "org,a,www:81)/x?y=1"
    assert W.reversed_host("http://a.org") == "org,a)/" and W.reversed_host(None) == "-"
    assert W.reversed_host("no url") == "-no url" and W.reversed_host("http://[bad") == "-http://[bad"
    keys = [W.capture_key("http://a.org/", i) for i in (None, -5, 3, 20, 100)]
    assert keys == sorted(keys)


def test_record_round_trip():
    for payload in (b"", b"x\r\n\r\nWARC/1.0\r\n", "é".encode() * 100):
        headers, body = W.parse(W.record(7, "http://é.org/a b\n", payload, None, False))
        assert body == payload and headers["WARC-Record-ID"] == "<urn:page:7>"
        assert "\n" not in headers["WARC-Target-URI"] and headers["WARC-Type"] == "response"
    headers, body = W.parse(W.record(8, None, b"abc", 7, True))
    assert body == b"" and headers["WARC-Refers-To"] == "<urn:page:7>" and headers["X-Payload-Length"] == "3"
    with pytest.raises(ValueError):
        W.parse(W.record(7, None, b"abc", None, False)[:-3])


def _expect(rows, least=0):
    out = []
    for i, url, html in rows:
        data = (html or "").encode()
        ids = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
        first = min(ids) if ids else None
        revisit = len(data) >= least and first is not None and i != first
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def _rows():
    rng = random.Random(4)
    rows = [(i * 7 % 501, f"http://h{rng.randrange(9)}.example.org/p{rng.randrange(60)}",
             "<p>" + "".join(rng.choice("abcé \n") for _ in range(rng.randrange(200)))) for i in range(400)]
    rows += [(1000 + i, "http://hot.example.org/", "<html>same") for i in range(60)]
    rows += [(2000, None, None), (2001, None, ""), (2002, "", None), (None, "http://a.org", "x"), (None, None, "y"),
             (3, None, "y"), rows[5], rows[400], (2003, "bad\r\nurl", "\r\n\r\n"), (2004, "http://a.org", "z" * 300_000)]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_round_trip(spark, monkeypatch, small):
    if small:  # several blocks in many shards
        monkeypatch.setattr(W, "SHARD_LINES", 40)
        monkeypatch.setattr(W, "BLOCK_LINES", 7)
    rows = _rows()
    pages = spark.createDataFrame([(*r, 1, "k") for r in rows], "page_id long, url string, html string, first int, KEY string")
    for least in (0, 50):
        got = W.warc_round_trip(pages.repartition(3), least=least, with_payload=True).collect()
        assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got),
                      key=str) == _expect(rows, least)
        texts = {(i, (h or "").encode()) for i, _, h in rows}
        assert all((r.page_id, bytes(r.payload)) in texts for r in got if r.record_type == "response")


def test_archives_are_gzip_members(spark):
    pages = spark.createDataFrame(_rows()[:50], "page_id long, url string, html string").coalesce(1)
    folder = W.archive_folder(pages)
    captures = W.write_archives(pages, folder).collect()
    for uri in {c.archive for c in captures}:
        with gzip.open(uri.removeprefix("file://")) as file:
            data = file.read()
        own = [c for c in captures if c.archive == uri]
        assert data.count(b"WARC/1.0\r\nWARC-Type: ") == len(own) and data.startswith(b"WARC/1.0\r\n")


def test_lookup_reads_few_blocks(spark, monkeypatch):
    monkeypatch.setattr(W, "BLOCK_LINES", 8)
    pages = spark.createDataFrame([(i, f"http://s{i % 40}.org/{i}", f"p{i}") for i in range(500)],
                                  "page_id long, url string, html string")
    folder = W.archive_folder(pages)
    shards = W.build_index(W.write_archives(pages, folder), folder)
    index = W.Index(shards, W.Store())
    loads = []
    monkeypatch.setattr(index.store, "read", lambda *a, f=index.store.read: loads.append(a) or f(*a))
    assert len(list(index.find(W.capture_key("http://s3.org/43", 43)))) == 1 and len(loads) <= 4
    assert not list(index.find(W.capture_key("http://s3.org/43", 44)))
    assert not list(index.find("")) and not list(index.find("~"))


def test_empty_table(spark):
    assert W.warc_round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
