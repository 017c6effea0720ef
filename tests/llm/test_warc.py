"""Archives: read back by the package, and as plain WARC by the test."""

from __future__ import annotations

import gzip
import hashlib
import random

import pytest
from samples import prose

from fairdraw.llm import warc
from fairdraw.llm.storage import filesystem


@pytest.fixture
def pages(spark):
    kind = "page_id long, url string, html string, digest string, payload int"
    return lambda rows: spark.createDataFrame([(*r, "x", 1) for r in rows], kind).repartition(3)


def brute(rows):
    payloads = [(i, (html or "").encode()) for i, _, html in rows]
    out = []
    for i, payload in payloads:
        same = [j for j, other in payloads if other == payload and j is not None]
        first = min(same) if len(payload) >= 100 and same else i
        out.append((i, len(payload), hashlib.sha256(payload).hexdigest(), *(("response", None) if first == i else ("revisit", first))))
    return sorted(out, key=repr)


def corpus():
    rng, rows = random.Random(4), []
    pool = [f"<p>{prose(i, 5 + i * 3)}</p>\r\n\r\n<br>é" for i in range(20)] + ["", None, "WARC/1.1\r\n\r\n" * 20, "\r\n" * 60, "x" * 99, "x" * 100]
    for i in range(150):
        rows.append((i * 2, None if i % 17 == 3 else f"http://ex.org/ä b/{i}\r\n?q=%25", rng.choice(pool)))
    return rows


def test_against_plain_loops(pages):
    rows = [*corpus(), (None, "http://x/", "x" * 100), (None, "u", "only without an id " * 9), (4, "again", corpus()[2][2])]
    got = warc.archive_pages(pages(rows))
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def prepared(table):
    columns = "page_id", "url", "cast(coalesce(html, '') as binary) as payload", "cast(null as long) as refers_to"
    return table.selectExpr(*columns).selectExpr("*", "cast(octet_length(payload) as long) as payload_bytes", "sha2(payload, 256) as digest")


def test_large_payload_comes_in_chunks(pages, tmp_path):
    big = prose(1, 150_000)
    table = pages([(1, "http://a/", big), (2, "http://b/", "small")])
    assert {r.page_id: r.payload_bytes for r in warc.archive_pages(table).collect()} == {1: len(big), 2: 5}
    manifest = warc.write_archives(prepared(table), f"file:{tmp_path}").cache()
    manifest.count()
    records = b"".join(gzip.open(f).read() for f in sorted(tmp_path.glob("*.warc.gz"))).split(b"WARC/1.1\r\n")[1:]
    assert len(records) == 2 and sum(big.encode() in r for r in records) == 1
    chunks = warc.read_archives(manifest, f"file:{tmp_path}", 2).where("page_id = 1").orderBy("chunk_no").collect()
    assert len(chunks) > 2 and max(c.data_bytes for c in chunks) <= warc.CHUNK
    assert b"".join(bytes(c.data) for c in chunks) == big.encode()
    for n in (1, 2, len(chunks)):
        assert chunks[n - 1].digest == hashlib.sha256(b"".join(bytes(c.data) for c in chunks[:n])).hexdigest()


def test_addresses_come_back(pages, tmp_path):
    rows = corpus()
    manifest = warc.write_archives(prepared(pages(rows)), f"file:{tmp_path}").cache()
    got = warc.read_archives(manifest, f"file:{tmp_path}", 2).select("page_id", "url", "data").collect()
    escaped = {" ": "%20", "\r": "%0D", "\n": "%0A"}
    assert {r.page_id: (r.url, bytes(r.data).decode()) for r in got} == {
        i: (u and "".join(escaped.get(c, c) for c in u), h or "") for i, u, h in rows
    }


def test_empty_table(pages):
    assert warc.archive_pages(pages([])).collect() == []


def test_local_paths():
    assert filesystem("file:/a/b")[1] == filesystem("file:///a/b")[1] == "/a/b"
