import base64
import gzip
import hashlib
import random
from collections import Counter

import pytest

from tallymark.llm import warc
from tallymark.session import scratch_path

SCHEMA = "page_id bigint, url string, html string, kind string, payload string"


def expected(rows, smallest=0):
    first = {}
    for page_id, _, html, *_ in rows:
        size = len((html or "").encode())
        if size >= smallest:
            old = first.get(html or "")
            first[html or ""] = max((x for x in (old, page_id) if x is not None), default=None)
    out = []
    for page_id, _, html, *_ in rows:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        again = (html or "") in first and first[html or ""] != page_id
        out.append((page_id, len(data), digest, "revisit" if again else "response", first[html or ""] if again else None))
    return sorted(out, key=repr)


def pages():
    rng = random.Random(2)
    rows = [(i, f"http://h{i % 3}.example.org/p/{i}?q=1", "<p>%d é</p>" % (i % 11), "k", "p") for i in range(60)]
    rows += [
        (100, None, None, None, None), (101, "no scheme", "", "", ""), (102, "http://x/\r\nWARC-Type: response", "WARC/1.1\r\n\r\n\r\n\r\nWARC/1.1\r\nWARC-Type: request\r\n\r\n", "", ""),
        (None, "http://n/", "only null", "", ""), (None, "http://n/", "<p>1 é</p>", "", ""), (103, "http://l/", "".join(rng.choices("abc \r\n", k=3_000_000)), "", ""),
        (104, "http://e/", "\r\n\r\n", "", ""), (7, "http://h1.example.org/p/7?q=1", "<p>7 é</p>", "k", "p"), (500, "http://s/", "same", "", ""), (500, "http://s/", "same", "", ""),
    ]
    return rows


def test_round_trip(spark):
    rows = pages()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = warc.page_records(spark, df, scratch_path(spark, "warc")).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(rows)


def test_nested_captures_hold_payloads(spark):
    rows = pages()
    path = scratch_path(spark, "warc")
    warc.write_archives(spark.createDataFrame(rows, SCHEMA), path, smallest=5)
    kinds = Counter(r["kind"] for r in warc.read_records(spark, path).collect())
    assert kinds["request"] == kinds["metadata"] == len(rows) == kinds["response"] + kinds["revisit"]
    out = warc.captures(warc.read_records(spark, path)).collect()
    assert len(out) == len(rows)
    wanted = {(p, (h or "").encode()): u for p, u, h, *_ in rows}
    for r in out:
        if r.response.kind == "response":
            url = wanted[r.page_id, bytes(r.response.payload)]
            assert r.target_uri == (url and url.replace("\r", "%0D").replace("\n", "%0A"))
            assert r.response.declared_digest == r.response.payload_digest
        else:
            assert r.response.payload is None and r.metadata.page_bytes >= 5
        assert r.request.request_id and r.metadata.metadata_id


def test_empty_table(spark):
    assert warc.page_records(spark, spark.createDataFrame([], SCHEMA), scratch_path(spark, "warc")).count() == 0


def test_parser_reads_members_and_plain_files():
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n"
    blocks = [b"a\r\n\r\nWARC/1.1\r\n", b"", b"x" * 3_000_000]
    plain = b"".join(record % (len(b), b) for b in blocks)
    members = b"".join(gzip.compress(record % (len(b), b)) for b in blocks)
    for data in (plain, members, gzip.compress(plain)):
        assert [b for _, b in warc.parse(memoryview(data))] == blocks
    with pytest.raises(ValueError):
        list(warc.parse(memoryview(plain[:-100])))
    with pytest.raises(ValueError):
        list(warc.parse(memoryview(b"HTTP/1.1 200\r\n\r\n")))
    assert list(warc.parse(memoryview(b""))) == []
