"""WARC archives: exact round trip through the index, revisits, and odd rows."""

import gzip
import hashlib

import pytest

from tickwise.llm import queries, warc
from tickwise.plans.verify import compare, oracle_connection

PAGES = "page_id long, url string, html string"
BIG = "<p>shared</p>" * 100


def slow(rows, least=1000):
    best = {}
    for page, _, html in rows:
        body = (html or "").encode()
        best[body] = max(best.get(body, -(10**9)), -(10**9) if page is None else page)
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        top = best[body]
        first = len(body) < least or top == page or (page is None and top == -(10**9))
        out.append((page, len(body), hashlib.sha1(body).hexdigest(), "response" if first else "revisit", None if first else top))
    return sorted(out, key=str)


ROWS = [(i, "http://Host.example.com/same", BIG) for i in range(50)] + [
    (100, None, None), (101, "", ""), (102, "not a url", "x"), (103, "https://[bad", "y"), (104, "http://a.b:8080/p?q=1#f", "é" * 600), (105, "http://a.b:80/\r\nX-Page-Id: 7", "é" * 600),
    (None, "http://n.example/", BIG), (106, "http://n.example/", "z" * 500_000), (106, "http://n.example/", "z" * 500_000), (107, "HTTP://B.Example./é", "short"),
    (108, "http://b.example/" + "u" * 5000, ""),
]


def got(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 4)
    assert got(warc.archive_and_read(spark.createDataFrame(ROWS, PAGES))) == slow(ROWS)


def test_empty_table(spark):
    assert warc.archive_and_read(spark.createDataFrame([], PAGES)).count() == 0


def test_look_up_one_url(spark):
    _, index = warc.archive(spark.createDataFrame(ROWS, PAGES))
    keys = spark.createDataFrame([(warc.url_key("http://n.example/"),), ("org,absent)/",)], "key string")
    found = warc.read_records(warc.lookup(index, keys), with_payload=True).collect()
    assert sorted((r.page_id or -1, r.record_type, len(r.payload or b"")) for r in found) == [(-1, "revisit", 0), (106, "response", 500_000), (106, "response", 500_000)]
    assert {r.url for r in found} == {"http://n.example/"}


def test_index_finds_keys_over_many_blocks(tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    keys = sorted(["a"] * 2 + ["b"] * 10 + ["c", "d", "é"] + ["z"] * 4)
    writer = warc.IndexWriter(f"file://{tmp_path}", "x.idx")
    for n, k in enumerate(keys):
        writer.add(k, "t", n, "u", n, 1)
    writer.close()
    shard = warc.IndexShard(writer.uri)
    for k in [*set(keys), "", "bb", "zz"]:
        assert [x[2] for x in shard.find(k)] == [n for n, x in enumerate(keys) if x == k]


@pytest.mark.parametrize("url,key", [
    ("http://www.Example.com/a?b=1#c", "com,example,www)/a?b=1"), ("https://x.org:443", "org,x)/"), ("http://x.org:81/", "org,x:81)/"), (None, ")"), ("plain", ")plain"),
])
def test_url_key(url, key):
    assert warc.url_key(url) == key


def test_records_are_gzip_members():
    member = warc._page_record(4, "http://a/", "2000-01-01T00:00:00Z", b"body", hashlib.sha1(b"body").digest(), None, False)
    text = gzip.decompress(member)
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and text.endswith(b"body\r\n\r\n")


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    for name in ("op6_exact_dedup", "op7_topk", "op8_warc"):
        res = compare(spark, name, queries.queries()[name], queries.oracle_sql()[name], sf, oracle_connection(sf))
        assert res["status"] == "match", res
