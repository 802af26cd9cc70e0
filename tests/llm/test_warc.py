import base64
import hashlib

import duckdb
from brute import SF0001

from cellar.llm import queries, warc

SCHEMA = "record_id string, target_uri string, date string, http_headers string, body string, block string"


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{SF0001}/pages.parquet'")
    got = queries.op4_warc(spark, SF0001)
    cols = sorted(got.columns)
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == sorted(con.sql(f"select {','.join(cols)} from ({warc.oracle_sql()})").fetchall())


def test_records_of_edge_responses(spark):
    html = ("<html><head><title>T &amp;amp; U</title><script>var a='<p>x</p>';</script></head><body><!-- no <b>this</b> --><p>One\n two &#233;&#xE9;"
            "&#0;&#55296;&#99999999; &lt;b&gt;</p><p> three<br>four</p><STYLE>p{}</STYLE> 5 < 6</body>")
    rows = [("<urn:uuid:1>", "http://a/", "2024-01-01T00:00:00Z", "HTTP/1.1 200 OK\r\nX: 1\r\n", html, "clash"),
            (None, None, None, None, None, None), ("<urn:uuid:1>", "http://a/", "2024-01-01T00:00:00Z", "HTTP/1.1 200 OK\r\nX: 1\r\n", html, "clash")]
    out = warc.derivatives(spark.createDataFrame(rows, SCHEMA)).withColumn("record", warc.record_text()).collect()
    assert len(out) == 6
    text = next(r for r in out if r["record_type"] == "conversion" and r["refers_to"] == "<urn:uuid:1>")
    assert text["block"] == "T &amp; U\nOne two éé&#0;&#55296;&#99999999; <b>\nthree\nfour\n5 < 6"
    meta = next(r for r in out if r["record_type"] == "metadata" and r["refers_to"] == "<urn:uuid:1>")
    assert meta["concurrent_to"] == text["record_id"] and text["concurrent_to"] == meta["record_id"]
    sha = lambda s: "sha1:" + base64.b32encode(hashlib.sha1(s.encode()).digest()).decode()
    assert meta["source_digest"] == sha(html) and text["block_digest"] == sha(text["block"]) and meta["block_digest"] == sha(meta["block"])
    assert "source-header: X: 1\r\n" in meta["block"] and sha(html) in meta["block"] and sha(text["block"]) in meta["block"]
    head, _, rest = text["record"].partition("\r\n\r\n")
    assert head.startswith("WARC/1.1\r\nWARC-Type: conversion\r\n") and "WARC-Refers-To: <urn:uuid:1>" in head
    size = int(head.rsplit("Content-Length: ", 1)[1])
    assert rest.encode() == text["block"].encode() + b"\r\n\r\n" and size == len(text["block"].encode())
    none = [r for r in out if r["target_uri"] is None]
    assert len(none) == 2 and len({r["refers_to"] for r in none}) == 1 and none[0]["refers_to"].startswith("<urn:uuid:")
    assert any(r["block"] == "" for r in none) and all("Target-URI" not in r["record"] for r in none)


def test_empty_table(spark):
    assert warc.derivatives(spark.createDataFrame([], SCHEMA)).count() == 0
