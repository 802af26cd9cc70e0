import pytest
from pyspark.sql import functions as F

from cellar.functions.keys import (
    host_rev,
    host_under_domain,
    java_trim,
    key_reject_reason,
    md5_key,
    nonblank_trimmed,
    reversed_host_key,
    row_key,
)
from cellar.functions.body import response_body

KEY_ROWS = [
    ("http://u@a.b.org:80/x", "r:http://u@org.b.a:80/x"),
    ("http://host", "r:http://host"),
    ("http://a..b/", "r:http://b.a/"),
    ("http://a.b/", "r:http://b.a/"),
    ("http://1.2.3.4/", "r:http://4.3.2.1/"),
    ("mailto:joe", "mailto:joe"),
    ("dns:a.b", "dns:a.b"),
    ("http://a.b/?q=c.d#e.f", "r:http://b.a/?q=c.d#e.f"),
    ("https://www.example.com/a/b.html", "r:https://com.example.www/a/b.html"),
]


def test_reversed_host_key(spark):
    df = spark.createDataFrame(KEY_ROWS, "url string, want string")
    got = df.select("want", reversed_host_key("url").alias("k")).collect()
    assert all(r.k == r.want for r in got), got


def test_reject_already_keyed(spark):
    df = spark.createDataFrame([("r:http://b/",), ("http://b/",), (None,)], "url string")
    got = [r[0] for r in df.select(key_reject_reason("url")).collect()]
    assert got == ["already_keyed", None, "null_url"]


def test_md5_key_hashes_reversed_key(spark):
    import hashlib

    df = spark.createDataFrame([("http://a.b/x",)], "url string")
    r = df.select(row_key("url", md5=True).alias("m"), md5_key(reversed_host_key("url")).alias("m2")).first()
    assert r.m == hashlib.md5(b"r:http://b.a/x").hexdigest() == r.m2


@pytest.mark.parametrize(
    "raw,want",
    [("\t a b \r\n", "a b"), (" \n", None), (" x", " x"), (None, None), ("x", "x")],
)
def test_java_trim(spark, raw, want):
    df = spark.createDataFrame([(raw,)], "s string")
    assert df.select(nonblank_trimmed("s")).first()[0] == want


def test_java_trim_keeps_inner(spark):
    df = spark.createDataFrame([("\x00\x01 a\tb \x1f",)], "s string")
    assert df.select(java_trim("s")).first()[0] == "a\tb"


def test_response_body(spark):
    rows = [(b"H: 1\r\n\r\nbody\r\n\r\nmore",), (b"no blank line",), (b"H\r\n\r\n\xff\xfe\x00",), (b"",)]
    df = spark.createDataFrame(rows, "raw binary")
    got = [bytes(r[0]) for r in df.select(response_body("raw")).collect()]
    assert got == [b"body\r\n\r\nmore", b"no blank line", b"\xff\xfe\x00", b""]


def test_host_under_domain(spark):
    urls = ["http://example.org", "http://example.org/x", "https://WWW.Example.org/", "http://u:p@example.org:8080/", "ftp://a.example.org/",
            "http://examplex.org/", "http://example.com/", "mailto:x@example.org", "http://org.example/"]
    df = spark.createDataFrame([(u,) for u in urls], "url string").withColumn("host_rev", host_rev("url"))
    got = [r.url for r in df.filter(host_under_domain("host_rev", "Example.org")).collect()]
    assert got == urls[:5]
