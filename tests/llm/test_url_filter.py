import math
import re

import pyarrow.parquet as pq
from brute import SF0001
from pyspark.sql import functions as F

from cellar.llm import queries, url_filter


def _parts(url):
    if url is None or "://" not in url:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S)
    return re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]


def _rule(host, path):
    fits = [(len(r), v, r) for v, r in queries.SITE_RULES
            if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return max(fits)[1:] if fits else (None, None)


def _check(rows, urls):
    assert len(rows) == len(urls)
    for r in rows:
        host, path = _parts(urls[r["page_id"]])
        verdict, rule = _rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("block" if r["score"] >= 0.5 else "allow"))


def test_query_against_brute_force(spark):
    pages = pq.read_table(f"{SF0001}/pages.parquet").to_pylist()
    rows = queries.op7_url_filter(spark, SF0001).collect()
    _check(rows, {p["page_id"]: p["url"] for p in pages})
    learned = [r for r in rows if r["rule"] is None]
    assert any(r["verdict"] == "allow" for r in learned)


def test_labelled_sites_are_not_those_of_the_test_tables():
    def names(host):
        return set(host.split(".")) - {"www", "blog", "m", "test", "example", "com", "org", "net"}

    pages = set().union(*(names(_parts(u)[0]) for sf in (SF0001, "/root/testdata/sf0.01", "/root/testdata/sf0.1")
                          for u in pq.read_table(f"{sf}/pages.parquet").column("url").to_pylist()))
    labelled = set().union(*(names(u.split("/")[0]) for u in queries.BLOCKED_URLS + queries.ALLOWED_URLS))
    assert pages and not pages & labelled


def test_edge_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x", "http://com/", "http://com", "x://a.net/es/1", "x://net/es", "y://a.net/ES/1",
            "http://u@example.com:80/en/", "http://example.com/en/?q=http://b.net/fr/", "http://a.net/fr/#x", "http://xcom/", "http://a.com?b/", "a://é.net/fr/ü\nz"]
    df = spark.createDataFrame([(i, u, "clash", 1) for i, u in enumerate(urls)] + [(1, "", "clash", 1)][:0], "page_id long, url string, host string, score int")
    labelled = spark.createDataFrame([("http://spam.test/buy", 1), ("http://good.test/read", 0), (None, 1), ("http://x.test", None)], "url string, label int")
    _check(url_filter.judge_urls(df, labelled, queries.SITE_RULES, buckets=1 << 10, steps=5).collect(), dict(enumerate(urls)))


def test_gradient_steps_equal_a_plain_loop(spark):
    urls = [("http://cheap-pills.test/buy", 1), ("http://pills.test/", 1), ("http://garden.test/a/b", 0), ("http://river.test/c", 0), ("http://river.test/c", 0)]
    df = spark.createDataFrame(urls, "url string, label int")
    x = [r[0] for r in df.select(url_filter.ngram_buckets(url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url")), (3, 4), 512)).collect()]
    y = [r[1] for r in df.collect()]
    n, positive = len(y), sum(y)
    bias, w, sq = math.log(positive / (n - positive)), [0.0] * 512, [1e-8] * 513
    for _ in range(4):
        g = [0.0] * 513
        for xi, yi in zip(x, y):
            e = 1 / (1 + math.exp(-(bias + sum(w[b] for b in xi) / math.sqrt(len(xi))))) - yi
            g[-1] += e
            for b in xi:
                g[b] += e / math.sqrt(len(xi))
        for b in {b for xi in x for b in xi} | {-1}:
            step = g[b] / n + (1e-3 * w[b] if b >= 0 else 0.0)
            sq[b] += step * step
            if b >= 0:
                w[b] -= 0.5 * step / math.sqrt(sq[b])
            else:
                bias -= 0.5 * step / math.sqrt(sq[b])
    got_bias, got = url_filter.fit(df, (3, 4), 512, steps=4)
    assert abs(got_bias - bias) < 1e-9 and max(abs(a - b) for a, b in zip(got, w)) < 1e-9


def test_one_class_and_empty_tables(spark):
    none = spark.createDataFrame([], "url string, label int")
    assert url_filter.fit(none, buckets=64) == (0.0, [0.0] * 64)
    assert url_filter.fit(spark.createDataFrame([("http://a", 1)], "url string, label int"), buckets=64)[0] == 5.0
    assert url_filter.judge_urls(spark.createDataFrame([], "page_id long, url string"), none, []).count() == 0
