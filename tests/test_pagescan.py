"""The scan in one pass against the SQL functions that define its results."""

import random

from pyspark.sql import functions as F

from cellar.functions import htmlscan, pagescan

BITS = ["<", ">", "<!--", "-->", "--", "<a ", "<A\n", "href=", "HREF = ", "\"", "'", "/x", "../y/.", "//h", "x>y", "</a>", "<base href=/b/>", "<b>", "</B>",
        "<script>", "</script >", "</scripty>", "<title>", "</TITLE>", "<textarea a='>'>", "</textarea", "</style>\n", "&amp;", "&#65;", "&#x80;",
        "&#0;", "&lt", "&nope;", "&apos;", " ", "\n", "=", "<p", "/", "<!DOCTYPE x>", "</", "<?x", "é", "word", "\u2028", "\u0085", "\u212a", "<mar\u212a>", "?q", "#f", "mailto:x", "\x01"]
URLS = ["http://www.example.org/a/b?q#f", "http://h", "https://u@h:8/x/./y/", "mailto:me@x", "", None, "/only/path", "http://h/a/../b"]


def test_one_pass_equals_the_functions_over_tokens(spark):
    rng = random.Random(11)
    rows = [(i, "".join(rng.choice(BITS) for _ in range(rng.randint(0, 40))), rng.choice(URLS)) for i in range(4000)]
    links = [f"<a href=\"{''.join(rng.choice(['a', '.', '..', '/', '//', '?', '#', ':', ' ', '&amp;', 'http:']) for _ in range(rng.randint(0, 7)))}\">" for _ in range(2000)]
    rows += [(5000 + i, x, rng.choice(URLS)) for i, x in enumerate(links)] + [(-1, None, "http://h/"), (-2, "", "http://h/")]
    df = spark.createDataFrame(rows, "id long, page string, url string").repartition(4).withColumn("t", htmlscan.tokens("page"))
    want = F.struct(htmlscan.page_title("t").alias("title"), htmlscan.page_text("t").alias("text"), htmlscan.page_links("t", "url").alias("links"))
    both = df.select("page", "url", want.alias("want"), pagescan.scan(F.col("page"), F.col("url")).alias("got"),
                     pagescan.scan_links(F.col("page"), F.col("url")).alias("links")).cache()
    assert both.count() == len(rows)
    bad = both.filter(~F.col("got").eqNullSafe(F.col("want")) | ~F.col("links").eqNullSafe(F.col("want.links"))).limit(3).collect()
    assert bad == []
    both.unpersist()


def test_long_pages_stay_linear():
    pages = ["<a b=\"" * 200_000, "<p a='1' b=2 " * 100_000, "<!--" * 300_000, "<script>" * 150_000, "&" * 300_000, "<" * 300_000, "x" * 1_000_000]
    got = [pagescan._scanned(p, "http://h/", True)[1] for p in pages]  # noqa: SLF001
    assert got[4:] == pages[4:]


def test_queries_scan_in_one_pass(spark):
    """scan_page and inlinks cut no page into a token list: each page's bytes are walked once."""
    from cellar.plans.queries import q_inlinks, q_scan_page

    for q in (q_scan_page, q_inlinks):
        plan = q(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()  # noqa: SLF001
        assert "regexp_extract_all" not in plan
