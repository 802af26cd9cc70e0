"""The HTML scan against a scanner that goes by characters, and reference resolution against the RFC's own examples."""

import html as stdlib
import random
from urllib.parse import urljoin

from pyspark.sql import functions as F

from cellar.functions import htmlscan, uri

BLANK = " \t\r\n\f"
RAW = {"script", "style", "xmp", "iframe", "noembed", "noframes", "title", "textarea"}


def scan(page):
    """Tokens of a page, by one loop over its characters."""
    out, i, n = [], 0, len(page)

    def name_at(j):
        k = j
        while k < n and page[k] not in BLANK + "/>":
            k += 1
        return page[j:k].lower(), k

    def tag_end(k):
        while k < n and page[k] != ">":
            if page[k] != "=":
                k += 1
                continue
            k += 1
            while k < n and page[k] in BLANK:
                k += 1
            if k < n and page[k] in "\"'":
                close = page.find(page[k], k + 1)
                k = n if close < 0 else close + 1
            else:
                while k < n and page[k] not in BLANK + ">":
                    k += 1
        return min(n, k + 1)

    while i < n:
        if page[i] != "<":
            j = page.find("<", i)
            j = n if j < 0 else j
        elif page.startswith("<!--", i):
            j = page.find("-->", i + 4)
            j = n if j < 0 else j + 3
        elif i + 1 < n and page[i + 1].isalpha() and page[i + 1].isascii():
            name, k = name_at(i + 1)
            j = tag_end(k)
            if name in RAW:
                while True:
                    at = page.lower().find("</" + name, j)
                    if at < 0:
                        j = n
                        break
                    after = at + 2 + len(name)
                    if after >= n or page[after] in BLANK + "/>":
                        close = page.find(">", after)
                        j = n if close < 0 else close + 1
                        break
                    j = at + 2
        elif page.startswith("</", i) and i + 2 < n and page[i + 2].isalpha() and page[i + 2].isascii():
            j = tag_end(name_at(i + 2)[1])
        elif i + 1 < n and page[i + 1] in "!?/":
            j = page.find(">", i + 2)
            j = n if j < 0 else j + 1
        else:
            j = i + 1
        out.append(page[i:j])
        i = j
    return out


def random_pages(count, seed):
    rng = random.Random(seed)
    bits = ["<", ">", "<!--", "-->", "--", "<a ", "href=", "HREF = ", "\"", "'", "/x", "x>y", "</a>", "<script>", "</script >", "</scripty>",
            "<title>", "</TITLE>", "<textarea a='>'>", "</textarea", "&amp;", "&#65;", "&lt", " ", "\n", "=", "<p", "/", "<!DOCTYPE x>", "</", "<?x", "é", "word"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(count)]


def test_tokens_equal_a_scan_by_characters(spark):
    pages = [*random_pages(3000, 5), "", "<", "<!--", "<a href=\"x", "<p title=it's>b", "<script>a<!-- </p> </script>b", "<title"]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)] + [(-1, None)], "id long, page string")
    got = {r["id"]: r["t"] for r in df.select("id", htmlscan.tokens("page").alias("t")).collect()}
    assert got.pop(-1) is None
    for i, p in enumerate(pages):
        assert got[i] == scan(p), p


def test_long_pages_stay_linear(spark):
    pages = ["<a b=\"" * 200_000, "<p a='1' b=2 " * 100_000, "<!--" * 300_000, "<script>" * 150_000, "&" * 300_000, "<" * 300_000, "x" * 1_000_000]
    df = spark.createDataFrame([(p,) for p in pages], "page string").withColumn("t", htmlscan.tokens("page"))
    rows = df.select(F.length(F.array_join("t", "")).alias("n"), F.length(htmlscan.page_text("t")).alias("m"), htmlscan.page_title("t").alias("title")).collect()
    assert [r["n"] for r in rows] == [len(p) for p in pages] and rows[-1]["m"] == 1_000_000


def test_title_text_and_links(spark):
    page = ("<!-- <title>no</title> --><html><TITLE lang=x>\n A &lt;b&gt; &amp;lt; &#x41;&#66;&#128; </TITLE>"
            "<script>document.write('<a href=\"/no\">')</script><base href='/dir/'>"
            "<p title='a>b'>wo<b>rd</b><!-- x -->s<br>next<textarea><i>raw</i></textarea> 1 < 2 &unknown; &copy</p>"
            "<A data-href=/no HREF = 'x y?a=1&amp;b=2' href=/second>l</a><a href=../up/./z#f>m</a><a name=q>n</a><abbr href=/no>"
            "<a href=\" //Other.example/ \">o</a><a href>e</a><a href='mailto:me@x'>p</a>")
    df = spark.createDataFrame([(page, "http://www.example.org/a/b?q#f")], "page string, url string").withColumn("t", htmlscan.tokens("page"))
    r = df.select(htmlscan.page_title("t").alias("title"), htmlscan.page_text("t").alias("text"), htmlscan.page_links("t", "url").alias("links")).first()
    assert r["title"] == "A <b> &lt; AB€"
    assert r["text"] == "words next <i>raw</i> 1 < 2 &unknown; &copy lmnoep"
    assert [(x["href"], x["target"]) for x in r["links"]] == [
        ("x y?a=1&b=2", "http://www.example.org/dir/x y?a=1&b=2"), ("../up/./z#f", "http://www.example.org/up/z#f"),
        (" //Other.example/ ", "http://Other.example/"), ("", "http://www.example.org/dir/"), ("mailto:me@x", "mailto:me@x")]
    keys = [x["target_key"] for x in htmlscan.link_rows(df.drop("t"), F.col("page")).orderBy("position").collect()]
    assert keys[1] == "r:http://org.example.www/up/z" and keys[-1] == "mailto:me@x"


def test_character_references(spark):
    texts = ["&amp;amp;", "&#0;&#xD800;&#x110000;", "&#x1F600;&#99999999;", "&eacute;&Eacute;&nope;", "a&b", "&", "&#;", "&#x;", "&apos;&quot;", "&#150;", "&amp"]
    want = ["&amp;", "���", "\U0001F600�", "éÉ&nope;", "a&b", "&", "&#;", "&#x;", "'\"", "–", "&amp"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    got = [r["d"] for r in df.select("id", htmlscan.decode_references("t").alias("d")).orderBy("id").collect()]
    assert got == want
    assert all(stdlib.unescape(t) == w for t, w in zip(texts[3:5], want[3:5]))


# Reference -> target at http://a/b/c/d;p?q. The examples of RFC 3986, sections 5.4.1 and 5.4.2.
RFC = {
    "g:h": "g:h", "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/", "/g": "http://a/g", "//g": "http://g",
    "?y": "http://a/b/c/d;p?y", "g?y": "http://a/b/c/g?y", "#s": "http://a/b/c/d;p?q#s", "g#s": "http://a/b/c/g#s",
    "g?y#s": "http://a/b/c/g?y#s", ";x": "http://a/b/c/;x", "g;x": "http://a/b/c/g;x", "g;x?y#s": "http://a/b/c/g;x?y#s",
    "": "http://a/b/c/d;p?q", ".": "http://a/b/c/", "./": "http://a/b/c/", "..": "http://a/b/", "../": "http://a/b/", "../g": "http://a/b/g",
    "../..": "http://a/", "../../": "http://a/", "../../g": "http://a/g",
    "../../../g": "http://a/g", "../../../../g": "http://a/g", "/./g": "http://a/g", "/../g": "http://a/g", "g.": "http://a/b/c/g.",
    ".g": "http://a/b/c/.g", "g..": "http://a/b/c/g..", "..g": "http://a/b/c/..g", "./../g": "http://a/b/g", "./g/.": "http://a/b/c/g/",
    "g/./h": "http://a/b/c/g/h", "g/../h": "http://a/b/c/h", "g;x=1/./y": "http://a/b/c/g;x=1/y", "g;x=1/../y": "http://a/b/c/y",
    "g?y/./x": "http://a/b/c/g?y/./x", "g?y/../x": "http://a/b/c/g?y/../x", "g#s/./x": "http://a/b/c/g#s/./x", "g#s/../x": "http://a/b/c/g#s/../x",
    "http:g": "http:g",
}


def test_resolution_gives_the_targets_of_the_rfc(spark):
    df = spark.createDataFrame(list(RFC.items()), "ref string, want string")
    bad = df.withColumn("got", uri.resolve(F.lit("http://a/b/c/d;p?q"), "ref")).filter("NOT got <=> want").collect()
    assert bad == []


def test_resolution_of_random_paths(spark):
    rng = random.Random(9)
    rows = []
    for _ in range(500):
        segs = [rng.choice(["a", "b", ".", "..", "c"]) for _ in range(rng.randint(1, 8))]
        rows.append(("http://h" + rng.choice(["", "/", "/x", "/x/y/", "/x/y/z?q"]), rng.choice(["", "/"]) + "/".join(segs) + rng.choice(["", "/"])))
    df = spark.createDataFrame(rows, "base string, ref string")
    for r in df.select("base", "ref", uri.resolve("base", "ref").alias("got")).collect():
        assert r["got"] == urljoin(r["base"], r["ref"]), r
    none = spark.createDataFrame([(None, "a"), ("http://h/", None), ("mailto:x", "a"), ("x", "http://h/")], "base string, ref string")
    assert [r[0] for r in none.select(uri.resolve("base", "ref")).collect()] == [None, None, None, "http://h/"]
