"""Row keys and the string rules of the write path, as JVM-side Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# scheme://[userinfo@] | host | rest (port, path, query, fragment)
URL_PARTS = r"^([^:/?#]+://(?:[^/?#@]+@)?)([^:/?#]+)(.*)$"
# Java's String.trim() drops every char <= U+0020 at both ends.
JAVA_TRIM = r"^[\x00-\x20]+|[\x00-\x20]+$"
KEY_SCHEME = "r:"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def url_host(url: Column | str) -> Column:
    """Host part of a hierarchical URL, '' when the URL has no authority."""
    return F.regexp_extract(_c(url), URL_PARTS, 2)


def reverse_host(host: Column | str) -> Column:
    """'a.b.org' -> 'org.b.a'; empty labels are dropped."""
    labels = F.array_remove(F.split(_c(host), r"\.", -1), "")  # built-in, stays in codegen
    return F.array_join(F.reverse(labels), ".")


def reversed_host_key(url: Column | str) -> Column:
    """'http://u@a.b.org:80/x' -> 'r:http://u@org.b.a:80/x'; non-hierarchical URLs unchanged."""
    u = _c(url)
    key = F.concat(
        F.lit(KEY_SCHEME),
        F.regexp_extract(u, URL_PARTS, 1),
        reverse_host(F.regexp_extract(u, URL_PARTS, 2)),
        F.regexp_extract(u, URL_PARTS, 3),
    )
    return F.when(u.rlike(URL_PARTS), key).otherwise(u)


def md5_key(key: Column | str) -> Column:
    """Hex MD5 of the (already reversed) key."""
    return F.md5(F.encode(_c(key), "UTF-8"))


def row_key(url: Column | str, md5: bool = False) -> Column:
    k = reversed_host_key(url)
    return md5_key(k) if md5 else k


def key_reject_reason(url: Column | str) -> Column:
    """NULL for a usable URL, else why it cannot become a row key."""
    u = _c(url)
    return (
        F.when(u.isNull(), F.lit("null_url"))
        .when(u.startswith(KEY_SCHEME), F.lit("already_keyed"))
        .when(F.length(u) == 0, F.lit("empty_url"))
    )


def java_trim(s: Column | str) -> Column:
    return F.regexp_replace(_c(s), JAVA_TRIM, "")


def nonblank_trimmed(s: Column | str) -> Column:
    """Trimmed text, or NULL when absent or blank after trimming."""
    t = java_trim(s)
    return F.when(F.length(t) > 0, t)


def host_rev(url: Column | str) -> Column:
    """Reversed host in lower case ('org.example.www'), '' without one: what domain scans filter on."""
    return F.lower(reverse_host(url_host(url)))


def reversed_domain(domain: str) -> str:
    """'Example.org.' -> 'org.example', the form of ``host_rev``."""
    return ".".join(reversed([p for p in domain.lower().strip(".").split(".") if p]))


def host_under_domain(rev: Column | str, domain: str) -> Column:
    """The reversed host is the domain or a subdomain of it, whatever the URL's scheme,
    user part, port or key form; both conditions are pushed to Parquet."""
    c = _c(rev)
    want = reversed_domain(domain)
    return (c == want) | c.startswith(want + ".")
