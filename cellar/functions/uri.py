"""Reference resolution of RFC 3986 (section 5), as JVM-side Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# scheme: | //authority | path | ?query | #fragment, each with its delimiter, so that '' means absent
URI = r"(?s)^([A-Za-z][A-Za-z0-9+.\-]*+:)?(//[^/?#]*+)?([^?#]*+)(\?[^#]*+)?(#.*)?$"
DOT_SEGMENT = r"(?:^|/)\.\.?(?:/|$)"
# What a URL attribute may hold around and inside a reference without being part of it.
EDGE_BLANKS = r"^[\x00-\x20]+|[\x00-\x20]+$"
INNER_BLANKS = r"[\t\r\n]"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bound(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with the value worked out once, however often ``fn`` names it."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def parts(uri: Column | str) -> Column:
    """STRUCT of the five parts, each with its delimiter; all '' for NULL."""
    u = F.coalesce(_c(uri), F.lit(""))
    return F.struct(*[F.regexp_extract(u, URI, i).alias(name)
                      for i, name in enumerate(("scheme", "authority", "path", "query", "fragment"), 1)])


def clean_reference(ref: Column | str) -> Column:
    """A reference as an attribute holds it, without blanks at its ends and tabs and line ends inside."""
    r = _c(ref)
    return F.when(r.rlike(r"[\x00-\x20]"), F.regexp_replace(F.regexp_replace(r, EDGE_BLANKS, ""), INNER_BLANKS, "")).otherwise(r)


def remove_dot_segments(path: Column | str) -> Column:
    """Section 5.2.4 for paths that start with ``/``; others stay as they are.

    Segments are taken from the last to the first: ``..`` skips one, which is
    what taking the last one off a stack comes to. Copies the path once a
    segment, only where it has a dot segment.
    """
    none = F.lit(0)

    def step(acc: Column, s: Column) -> Column:
        dot, dots = s == ".", s == ".."
        skip = acc["skip"]
        kept = ~dot & ~dots & (skip == 0)
        left = F.when(dots, skip + 1).when(dot | (skip == 0), skip).otherwise(skip - 1)
        end = F.when((dot | dots) & ~acc["open"], F.lit("/")).otherwise(acc["out"])  # a dot segment at the end leaves its slash
        return F.struct(left.alias("skip"), F.lit(True).alias("open"),
                        F.when(kept, F.concat(F.lit("/"), s, acc["out"])).otherwise(end).alias("out"))

    def cleaned(p: Column) -> Column:
        segments = F.reverse(F.split(F.substr(p, F.lit(2)), "/", -1))
        return F.aggregate(segments, start, step, lambda acc: F.when(acc["out"] == "", F.lit("/")).otherwise(acc["out"]))

    start = F.struct(none.alias("skip"), F.lit(False).alias("open"), F.lit("").alias("out"))
    return bound(_c(path), lambda p: F.when(p.startswith("/") & p.rlike(DOT_SEGMENT), cleaned(p)).otherwise(p))


def resolve(base: Column | str, ref: Column | str) -> Column:
    """The target of ``ref`` on a page at ``base``, its fragment included.

    NULL if the reference is NULL, or if it is relative and the base is NULL or has
    no scheme and authority (``mailto:``, a bare path).
    """
    return bound(parts(base), lambda b: resolve_parts(b, ref))  # an absolute reference needs no base


def resolve_parts(base: Column, ref: Column | str) -> Column:
    """``resolve`` against a base given by its ``parts``, for many references of one page."""
    return F.when(_c(ref).isNotNull(), bound(parts(ref), lambda r: _target(base, r)))


def _target(b: Column, r: Column) -> Column:
    absolute = r["scheme"] != ""
    full = absolute | (r["authority"] != "")
    merged = F.when(b["path"] == "", F.concat(F.lit("/"), r["path"])).otherwise(
        F.concat(F.regexp_extract(b["path"], r"(?s)^(.*/)", 1), r["path"]))
    path = F.when(full | r["path"].startswith("/"), r["path"]).when(r["path"] == "", b["path"]).otherwise(merged)
    cleaned = F.when(~full & (r["path"] == ""), path).otherwise(remove_dot_segments(path))
    query = F.when(full | (r["path"] != "") | (r["query"] != ""), r["query"]).otherwise(b["query"])
    out = F.concat(F.when(absolute, r["scheme"]).otherwise(b["scheme"]),
                   F.when(full, r["authority"]).otherwise(b["authority"]), cleaned, query, r["fragment"])
    return F.when(absolute | ((b["scheme"] != "") & (b["authority"] != "")), out)


def without_fragment(uri: Column | str) -> Column:
    return F.substring_index(_c(uri), "#", 1)
