"""Example content hooks over HTML bodies: title, links and visible text.

All three are built-in regex expressions (JVM-side, codegen'd); the patterns
stay within the subset that Java regex and RE2 read the same way. For a scan
that knows comments, quotes and character references see ``htmlscan``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TITLE = r"(?is)<title[^>]*>(.*?)</title>"
HREF = r'(?i)<a[ \t\r\n\f][^>]*?href="([^"]*)"'
SCRIPT = r"(?is)<script[^>]*>.*?</script>"
STYLE = r"(?is)<style[^>]*>.*?</style>"
COMMENT = r"(?s)<!--.*?-->"
TAG = r"<[^>]*>"
BLANKS = r"[ \t\r\n\f]+"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(body: Column | str) -> Column:
    """Decode a BINARY body as UTF-8 (invalid bytes become U+FFFD)."""
    return F.decode(_c(body), "UTF-8")


def extract_title(html: Column | str) -> Column:
    """Text of the first <title>, trimmed; NULL if there is none or it is blank."""
    t = F.trim(F.regexp_replace(F.regexp_extract(_c(html), TITLE, 1), BLANKS, " "))
    return F.when(F.length(t) > 0, t)


def extract_links(html: Column | str) -> Column:
    """ARRAY<STRING> of href targets of anchor tags, in document order."""
    return F.regexp_extract_all(_c(html), F.lit(HREF), 1)


def extract_text(html: Column | str) -> Column:
    """Visible text: drop script, style and comments, then tags, then fold blanks.
    Character entities stay encoded."""
    h = _c(html)
    for pat in (SCRIPT, STYLE, COMMENT):
        h = F.regexp_replace(h, pat, " ")
    h = F.regexp_replace(h, TAG, " ")
    return F.trim(F.regexp_replace(h, BLANKS, " "))
