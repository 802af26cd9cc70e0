"""HTML scanned from left to right: title, text and links as a browser's scanner would see them.

One alternation cuts a page into tokens: comment, raw-text element, tag, other
markup, text. Each token ends where the scanner's state does: a ``>`` in a
quoted attribute value, a tag inside a comment and markup inside a script are
no ends. Every alternative also ends at the end of the page, so each ``<`` is
read once; all repetitions are possessive or reluctant, which keeps the scan
linear and off the thread's stack. Row-local and JVM-side.

Defined results: NULL for a NULL page; an unclosed comment, element, tag or
quote runs to the end of the page; character references need their semicolon,
unknown ones stay as they are; of repeated attributes the first one counts.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellar.functions import uri
from cellar.functions.keys import row_key

_S = r"[ \t\r\n\f]"
_END_OF_NAME = r"(?=[ \t\r\n\f/>]|\z)"
_VALUE = r"""(?:"[^"]*+(?:"|\z)|'[^']*+(?:'|\z)|(?!["'])[^ \t\r\n\f>]*+)"""
_REST_OF_TAG = rf"(?:[^>=]++|={_S}*+{_VALUE})*+(?:>|\z)"
# Elements whose content is no markup. Fixed values of HTML.
_RAW = "script|style|xmp|iframe|noembed|noframes|title|textarea"
_RAW_ELEMENT = rf"<({_RAW}){_END_OF_NAME}{_REST_OF_TAG}.*?(?:</\1{_END_OF_NAME}[^>]*+(?:>|\z)|\z)"
_TAG = rf"</?[a-z][^ \t\r\n\f/>]*+{_REST_OF_TAG}"
TOKEN = rf"(?is)<!--.*?(?:-->|\z)|{_RAW_ELEMENT}|{_TAG}|<[!?/][^>]*+(?:>|\z)|[^<]++|<"
_OPEN_RAW = rf"(?is)^<(?:{_RAW}){_END_OF_NAME}{_REST_OF_TAG}"
_CLOSE_RAW = rf"(?is)</(?:{_RAW}){_END_OF_NAME}[^>]*+>?$"
_ATTRIBUTE = rf"(?is)[^ \t\r\n\f/>=]*+{_S}*+={_S}*+{_VALUE}|[^ \t\r\n\f/>=]++"
# Elements inside a word or line; any other tag parts words. Fixed values of HTML.
_INLINE = "a|abbr|acronym|b|bdi|bdo|big|cite|code|em|font|i|kbd|mark|s|samp|small|span|strike|strong|sub|sup|tt|u|var|wbr"
_BLANKS = r"[ \t\r\n\f]+"
_REFERENCE = r"^(#[0-9]{1,8}|#[xX][0-9a-fA-F]{1,8}|[A-Za-z][A-Za-z0-9]{1,15});"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _named() -> dict[str, str]:
    """The names of HTML 4 and XML's apos."""
    return {**{k: chr(v) for k, v in name2codepoint.items()}, "apos": "'"}


def _windows_1252() -> dict[int, str]:
    """Numbers 128 to 159 mean the characters that Windows-1252 has there."""
    return {n: s for n in range(128, 160) if (s := bytes([n]).decode("cp1252", "ignore"))}


def _literal_map(table: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in sorted(table.items()) for x in kv])


def _character(number: Column) -> Column:
    return uri.bound(number, _of_code)


def _of_code(code: Column) -> Column:
    bad = (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    one = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    old = F.when(code.between(128, 159), F.coalesce(F.try_element_at(_literal_map(_windows_1252()), code.cast("int")), one))
    return F.when(bad, F.lit("�")).when(code.between(128, 159), old).otherwise(one)


def decode_references(text: Column | str) -> Column:
    """Character references resolved once, from left to right."""
    return uri.bound(_c(text), _decoded)


def _decoded(text: Column) -> Column:
    """``decode_references`` of a value that costs nothing to name again."""

    def resolved(p: Column, ref: Column) -> Column:
        number = F.when(F.lower(F.substr(ref, F.lit(2), F.lit(1))) == "x", F.conv(F.substr(ref, F.lit(3)), 16, 10)).otherwise(F.substr(ref, F.lit(2)))
        char = F.when(ref.startswith("#"), _character(number.cast("bigint"))).otherwise(F.try_element_at(_literal_map(_named()), ref))
        return F.coalesce(F.concat(char, F.substr(p, F.length(ref) + 2)), F.concat(F.lit("&"), p))

    def piece(p: Column, i: Column) -> Column:
        ref = F.regexp_extract(p, _REFERENCE, 1)
        return F.when(i == 0, p).otherwise(uri.bound(ref, lambda r: F.when(r == "", F.concat(F.lit("&"), p)).otherwise(resolved(p, r))))

    return F.when(text.contains("&"), F.array_join(F.transform(F.split(text, "&", -1), piece), "")).otherwise(text)


def tokens(page: Column | str) -> Column:
    """ARRAY<STRING> of the page's tokens; joined, they are the page."""
    return F.regexp_extract_all(_c(page), F.lit(TOKEN), 0)


def _is_element(token: Column, names: str) -> Column:
    likely = F.lower(F.substr(token, F.lit(1), F.lit(2))).isin(sorted({f"<{n[0]}" for n in names.split("|")}))  # spares most tokens the pattern
    return likely & token.rlike(rf"(?is)^<(?:{names}){_END_OF_NAME}")


def _content(token: Column) -> Column:
    """The content of a raw-text element."""
    return F.regexp_replace(F.regexp_replace(token, _OPEN_RAW, ""), _CLOSE_RAW, "")


def _folded(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, _BLANKS, " "))


def page_title(found: Column | str) -> Column:
    """Title of a page's ``tokens``: the first title element's text, references resolved and blanks folded; NULL if
    there is none or it is blank."""
    first = F.try_element_at(F.filter(_c(found), lambda t: _is_element(t, "title")), F.lit(1))
    text = _folded(decode_references(_content(first)))
    return F.when(F.length(text) > 0, text)


def page_text(found: Column | str) -> Column:
    """Text of a page's ``tokens``: references resolved, blanks folded; inline tags and comments part no words."""

    def shown(t: Column) -> Column:
        return (
            F.when(~t.startswith("<") | (t == "<"), _decoded(t))
            .when(_is_element(t, "textarea"), F.concat(F.lit(" "), decode_references(_content(t)), F.lit(" ")))
            .when(t.startswith("<!--") | t.rlike(rf"(?is)^</?(?:{_INLINE}){_END_OF_NAME}"), F.lit(""))
            .otherwise(F.lit(" "))
        )

    return _folded(F.array_join(F.transform(_c(found), shown), ""))


def attribute(tag: Column | str, name: str) -> Column:
    """Value of a tag's first attribute of that name, references resolved; NULL if it has none, '' if it has no value."""
    rest = F.regexp_replace(_c(tag), r"(?is)^<[a-z][^ \t\r\n\f/>]*+", "")
    every = F.regexp_extract_all(rest, F.lit(_ATTRIBUTE), 0)
    first = F.try_element_at(F.filter(every, lambda a: a.rlike(rf"(?is)^{name}(?:{_S}*+=|$)")), F.lit(1))
    raw = F.regexp_replace(first, rf"(?is)^{name}{_S}*+=?{_S}*+", "")
    return decode_references(F.regexp_replace(raw, r"""(?s)^"([^"]*+)"?\z|^'([^']*+)'?\z""", "$1$2"))


def page_links(found: Column | str, url: Column | str) -> Column:
    """ARRAY<STRUCT<href, target>> of the anchors with an href, in order. Targets are resolved against the first
    ``base`` element's href (itself resolved against ``url``) or else ``url``; NULL where that cannot be done."""
    u = _c(url)
    marked = F.filter(_c(found), lambda t: _is_element(t, "a|base"))
    hrefs = F.filter(F.transform(marked, lambda t: F.struct(_is_element(t, "base").alias("base"), attribute(t, "href").alias("href"))),
                     lambda x: x["href"].isNotNull())

    def resolved(xs: Column) -> Column:
        first = F.try_element_at(F.filter(xs, lambda x: x["base"]), F.lit(1))["href"]
        base = F.when(first.isNotNull(), uri.resolve(u, uri.clean_reference(first)))
        return uri.bound(uri.parts(F.coalesce(base, u)), lambda b: F.transform(
            F.filter(xs, lambda x: ~x["base"]),
            lambda x: F.struct(x["href"].alias("href"), uri.resolve_parts(b, uri.clean_reference(x["href"])).alias("target"))))

    return uri.bound(hrefs, resolved)


def link_rows(pages: DataFrame, page: Column, url: str = "url", md5: bool = False) -> DataFrame:
    """One row per link: all columns of ``pages``, position (from 0), href, target, target_key (the target's row key
    without its fragment)."""
    from cellar.functions.pagescan import scan_links  # reads this module's patterns

    out = pages.withColumn("__links", scan_links(page, _c(url))).select(
        *pages.columns, F.posexplode("__links").alias("position", "__link"))
    out = out.select(*pages.columns, F.col("position").cast("bigint").alias("position"), "__link.href", "__link.target")
    return out.withColumn("target_key", row_key(uri.without_fragment("target"), md5))
