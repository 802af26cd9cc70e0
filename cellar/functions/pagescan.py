"""The scan of ``htmlscan`` in one pass over each page, as an Arrow function.

``htmlscan`` defines the results and gives them as SQL functions over a page's
token list; there every step looks at every token again. Here one pattern walks
from tag to tag and title, text and links are taken up on the way. A batch of
pages goes in and out as Arrow columns; nothing is kept from page to page.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellar.functions import htmlscan, uri

_FLAGS = re.ASCII | re.IGNORECASE | re.DOTALL  # Java's (?is): case is folded in ASCII alone
_JAVA_END = "(?=(?:\r\n|[\n\r\u0085\u2028\u2029])?\\Z)"  # Java's $: also ahead of a last line end


def _pattern(java: str) -> re.Pattern:
    """A pattern of ``htmlscan`` or ``uri`` as Python writes it."""
    return re.compile(re.sub(r"^\(\?i?s\)", "", java).replace(r"\z", r"\Z"), _FLAGS)


_REST = htmlscan._REST_OF_TAG  # noqa: SLF001
_END = htmlscan._END_OF_NAME  # noqa: SLF001
#: Markup, cut into 1 a comment's start, 2 a raw-text element after its "<" and 3 its name, 4 a tag's name with the slash of an
#: end tag, 5 the tag's rest; other markup has none of them.
_MARKUP = _pattern(rf"<(?:(!--).*?(?:-->|\z)|(({htmlscan._RAW}){_END}{_REST}.*?(?:</\3{_END}[^>]*+(?:>|\z)|\z))"  # noqa: SLF001
                   rf"|(/?[a-z][^ \t\r\n\f/>]*+)({_REST})|[!?/][^>]*+(?:>|\z))")
_OPEN_RAW = _pattern(htmlscan._OPEN_RAW)  # noqa: SLF001
_CLOSE_RAW = _pattern(htmlscan._CLOSE_RAW.removesuffix("$") + _JAVA_END)  # noqa: SLF001
_ATTRIBUTE = _pattern(htmlscan._ATTRIBUTE)  # noqa: SLF001
_HREF = _pattern(rf"href(?:{htmlscan._S}*+=|{_JAVA_END})")  # noqa: SLF001
_HREF_NAME = _pattern(rf"href{htmlscan._S}*+=?{htmlscan._S}*+")  # noqa: SLF001
_QUOTED = _pattern(r"""(?s)"([^"]*+)"?\z|'([^']*+)'?\z""")
_REFERENCE = re.compile("&" + htmlscan._REFERENCE.removeprefix("^"))  # noqa: SLF001
_URI = re.compile(uri.URI.removeprefix("(?s)").replace("$", r"\Z"), re.DOTALL)
_CONTROL = re.compile(r"[\x00-\x20]")
_EDGE_BLANKS = re.compile(r"^[\x00-\x20]+|[\x00-\x20]+" + _JAVA_END)
_INNER_BLANKS = re.compile(uri.INNER_BLANKS)
_A, _BASE, _OTHER_INLINE = 1, 2, 3
_KINDS = {slash + n: _OTHER_INLINE for n in htmlscan._INLINE.split("|") for slash in ("", "/")} | {"a": _A, "base": _BASE}  # noqa: SLF001
_NAMED, _OLD = htmlscan._named(), htmlscan._windows_1252()  # noqa: SLF001

_LINK = T.StructType([T.StructField("href", T.StringType()), T.StructField("target", T.StringType())])
SCANNED = T.StructType([T.StructField("title", T.StringType()), T.StructField("text", T.StringType()), T.StructField("links", T.ArrayType(_LINK))])
_ARROW_LINK = pa.struct([("href", pa.string()), ("target", pa.string())])


def _character(m: re.Match) -> str:
    ref = m[1]
    if ref[0] != "#":
        return _NAMED.get(ref, m[0])
    code = int(ref[2:], 16) if ref[1] in "xX" else int(ref[1:])
    if code == 0 or code > 0x10FFFF or 0xD800 <= code <= 0xDFFF:
        return "\ufffd"
    return _OLD.get(code) or chr(code)


def _decoded(text: str) -> str:
    return _REFERENCE.sub(_character, text) if "&" in text else text


def _folded(text: str) -> str:
    for blank in "\t\r\n\f":
        text = text.replace(blank, " ")
    while "  " in text:  # halves the longest run
        text = text.replace("  ", " ")
    return text.strip(" ")


def _content(element: str) -> str:
    return _CLOSE_RAW.sub("", _OPEN_RAW.sub("", element, count=1))


def _href(rest: str) -> str | None:
    """``htmlscan.attribute`` of a tag, given after its name."""
    for a in _ATTRIBUTE.findall(rest):
        if _HREF.match(a):
            raw = a[_HREF_NAME.match(a).end():]
            quoted = _QUOTED.match(raw) if raw[:1] in ('"', "'") else None
            return _decoded((quoted[1] or quoted[2] or "") if quoted else raw)
    return None


def _parts(u: str | None) -> tuple[str, ...]:
    return _URI.match(u or "").groups("")


def _clean(ref: str) -> str:
    return _INNER_BLANKS.sub("", _EDGE_BLANKS.sub("", ref)) if _CONTROL.search(ref) else ref


def _without_dots(path: str) -> str:
    if path[:1] != "/" or "/." not in path:
        return path
    skip, ended, kept = 0, False, []  # kept: from the last segment to the first
    for s in reversed(path[1:].split("/")):
        if s in (".", ".."):
            if not ended:
                kept = ["/"]
            skip += s == ".."
        elif skip:
            skip -= 1
        else:
            kept.append("/" + s)
        ended = True
    return "".join(reversed(kept)) or "/"


def _target(b: tuple[str, ...], ref: str) -> str | None:
    """``uri.resolve_parts``."""
    scheme, authority, path, query, fragment = _parts(ref)
    if not scheme and not (b[0] and b[1]):
        return None
    if scheme or authority:
        return (scheme or b[0]) + authority + _without_dots(path) + query + fragment
    if not path:
        return b[0] + b[1] + b[2] + (query or b[3]) + fragment
    if path[0] != "/":
        path = ("/" + path) if not b[2] else b[2][:b[2].rfind("/") + 1] + path
    return b[0] + b[1] + _without_dots(path) + query + fragment


def _scanned(page: str, url: str | None, text: bool) -> tuple[str | None, str | None, list[tuple[str, str | None]]]:
    """Title, text (if asked for) and links of one page."""
    cut = iter(_MARKUP.split(page))
    title, titled, hrefs, base = None, False, [], None
    shown = [_decoded(next(cut))]
    for comment, raw, raw_name, name, rest, after in zip(cut, cut, cut, cut, cut, cut):
        if name is not None:
            kind = _KINDS.get(name) or (_KINDS.get(name.lower()) if name.isascii() else None)
            if kind == _A or kind == _BASE:
                href = _href(rest)
                if href is not None and kind == _A:
                    hrefs.append(href)
                elif href is not None and base is None:
                    base = href
            if kind is None or kind == _BASE:
                shown.append(" ")
        elif raw is not None:
            raw_name = raw_name.lower() if text else ""
            if raw_name == "title" and not titled:
                titled, title = True, _folded(_decoded(_content("<" + raw))) or None
            shown.append(f" {_decoded(_content('<' + raw))} " if raw_name == "textarea" else " ")
        elif comment is None:
            shown.append(" ")
        if text and after:
            shown.append(_REFERENCE.sub(_character, after) if "&" in after else after)
    own = _parts(url)
    if base is not None:
        found = _target(own, _clean(base))
        own = _parts(found) if found is not None else own
    return title, _folded("".join(shown)) if text else None, [(h, _target(own, _clean(h))) for h in hrefs]


def _scan_batch(pages: pa.Array, urls: pa.Array, text: bool) -> pa.Array:
    titles, texts, hrefs, targets, ends = [], [], [], [], [0]
    nulls = []
    for page, url in zip(pages.to_pylist(), urls.to_pylist()):
        title, shown, links = _scanned(page, url, text) if page is not None else (None, None, [])
        titles.append(title)
        texts.append(shown)
        nulls.append(page is None)
        hrefs += [h for h, _ in links]
        targets += [t for _, t in links]
        ends.append(len(hrefs))
    values = pa.StructArray.from_arrays([pa.array(hrefs, pa.string()), pa.array(targets, pa.string())], fields=list(_ARROW_LINK))
    links = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values, mask=pa.array(nulls, pa.bool_()))
    return pa.StructArray.from_arrays([pa.array(titles, pa.string()), pa.array(texts, pa.string()), links], names=["title", "text", "links"])


@F.arrow_udf(SCANNED)
def _scan_all(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for pages, urls in batches:
        yield _scan_batch(pages, urls, True)


@F.arrow_udf(SCANNED)
def _scan_links(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for pages, urls in batches:
        yield _scan_batch(pages, urls, False)


def scan(page: Column, url: Column) -> Column:
    """STRUCT<title, text, links>: ``page_title``, ``page_text`` and ``page_links`` of the page's tokens."""
    return _scan_all(page, url)


def scan_links(page: Column, url: Column) -> Column:
    """``page_links`` of the page's tokens."""
    return _scan_links(page, url)["links"]
