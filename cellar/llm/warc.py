"""WARC derivatives: each response gives a metadata record and a plain-text conversion record.

Both refer to the response by its record id and to each other; the metadata
block keeps the source's headers, length and digests. All of it is SQL
functions, so responses stream through one stage without a shuffle.

Defined results: a null body counts as empty (both records are written, the
text is empty); a null target address or date leaves that header out; a null
record id is replaced by one derived from address and body; repeated responses
give repeated records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellar.llm.common import free_name

#: Elements that end a line of the plain text, and elements whose content is no text (fixed values).
BLOCKS = ("address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
          "head header hr html legend li main nav ol option p pre section select table tbody td tfoot th thead title tr ul").split()
HIDDEN = "script style noscript template".split()
#: Named character references that are resolved (fixed values); ampersands come last.
ENTITIES = {"nbsp": " ", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "copy": "©", "reg": "®", "middot": "·",
            "hellip": "…", "ndash": "–", "mdash": "—", "laquo": "«", "raquo": "»", "lsquo": "‘",
            "rsquo": "’", "ldquo": "“", "rdquo": "”", "euro": "€", "bull": "•", "amp": "&"}
HEX32, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_digest(digest: Column) -> Column:
    """A hexadecimal SHA-1 (a column of its own, so that it is computed once) as WARC labels it: 32 base-32 digits."""
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.concat(F.lit("sha1:"), F.translate(F.concat(*parts), HEX32, BASE32))


def derived_id(*parts: Column) -> Column:
    """A record id that depends on the parts alone."""
    h = F.md5(F.concat_ws("\n", *parts).cast("binary"))
    cut = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _numbered(text: Column) -> Column:
    """Numeric character references resolved; those outside Unicode stay."""
    parts = F.split(text, "&#")

    def one(p: Column) -> Column:
        digits = F.regexp_extract(p, r"^([0-9]{1,7});", 1)
        hexes = F.regexp_extract(p, r"^[xX]([0-9a-fA-F]{1,6});", 1)
        code = F.when(digits != "", digits.cast("long")).when(hexes != "", F.conv(hexes, 16, 10).cast("long"))
        fine = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        letter = F.decode(F.unhex(F.lpad(F.hex(F.when(fine, code).otherwise(F.lit(32))), 8, "0")), "UTF-32")
        return F.when(fine, F.concat(letter, F.substring(p, F.instr(p, ";") + 1, F.length(p)))).otherwise(F.concat(F.lit("&#"), p))

    rest = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(1))), one)
    return F.when(F.contains(text, F.lit("&#")), F.concat(F.get(parts, 0), F.array_join(rest, ""))).otherwise(text)


def _any_of(names: list[str]) -> str:
    """A pattern for any of ``names``, which are in order, with first letters shared."""
    shared = ((first, [n[1:] for n in names if n[0] == first]) for first in sorted({n[0] for n in names}))
    return "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in shared)


def _named(text: Column) -> Column:
    """Named character references resolved; texts that hold the commonest ones alone take a short way."""
    t = F.replace(text, F.lit("&nbsp;"), F.lit(ENTITIES["nbsp"]))
    every = t
    for name, letter in ENTITIES.items():
        if name not in ("nbsp", "amp"):
            every = F.replace(every, F.lit(f"&{name};"), F.lit(letter))
    t = F.when(F.rlike(t, F.lit("&(?!amp;)[a-z]")), every).otherwise(t)
    return F.replace(t, F.lit("&amp;"), F.lit(ENTITIES["amp"]))


def _without_tags(html: Column) -> Column:
    """A page without comments, hidden elements and tags; blocks end lines."""
    t = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    for tags in (HIDDEN[:2], HIDDEN[2:]):  # the rarer two are looked for together first
        cut = t
        for tag in tags:
            cut = F.regexp_replace(cut, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", "")
        t = cut if tags == HIDDEN[:2] else F.when(F.rlike(t, F.lit(rf"(?i)<(?:{'|'.join(tags)})\b")), cut).otherwise(t)
    t = F.regexp_replace(t, r"[\t\n\x0B\f\r]", " ")
    t = F.regexp_replace(t, rf"(?i)</?(?:{_any_of(BLOCKS)})\b[^>]*>", "\n")
    return F.regexp_replace(t, r"<[/!?a-zA-Z][^>]*>", "")


def _tidy(text: Column) -> Column:
    """Single spaces, no empty lines."""
    t = F.regexp_replace(F.regexp_replace(text, " {2,}", " "), " ?\n[ \n]*", "\n")
    return F.btrim(t, F.lit(" \n"))


def with_plain_text(pages: DataFrame, html: str, out: str) -> DataFrame:
    """``pages`` with the visible text of column ``html``: one line for each block, single spaces, no empty lines.

    Each step is a column of its own: what several branches of a step read is worked out once.
    """
    step = free_name(pages, "stripped")
    df = pages.withColumn(step, _without_tags(F.col(html))).withColumn(step, _numbered(F.col(step)))
    return df.withColumn(out, _tidy(_named(F.col(step)))).drop(step)


def derivatives(responses: DataFrame) -> DataFrame:
    """Two rows per response (record_id, target_uri, date, http_headers, body, all strings).

    record_type, record_id, refers_to, concurrent_to, target_uri, date,
    content_type, content_length, block_digest, source_digest, source_headers, block.
    """
    r = responses.select("record_id", "target_uri", "date", F.coalesce("http_headers", F.lit("")).alias("headers"),
                         F.coalesce("body", F.lit("")).alias("body"))
    r = r.withColumn("record_id", F.coalesce("record_id", derived_id(F.lit("response"), F.coalesce("target_uri", F.lit("")), F.col("body"))))
    r = with_plain_text(r, "body", "plain")
    r = r.select("*", F.sha1(F.col("body").cast("binary")).alias("body_sha"),
                 derived_id(F.lit("metadata"), F.col("record_id")).alias("metadata_id"),
                 derived_id(F.lit("conversion"), F.col("record_id")).alias("conversion_id"))
    r = r.withColumn("plain_sha", F.sha1(F.col("plain").cast("binary")))
    r = r.withColumn("source_digest", base32_digest(F.col("body_sha"))).withColumn("plain_digest", base32_digest(F.col("plain_sha")))
    lines = F.concat(
        F.lit("source-record-id: "), F.col("record_id"), F.lit("\r\nsource-payload-digest: "), F.col("source_digest"),
        F.lit("\r\nsource-payload-length: "), F.octet_length("body").cast("string"),
        F.lit("\r\nconversion-digest: "), F.col("plain_digest"), F.lit("\r\n"),
        F.regexp_replace("headers", r"(?m)^([^\r\n]+)", r"source-header: $1"), F.lit("\r\n"))
    r = r.withColumn("lines", lines)
    r = r.withColumn("lines_sha", F.sha1(F.col("lines").cast("binary")))
    r = r.withColumn("lines_digest", base32_digest(F.col("lines_sha")))
    record = lambda kind, own, other, mime, block: F.struct(
        F.lit(kind).alias("record_type"), F.col(own).alias("record_id"), F.col("record_id").alias("refers_to"),
        F.col(other).alias("concurrent_to"), F.col("target_uri"), F.col("date"), F.lit(mime).alias("content_type"),
        F.octet_length(block).cast("long").alias("content_length"), F.col(f"{block}_digest").alias("block_digest"),
        F.col("source_digest"), F.col("headers").alias("source_headers"), F.col(block).alias("block"))
    return r.select(F.inline(F.array(
        record("metadata", "metadata_id", "conversion_id", "application/warc-fields", "lines"),
        record("conversion", "conversion_id", "metadata_id", "text/plain", "plain"))))


def record_text() -> Column:
    """A row of ``derivatives`` as WARC/1.1 record text: header lines, empty line, block, two line ends."""
    line = lambda name, c: F.when(c.isNotNull(), F.concat(F.lit(name + ": "), c.cast("string"), F.lit("\r\n")))
    names = {"WARC-Type": "record_type", "WARC-Record-ID": "record_id", "WARC-Refers-To": "refers_to",
             "WARC-Concurrent-To": "concurrent_to", "WARC-Target-URI": "target_uri", "WARC-Date": "date",
             "WARC-Block-Digest": "block_digest", "Content-Type": "content_type", "Content-Length": "content_length"}
    head = F.concat_ws("", *[line(n, F.col(c)) for n, c in names.items()])
    return F.concat(F.lit("WARC/1.1\r\n"), head, F.lit("\r\n"), F.col("block"), F.lit("\r\n\r\n"))


def responses_of(pages: DataFrame) -> DataFrame:
    """Response records of ``pages`` (page_id, url, html), in the shape ``derivatives`` reads."""
    size = F.octet_length(F.coalesce("html", F.lit(""))).cast("string")
    return pages.select(
        derived_id(F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce("url", F.lit(""))).alias("record_id"),
        F.col("url").alias("target_uri"), F.lit("2024-01-01T00:00:00Z").alias("date"),
        F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit("\r\n")).alias("http_headers"),
        F.col("html").alias("body"))


def _sql_uuid(expression: str) -> str:
    h = f"md5({expression})"
    cut = " || '-' || ".join(f"substr({h}, {at}, {n})" for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"'<urn:uuid:' || {cut} || '>'"


def _sql_sha1(expression: str) -> str:
    return (f"'sha1:' || list_aggregate(list_transform(range(32), lambda i: substr('{BASE32}', ((('0x' || substr(sha1({expression}), "
            "(i // 8) * 10 + 1, 10))::BIGINT >> (35 - 5 * (i % 8))::BIGINT) & 31)::BIGINT + 1, 1)), 'string_agg', '')")


def oracle_sql() -> str:
    """The query over ``pages`` in DuckDB's SQL; patterns and lists are written out in full there."""
    text = "regexp_replace(html, '<!--.*?-->', '', 'gs')"
    for tag in ("script", "style", "noscript", "template"):
        text = f"regexp_replace({text}, '<{tag}\\b[^>]*>.*?</{tag}\\s*>', '', 'gis')"
    text = f"regexp_replace({text}, '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g')"
    blocks = ("address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|head|header|hr|html|"
              "legend|li|main|nav|ol|option|p|pre|section|select|table|tbody|td|tfoot|th|thead|title|tr|ul")
    text = f"regexp_replace({text}, '</?(?:{blocks})\\b[^>]*>', chr(10), 'gi')"
    text = f"regexp_replace({text}, '<[/!?a-zA-Z][^>]*>', '', 'g')"
    names = dict(zip("nbsp lt gt quot apos copy reg middot hellip ndash mdash laquo raquo lsquo rsquo ldquo rdquo euro bull amp".split(),
                     (32, 60, 62, 34, 39, 169, 174, 183, 8230, 8211, 8212, 171, 187, 8216, 8217, 8220, 8221, 8364, 8226, 38)))
    named = "numbered"
    for n, code in names.items():
        named = f"replace({named}, '&{n};', chr({code}))"
    code = ("CASE WHEN regexp_matches(p, '^[0-9]{1,7};') THEN regexp_extract(p, '^([0-9]{1,7});', 1)::BIGINT "
            "WHEN regexp_matches(p, '^[xX][0-9a-fA-F]{1,6};') THEN ('0x' || regexp_extract(p, '^[xX]([0-9a-fA-F]{1,6});', 1))::BIGINT END")
    one = (f"CASE WHEN ({code}) > 0 AND ({code}) < 1114112 AND ({code}) NOT BETWEEN 55296 AND 57343 "
           f"THEN chr(({code})::INTEGER) || substr(p, instr(p, ';') + 1) ELSE '&#' || p END")
    return f"""
WITH source AS (
  SELECT {_sql_uuid("concat_ws(chr(10), 'response', coalesce(page_id::VARCHAR, ''), coalesce(url, ''))")} AS record_id, url AS target_uri,
         coalesce(html, '') AS html,
         'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10)
           || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) AS headers
  FROM pages),
stripped AS (SELECT *, {text} AS s FROM source),
numbers AS (
  SELECT *, CASE WHEN contains(s, '&#') THEN string_split(s, '&#')[1]
    || coalesce(list_aggregate(list_transform(string_split(s, '&#')[2:], lambda p: {one}), 'string_agg', ''), '') ELSE s END AS numbered
  FROM stripped),
named AS (SELECT *, regexp_replace(regexp_replace({named}, ' +', ' ', 'g'), ' ?\\n[ \\n]*', chr(10), 'g') AS n FROM numbers),
text AS (SELECT *, regexp_replace(n, '^[ \\n]+|[ \\n]+$', '', 'g') AS plain, {_sql_sha1("html")} AS source_digest FROM named),
ids AS (
  SELECT *, {_sql_uuid("concat_ws(chr(10), 'metadata', record_id)")} AS metadata_id,
         {_sql_uuid("concat_ws(chr(10), 'conversion', record_id)")} AS conversion_id,
         'source-record-id: ' || record_id || chr(13) || chr(10) || 'source-payload-digest: ' || source_digest || chr(13) || chr(10)
           || 'source-payload-length: ' || strlen(html) || chr(13) || chr(10) || 'conversion-digest: ' || {_sql_sha1("plain")}
           || chr(13) || chr(10) || 'source-header: ' || replace(rtrim(headers, chr(13) || chr(10)), chr(13) || chr(10),
              chr(13) || chr(10) || 'source-header: ') || chr(13) || chr(10) || chr(13) || chr(10) AS lines
  FROM text),
records AS (
  SELECT 'metadata' AS record_type, metadata_id AS own, conversion_id AS other, 'application/warc-fields' AS content_type, lines AS block, * FROM ids
  UNION ALL
  SELECT 'conversion', conversion_id, metadata_id, 'text/plain', plain, * FROM ids)
SELECT record_type, own AS record_id, record_id AS refers_to, other AS concurrent_to, target_uri, '2024-01-01T00:00:00Z' AS date,
       content_type, strlen(block)::BIGINT AS content_length, {_sql_sha1("block")} AS block_digest, source_digest,
       headers AS source_headers, block
FROM records"""
