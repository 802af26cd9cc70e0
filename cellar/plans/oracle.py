"""DuckDB SQL equal to each registered query (the correctness oracle).

Every statement rebuilds the crawl log from ``events`` and ``pages`` with the
FIXTURES.md formulas and then states the query directly, in the one-record-
at-a-time terms of the reference where that is shortest (global running sums,
per-key arg_min/arg_max). Payload and BINARY values appear as MD5 hex and byte
counts, as in the Spark queries.
"""

from __future__ import annotations

# Written out here, not taken from the library: an oracle must not share the code it checks.
P = r"^([^:/?#]+://(?:[^/?#@]+@)?)([^:/?#]+)(.*)$"
JAVA_TRIM = r"^[\x00-\x20]+|[\x00-\x20]+$"
HREF = r'(?i)<a[ \t\r\n\f][^>]*?href="([^"]*)"'
TITLE = r"(?is)<title[^>]*>(.*?)</title>"
SCRIPT = r"(?is)<script[^>]*>.*?</script>"
STYLE = r"(?is)<style[^>]*>.*?</style>"
COMMENT = r"(?s)<!--.*?-->"
TAG = r"<[^>]*>"
BLANKS = r"[ \t\r\n\f]+"
MAXB = 9000
CRLF = "chr(13) || chr(10)"


def _key(u: str) -> str:
    return (
        f"CASE WHEN regexp_matches({u}, '{P}') THEN 'r:' || regexp_extract({u}, '{P}', 1) || "
        f"array_to_string(list_reverse(list_filter(string_split(regexp_extract({u}, '{P}', 2), '.'), "
        f"lambda x: x <> '')), '.') || regexp_extract({u}, '{P}', 3) ELSE {u} END"
    )


def _host_rev(u: str) -> str:
    return (f"array_to_string(list_reverse(list_filter(string_split(lower(regexp_extract({u}, '{P}', 2)), '.'), "
            f"lambda x: x <> '')), '.')")


def _jtrim(x: str) -> str:
    return f"regexp_replace({x}, '{JAVA_TRIM}', '', 'g')"


BASE = f"""
cnt AS (SELECT (SELECT count(*) FROM pages) AS n, (SELECT count(*) FROM events) AS m),
ev AS (
  SELECT e.event_id, e.ts, e.user_id, e.event_type, e.value,
         (e.event_id * 31) % (1 + (e.event_id * cnt.n) // cnt.m) AS page_id, cnt.m AS m
  FROM events e CROSS JOIN cnt),
log AS (
  SELECT ev.event_id AS seq, p.page_id, p.url, '10.0.0.' || ev.user_id AS ip, ev.ts AS fetch_ts,
         ev.ts + to_seconds(CAST(floor(ev.value * 3600) AS BIGINT)) AS write_ts,
         ev.event_type = 'signup' AS is_seed,
         CASE WHEN ev.event_type = 'signup' AND ev.event_id % 2 = 0 THEN ' L '
              WHEN ev.event_type = 'signup' THEN ' ' ELSE 'LL' END AS path_from_seed,
         CASE WHEN ev.event_type = 'click' THEN '  http://via.example.org/' || ev.user_id || ' '
              WHEN ev.event_type = 'view' THEN '  ' END AS via,
         CASE WHEN ev.event_type = 'error' THEN '' ELSE 'GET ' || p.url END AS request_text,
         'HTTP/1.1 200 OK' || {CRLF} || 'X: ' || ev.event_id || {CRLF} || {CRLF} || p.html AS raw_text,
         p.html, ev.m
  FROM ev JOIN pages p ON p.page_id = ev.page_id),
keyed AS (
  SELECT *, {_key('url')} AS row_key, CAST(strlen(raw_text) AS BIGINT) AS content_size,
         date_trunc('millisecond', fetch_ts) AS fetch_ms, date_trunc('millisecond', write_ts) AS write_ms,
         {_jtrim('path_from_seed')} AS path_t, {_jtrim('via')} AS via_t
  FROM log),
inc AS (SELECT * FROM keyed WHERE seq >= m // 5),
ex AS (SELECT DISTINCT row_key FROM keyed WHERE seq < m // 5 AND content_size <= {MAXB}),
puts AS (SELECT * FROM keyed WHERE content_size <= 20 * 1024 * 1024)
"""


def _with(*ctes: str) -> str:
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {BASE}{extra}\n"


# (field, default family, default qualifier, clock, value expr as BLOB, presence condition)
CELLS = [
    ("url", "curi", "url", "fetch_ms", "encode(url)", "TRUE"),
    ("ip", "curi", "ip", "fetch_ms", "encode(ip)", "ip IS NOT NULL"),
    ("is_seed", "curi", "is-seed", "write_ms", "'\\xFF'::BLOB", "is_seed"),
    ("path_from_seed", "curi", "path-from-seed", "write_ms", "encode(path_t)", "is_seed AND length(path_t) > 0"),
    ("via", "curi", "via", "write_ms", "encode(via_t)", "via_t IS NOT NULL AND length(via_t) > 0"),
    ("request", "curi", "request", "write_ms", "encode(request_text)", "strlen(request_text) > 0"),
    ("raw_data", "content", "raw_data", "write_ms", "encode(raw_text)", "TRUE"),
]


def _cells_sql(names: dict[str, tuple[str, str]] | None = None, base64: bool = False) -> str:
    parts = []
    for fld, fam, qual, clock, val, cond in CELLS:
        fam, qual = (names or {}).get(fld, (fam, qual))
        v = f"encode(base64({val}))" if base64 else val
        parts.append(
            f"SELECT row_key, seq, '{fam}' AS family, '{qual}' AS qualifier, {clock} AS ts, {v} AS value "
            f"FROM puts WHERE {cond}"
        )
    return "cells AS (\n  " + "\n  UNION ALL ".join(parts) + ")"


CELLS_OUT = (
    "SELECT row_key, seq, family, qualifier, ts, md5(value) AS value_md5, "
    "CAST(octet_length(value) AS BIGINT) AS value_bytes FROM cells"
)

RENAMED = {
    "url": ("meta", "target"),
    "ip": ("meta", "addr"),
    "is_seed": ("meta", "seed"),
    "path_from_seed": ("meta", "hops"),
    "via": ("meta", "referrer"),
    "request": ("meta", "req"),
    "raw_data": ("newcontent", "body"),
}


def _after(c_ms: str, c_seq: str, ms: str = "write_ms", seq: str = "seq") -> str:
    return f"({ms} > {c_ms} OR ({ms} = {c_ms} AND {seq} > {c_seq}))"


FIRST_WRITE = f"""fw AS (
  SELECT row_key, arg_min(write_ms, row(write_ms, seq)) AS fw_ms, arg_min(seq, row(write_ms, seq)) AS fw_seq
  FROM inc WHERE content_size <= {MAXB} GROUP BY row_key)"""

KNOWN = f"""kn AS (
  SELECT i.*, (x.row_key IS NOT NULL) OR (fw.fw_seq IS NOT NULL AND {_after('fw.fw_ms', 'fw.fw_seq', 'i.write_ms', 'i.seq')}) AS known
  FROM inc i LEFT JOIN ex x ON x.row_key = i.row_key LEFT JOIN fw ON fw.row_key = i.row_key)"""

WRITE_STATUS = f"""st AS (
  SELECT seq, row_key, write_ms, content_size,
         CASE WHEN content_size > {MAXB} THEN 'unwritten:size' WHEN known THEN 'existing' ELSE 'written' END AS status
  FROM kn),
wr AS (
  SELECT write_ms, seq, sum(content_size) OVER (ORDER BY write_ms, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
  FROM st WHERE status = 'written'),
cut AS (SELECT write_ms AS c_ms, seq AS c_seq FROM wr WHERE run > (SELECT 25 * m FROM cnt) ORDER BY write_ms, seq LIMIT 1),
st2 AS (
  SELECT st.seq, st.row_key, st.content_size,
         CASE WHEN cut.c_ms IS NOT NULL AND {_after('cut.c_ms', 'cut.c_seq', 'st.write_ms', 'st.seq')} THEN 'over_budget'
              ELSE st.status END AS status
  FROM st LEFT JOIN cut ON TRUE)"""

TITLE_SQL = (
    f"CASE WHEN length(trim(regexp_replace(regexp_extract(html, '{TITLE}', 1), '{BLANKS}', ' ', 'g'))) > 0 "
    f"THEN trim(regexp_replace(regexp_extract(html, '{TITLE}', 1), '{BLANKS}', ' ', 'g')) END"
)


def _text_sql(h: str = "html") -> str:
    for pat in (SCRIPT, STYLE, COMMENT):
        h = f"regexp_replace({h}, '{pat}', ' ', 'g')"
    h = f"regexp_replace({h}, '{TAG}', ' ', 'g')"
    return f"trim(regexp_replace({h}, '{BLANKS}', ' ', 'g'))"


LINKS = f"""lk AS (SELECT row_key, seq, regexp_extract_all(html, '{HREF.replace("'", "''")}', 1) AS l FROM puts)"""
LINKS_OUT = "SELECT row_key, seq, unnest(range(len(l))) AS position, unnest(l) AS link FROM lk"

# A page cut into comments, raw elements, tags, other markup and text, for pages without unclosed markup.
SCAN_TOKEN = ("(?is)<!--.*?-->|<script[^>]*>.*?</script[^>]*>|<style[^>]*>.*?</style[^>]*>|<title[^>]*>.*?</title[^>]*>|"
              """</?[a-z](?:[^>"'']|"[^"]*"|''[^'']*'')*>|<[!?/][^>]*>|[^<]+|<""")
INLINE = "a|abbr|acronym|b|bdi|bdo|big|cite|code|em|font|i|kbd|mark|s|samp|small|span|strike|strong|sub|sup|tt|u|var|wbr"
HREF_TAG = """(?is)^<a[ \\t\\r\\n\\f](?:[^>]*[ "''])?href=["'']?([^"''>]*)"""


def _references(x: str) -> str:
    for name, char in (("quot", "chr(34)"), ("copy", "chr(169)"), ("middot", "chr(183)"), ("lt", "'<'"), ("gt", "'>'"), ("amp", "'&'")):
        x = f"replace({x}, '&{name};', {char})"
    return x


def _fold(x: str) -> str:
    return f"trim(regexp_replace({x}, '{BLANKS}', ' ', 'g'))"


SCAN = f"""pg AS (SELECT page_id, url, regexp_extract_all(html, '{SCAN_TOKEN}', 0) AS t FROM pages),
sc AS (
  SELECT page_id, url, {_fold(_references("regexp_extract(list_filter(t, lambda x: regexp_matches(x, '(?is)^<title'))[1], '(?is)^<title[^>]*>(.*)</title', 1)"))} AS title,
         {_fold(f"""array_to_string(list_transform(t, lambda x: CASE
           WHEN x[1] <> '<' OR x = '<' THEN {_references('x')}
           WHEN x[1:4] = '<!--' OR regexp_matches(x, '(?is)^</?(?:{INLINE})[ />]') THEN '' ELSE ' ' END), '')""")} AS text,
         list_transform(list_filter(t, lambda x: regexp_matches(x, '{HREF_TAG}')), lambda x: {_references(f"regexp_extract(x, '{HREF_TAG}', 1)")}) AS hrefs
  FROM pg)"""
# Targets of references without dot segments; another kind of reference in the table would be an error.
INLINKS = f"""ref AS (SELECT page_id, url, unnest(hrefs) AS h FROM sc),
tgt AS (
  SELECT page_id, CASE
    WHEN regexp_matches(h, '(^|/)[.][.]?(/|[?#]|$)') THEN error('dot segment')
    WHEN regexp_matches(h, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN h
    WHEN h LIKE '//%' THEN regexp_extract(url, '^[^:]+:') || h
    WHEN h LIKE '/%' THEN regexp_extract(url, '^[^:]+://[^/?#]*') || h
    WHEN h LIKE '?%' THEN regexp_extract(url, '^[^?#]*') || h
    WHEN h = '' OR h LIKE '#%' THEN regexp_extract(url, '^[^#]*') || h
    ELSE regexp_extract(url, '^[^:]+://[^/?#]*/(?:[^?#]*/)?') || h END AS target
  FROM ref),
cut_t AS (SELECT page_id, regexp_replace(target, '#.*$', '') AS target FROM tgt),
tk AS (SELECT page_id, {_key('target')} AS target_key, {_host_rev('target')} AS host_rev FROM cut_t),
one AS (SELECT p.row_key, tk.target_key, tk.host_rev, count(*) AS n FROM puts p JOIN tk USING (page_id) GROUP BY ALL),
st_k AS (SELECT DISTINCT row_key, {_host_rev('url')} AS host_rev FROM puts),
st_h AS (SELECT host_rev, count(*) AS host_pages FROM st_k GROUP BY host_rev)"""


STORED_OUT = f"""SELECT row_key, seq, CAST(CASE WHEN seq < m // 5 THEN 0 ELSE 1 END AS BIGINT) AS batch_id,
       fetch_ms AS fetch_ts, write_ms AS write_ts, url, ip,
       CASE WHEN is_seed THEN TRUE END AS is_seed,
       CASE WHEN is_seed AND length(path_t) > 0 THEN path_t END AS path_from_seed,
       CASE WHEN length(via_t) > 0 THEN via_t END AS via,
       CASE WHEN strlen(request_text) > 0 THEN md5(request_text) END AS request_md5,
       md5(raw_text) AS raw_md5
FROM puts"""


def _domain(domain: str) -> str:
    rev = ".".join(reversed(domain.split(".")))
    host = (f"array_to_string(list_reverse(list_filter(string_split(lower(regexp_extract(url, '{P}', 2)), '.'), "
            "lambda x: x <> '')), '.')")
    return f"{host} = '{rev}' OR starts_with({host}, '{rev}.')"


ORACLE: dict[str, str] = {
    "crawl_records": _with() + """SELECT seq, url, ip, fetch_ts, write_ts, is_seed, path_from_seed, via,
       CAST(strlen(request_text) AS BIGINT) AS request_bytes, content_size, md5(raw_text) AS raw_md5 FROM keyed""",
    "payload_bytes": _with() + """SELECT seq, CAST(strlen(request_text) AS BIGINT) AS request_bytes,
       CAST(strlen(raw_text) AS BIGINT) AS raw_bytes, md5(request_text) AS request_md5 FROM keyed""",
    "response_body": _with() + "SELECT seq, md5(html) AS body_md5, CAST(strlen(html) AS BIGINT) AS body_bytes FROM keyed",
    "row_key": _with() + "SELECT seq, url, row_key FROM keyed",
    "row_key_md5": _with() + "SELECT seq, row_key, md5(row_key) AS row_key_md5 FROM keyed",
    "resolve_ip": _with(
        f"hosts AS (SELECT DISTINCT regexp_extract(url, '{P}', 2) AS host FROM pages)",
        "hip AS (SELECT host, min('192.0.2.' || (length(host) % 250)) AS ip FROM hosts GROUP BY host)",
    ) + f"""SELECT k.seq, regexp_extract(k.url, '{P}', 2) AS host, hip.ip,
       CASE WHEN hip.ip IS NOT NULL THEN 'resolved' ELSE 'missing' END AS ip_status
FROM keyed k LEFT JOIN hip ON hip.host = regexp_extract(k.url, '{P}', 2)""",
    "cells": _with(_cells_sql()) + CELLS_OUT,
    "cells_renamed": _with(_cells_sql(RENAMED)) + CELLS_OUT,
    "serialize_cells": _with(_cells_sql(base64=True)) + CELLS_OUT,
    "size_gate": _with() + f"SELECT seq, row_key, content_size FROM keyed WHERE content_size <= {MAXB}",
    "base_gate": _with() + f"""SELECT seq, row_key,
       CASE WHEN contains(url, '.example.net') THEN 'not_processed'
            WHEN strlen(request_text) = 0 THEN 'unwritten'
            WHEN content_size > {MAXB} THEN 'unwritten:size' ELSE 'written' END AS status
FROM keyed""",
    "annotate": _with() + f"SELECT seq, CASE WHEN content_size > {MAXB} THEN 'unwritten:size' ELSE '' END AS annotations FROM keyed",
    "write_new": _with(
        f"""cand AS (SELECT * FROM inc WHERE content_size <= {MAXB} AND row_key NOT IN (SELECT row_key FROM ex))"""
    ) + """SELECT row_key, arg_min(seq, row(write_ms, seq)) AS seq, arg_min(md5(raw_text), row(write_ms, seq)) AS raw_md5
FROM cand GROUP BY row_key""",
    "process_new": _with(FIRST_WRITE, KNOWN) + f"""SELECT seq, row_key,
       CASE WHEN content_size > {MAXB} THEN 'unwritten:size' ELSE 'written' END AS status
FROM kn WHERE NOT known""",
    "write_status": _with(FIRST_WRITE, KNOWN, WRITE_STATUS) + "SELECT seq, row_key, status FROM st2",
    "existing_records": _with() + "SELECT seq, row_key FROM inc WHERE row_key IN (SELECT row_key FROM ex)",
    "total_bytes": _with() + """SELECT count(*) AS records, CAST(coalesce(sum(content_size), 0) AS BIGINT) AS total_bytes
FROM puts""",
    "status_counts": _with(FIRST_WRITE, KNOWN, WRITE_STATUS) + """SELECT status, count(*) AS records,
       CAST(coalesce(sum(content_size), 0) AS BIGINT) AS bytes FROM st2 GROUP BY status""",
    "latest_cells": _with(_cells_sql()) + """SELECT row_key, family, qualifier,
       arg_max(ts, row(ts, seq)) AS ts, arg_max(seq, row(ts, seq)) AS seq, arg_max(md5(value), row(ts, seq)) AS value_md5
FROM cells GROUP BY row_key, family, qualifier""",
    "latest_wide": _with() + """SELECT row_key,
       arg_max(url, row(fetch_ms, seq)) AS url,
       arg_max(ip, row(fetch_ms, seq)) FILTER (WHERE ip IS NOT NULL) AS ip,
       arg_max(TRUE, row(write_ms, seq)) FILTER (WHERE is_seed) AS is_seed,
       arg_max(path_t, row(write_ms, seq)) FILTER (WHERE is_seed AND length(path_t) > 0) AS path_from_seed,
       arg_max(via_t, row(write_ms, seq)) FILTER (WHERE length(via_t) > 0) AS via,
       arg_max(md5(request_text), row(write_ms, seq)) FILTER (WHERE strlen(request_text) > 0) AS request_md5,
       arg_max(md5(raw_text), row(write_ms, seq)) AS raw_md5,
       max(fetch_ms) AS fetch_ts, max(write_ms) AS write_ts, count(*) AS n_versions
FROM puts GROUP BY row_key""",
    "byte_budget": _with(
        """w AS (SELECT seq, row_key, md5(raw_text) AS raw_md5, sum(strlen(raw_text)) OVER (ORDER BY write_ms, seq
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior
          FROM puts)"""
    ) + "SELECT seq, row_key, raw_md5 FROM w WHERE coalesce(prior, 0) <= (SELECT 500 * m FROM cnt)",
    "extract_title": _with() + f"SELECT row_key, seq, {TITLE_SQL} AS title FROM puts",
    "extract_links": _with(LINKS) + LINKS_OUT,
    "extract_text": _with(f"tx AS (SELECT row_key, seq, {_text_sql()} AS text FROM puts)")
    + "SELECT row_key, seq, md5(text) AS text_md5, CAST(length(text) AS BIGINT) AS text_chars FROM tx",
    "put_rows": _with() + STORED_OUT,
    "table_scan": _with() + """SELECT row_key, seq, url, CAST(strlen(raw_text) AS BIGINT) AS raw_bytes FROM puts""",
    "lookup_keys": _with(
        f"pk AS (SELECT page_id, {_key('url')} AS row_key FROM pages)",
        "agg AS (SELECT row_key, count(*) AS n_versions, max(seq) AS max_seq FROM puts GROUP BY row_key)",
    ) + """SELECT pk.page_id, pk.row_key, CAST(coalesce(agg.n_versions, 0) AS BIGINT) AS n_versions, agg.max_seq
FROM pk LEFT JOIN agg ON agg.row_key = pk.row_key""",
    "domain_scan": _with() + f"SELECT row_key, seq, url FROM puts WHERE {_domain('example.org')}",
    "key_order": _with() + """SELECT row_key, seq, CAST(CASE WHEN seq < m // 5 THEN 0 ELSE 1 END AS BIGINT) AS batch_id
FROM puts""",
    "ensure_table": _with() + "SELECT row_key, seq, CAST(0 AS BIGINT) AS batch_id FROM puts",
    "evolve_table": _with() + f"""SELECT row_key, seq, CAST(CASE WHEN seq < m // 5 THEN 0 ELSE 1 END AS BIGINT) AS batch_id,
       CASE WHEN seq >= m // 5 THEN {TITLE_SQL} END AS title FROM puts""",
    "hook_side_output": _with(LINKS) + LINKS_OUT,
    "scan_page": _with(SCAN) + """SELECT p.row_key, p.seq, CASE WHEN length(sc.title) > 0 THEN sc.title END AS title, md5(sc.text) AS text_md5,
       length(sc.text) AS text_chars, CAST(len(sc.hrefs) AS BIGINT) AS n_links
FROM puts p JOIN sc USING (page_id)""",
    "inlinks": _with(SCAN, INLINKS) + """SELECT one.target_key, one.host_rev,
       CAST(sum(one.n) AS BIGINT) AS n_links, count(DISTINCT one.row_key) AS n_pages,
       one.target_key IN (SELECT row_key FROM st_k) AS stored, CAST(coalesce(any_value(st_h.host_pages), 0) AS BIGINT) AS host_pages
FROM one LEFT JOIN st_h ON st_h.host_rev = one.host_rev GROUP BY one.target_key, one.host_rev""",
    "stream_ingest": _with(
        f"""cand AS (SELECT * FROM inc WHERE content_size <= {MAXB} AND row_key NOT IN (SELECT row_key FROM ex))"""
    ) + f"""SELECT row_key, seq FROM puts WHERE seq < m // 5 AND content_size <= {MAXB}
UNION ALL
SELECT row_key, arg_min(seq, row(write_ms, seq)) AS seq FROM cand GROUP BY row_key""",
}

ORACLE["write_new_filtered"] = ORACLE["write_new"]
ORACLE["table_as_of"] = _with() + """SELECT row_key, seq, CAST(0 AS BIGINT) AS batch_id, CAST(strlen(raw_text) AS BIGINT) AS raw_bytes
FROM puts WHERE seq < m // 5"""
ORACLE["table_upkeep"] = _with() + "SELECT row_key, seq, CAST(seq * 4 // m AS BIGINT) AS batch_id FROM puts"
ORACLE["domain_time_scan"] = _with() + f"""SELECT row_key, seq, url FROM puts
WHERE {_domain('example.org')} AND write_ms >= TIMESTAMP '2024-01-08' AND write_ms < TIMESTAMP '2024-01-18'"""
