"""Registered queries over the driver tables (crawl log of FIXTURES.md).

Each function takes ``(spark, sf_dir)`` and returns a DataFrame; column names
match the DuckDB oracle in ``cellar.plans.oracle``. All of them read the whole
``events`` and ``pages`` tables; payload and BINARY values are reported as MD5
hex and byte counts. Where a stored table takes part, the first fifth of the
log is stored and the rest comes in. The 9,000-byte limit holds only in the
queries about gates; elsewhere it is the default.

Queries on a physical table write it in the shared folder, open it a second
time by name, keep their (narrow) result and drop the table and its files.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellar.functions import html, pagescan
from cellar.functions.body import response_body
from cellar.functions.keys import row_key
from cellar.operators import gates
from cellar.operators.cells import cells, latest_cells, latest_wide
from cellar.operators.hooks import base64_serializer, links, resolve_ip, title_hook
from cellar.operators.linkgraph import inlinks
from cellar.operators.metrics import status_counts, total_bytes
from cellar.operators.project import with_row_key
from cellar.options import CrawlOptions
from cellar.plans.ingest import ingest, plan_ingest
from cellar.runtime import delete_path, scratch_path, write_stage
from cellar.sources.crawl_log import MAX_CONTENT_BYTES, CrawlLog, crawl_log, ip_hosts
from cellar.sources.table import CrawlTable
from cellar.streaming.ingest import read_record_stream, start_ingest

# Fixed settings of the fixture queries.
BASE = CrawlOptions(table="crawl")
GATED = BASE.with_(max_content_bytes=MAX_CONTENT_BYTES)
RENAMED = BASE.with_(
    content_family="newcontent",
    content_qualifier="body",
    curi_family="meta",
    url_qualifier="target",
    ip_qualifier="addr",
    is_seed_qualifier="seed",
    path_from_seed_qualifier="hops",
    via_qualifier="referrer",
    request_qualifier="req",
)
DOMAIN = "example.org"
EXCLUDED_DOMAIN_PART = ".example.net"


def _log(spark: SparkSession, sf_dir: str) -> CrawlLog:
    return crawl_log(spark, sf_dir)


def _existing_puts(log: CrawlLog, opts: CrawlOptions = GATED) -> DataFrame:
    """The table before the incoming part: default-mode ingest of the first fifth."""
    return plan_ingest(log.existing(), opts, batch_id=0).puts


def _all_puts(log: CrawlLog, opts: CrawlOptions = BASE) -> DataFrame:
    """Default-mode ingest of the whole log (every size-gated record, all versions)."""
    return plan_ingest(log.records, opts, batch_id=0).puts


def _md5(c: str):
    return F.md5(F.col(c))


def _cells_out(cell_rows: DataFrame) -> DataFrame:
    return cell_rows.select(
        "row_key", "seq", "family", "qualifier", "ts",
        F.md5("value").alias("value_md5"), F.octet_length("value").cast("bigint").alias("value_bytes"),
    )


# ---- S1 / S8 / P13 ---------------------------------------------------------

def q_crawl_records(spark, sf_dir):
    r = _log(spark, sf_dir).records
    return r.select(
        "seq", "url", "ip", "fetch_ts", "write_ts", "is_seed", "path_from_seed", "via",
        F.octet_length("request").cast("bigint").alias("request_bytes"), "content_size",
        _md5("raw_data").alias("raw_md5"),
    )


def q_payload_bytes(spark, sf_dir):
    r = _log(spark, sf_dir).records
    return r.select(
        "seq",
        F.octet_length("request").cast("bigint").alias("request_bytes"),
        F.octet_length("raw_data").cast("bigint").alias("raw_bytes"),
        _md5("request").alias("request_md5"),
    )


def q_response_body(spark, sf_dir):
    r = _log(spark, sf_dir).records.withColumn("body", response_body("raw_data"))
    return r.select("seq", _md5("body").alias("body_md5"), F.octet_length("body").cast("bigint").alias("body_bytes"))


# ---- P1 / P2 / P14 ---------------------------------------------------------

def q_row_key(spark, sf_dir):
    r = _log(spark, sf_dir).records
    return r.select("seq", "url", row_key("url").alias("row_key"))


def q_row_key_md5(spark, sf_dir):
    r = _log(spark, sf_dir).records
    return r.select("seq", row_key("url").alias("row_key"), row_key("url", md5=True).alias("row_key_md5"))


def q_resolve_ip(spark, sf_dir):
    r = _log(spark, sf_dir).records.select("seq", "url", F.lit(None).cast("string").alias("ip"))
    out = resolve_ip(r, ip_hosts(spark, sf_dir))
    return out.select("seq", "host", "ip", "ip_status")


# ---- P3-P12, U1 -------------------------------------------------------------

def q_cells(spark, sf_dir):
    return _cells_out(cells(_all_puts(_log(spark, sf_dir)), BASE))


def q_cells_renamed(spark, sf_dir):
    return _cells_out(cells(_all_puts(_log(spark, sf_dir), RENAMED), RENAMED))


def q_serialize_cells(spark, sf_dir):
    opts = BASE.with_(serializer=base64_serializer)
    return _cells_out(cells(_all_puts(_log(spark, sf_dir), opts), opts))


# ---- F1-F7, J1-J3 -------------------------------------------------------------

def q_size_gate(spark, sf_dir):
    r = with_row_key(_log(spark, sf_dir).records, GATED)
    return r.filter(gates.size_ok(GATED)).select("seq", "row_key", "content_size")


def q_base_gate(spark, sf_dir):
    opts = GATED.with_(
        base_process_gate=~F.col("url").contains(EXCLUDED_DOMAIN_PART),
        base_write_gate=F.octet_length("request") > 0,
    )
    st = gates.write_status(_log(spark, sf_dir).records, None, opts)
    return st.select("seq", "row_key", "status")


def q_annotate(spark, sf_dir):
    r = _log(spark, sf_dir).records
    out = gates.annotate(r, GATED)
    return out.select("seq", F.array_join("annotations", "|").alias("annotations"))


def q_write_new(spark, sf_dir):
    log = _log(spark, sf_dir)
    p = plan_ingest(log.incoming(), GATED.with_(only_write_new=True), keys=_existing_puts(log), batch_id=1)
    return p.puts.select("row_key", "seq", F.md5("content__raw_data").alias("raw_md5"))


def q_process_new(spark, sf_dir):
    log = _log(spark, sf_dir)
    st = gates.write_status(log.incoming(), _existing_puts(log), GATED.with_(only_process_new=True))
    return st.filter(F.col("status") != gates.NOT_PROCESSED).select("seq", "row_key", "status")


def _write_status(spark, sf_dir):
    log = _log(spark, sf_dir)
    opts = GATED.with_(only_write_new=True, max_total_bytes=log.max_total_bytes // 20)
    return plan_ingest(log.incoming(), opts, keys=_existing_puts(log), batch_id=1).statuses


def q_write_status(spark, sf_dir):
    return _write_status(spark, sf_dir).select("seq", "row_key", "status")


def q_existing_records(spark, sf_dir):
    log = _log(spark, sf_dir)
    inc = with_row_key(log.incoming(), BASE)
    return gates.existing_records(inc, _existing_puts(log)).select("seq", "row_key")


# ---- A1-A4 ---------------------------------------------------------------------

def q_total_bytes(spark, sf_dir):
    return total_bytes(gates.writable(_log(spark, sf_dir).records, None, BASE))


def q_status_counts(spark, sf_dir):
    return status_counts(_write_status(spark, sf_dir))


def q_latest_cells(spark, sf_dir):
    lat = latest_cells(_all_puts(_log(spark, sf_dir)), BASE)
    return lat.select("row_key", "family", "qualifier", "ts", "seq", F.md5("value").alias("value_md5"))


def q_latest_wide(spark, sf_dir):
    lat = latest_wide(_all_puts(_log(spark, sf_dir)), BASE)
    return lat.select(
        "row_key",
        F.col("curi__url").alias("url"),
        F.col("curi__ip").alias("ip"),
        F.col("curi__is_seed").alias("is_seed"),
        F.col("curi__path_from_seed").alias("path_from_seed"),
        F.col("curi__via").alias("via"),
        F.md5("curi__request").alias("request_md5"),
        F.md5("content__raw_data").alias("raw_md5"),
        "fetch_ts", "write_ts", "n_versions",
    )


# ---- W1 -------------------------------------------------------------------------

def q_byte_budget(spark, sf_dir):
    log = _log(spark, sf_dir)
    p = plan_ingest(log.records, BASE.with_(max_total_bytes=log.max_total_bytes), batch_id=1)
    return p.puts.select("seq", "row_key", F.md5("content__raw_data").alias("raw_md5"))


# ---- U3 ---------------------------------------------------------------------------

def _written_with_body(spark, sf_dir) -> DataFrame:
    w = gates.writable(_log(spark, sf_dir).records, None, BASE)
    return w.select("row_key", "seq", response_body("raw_data").alias("body"))


def q_extract_title(spark, sf_dir):
    b = _written_with_body(spark, sf_dir)
    return b.select("row_key", "seq", html.extract_title(html.as_text("body")).alias("title"))


def q_extract_links(spark, sf_dir):
    out = links(_written_with_body(spark, sf_dir))
    return out.select("row_key", "seq", F.col("position").cast("bigint").alias("position"), "link")


def q_extract_text(spark, sf_dir):
    b = _written_with_body(spark, sf_dir).withColumn("text", html.extract_text(html.as_text("body")))
    return b.select("row_key", "seq", F.md5("text").alias("text_md5"), F.length("text").cast("bigint").alias("text_chars"))


def q_scan_page(spark, sf_dir):
    """Title, text and number of links by the left-to-right scan."""
    b = _written_with_body(spark, sf_dir).withColumn("t", pagescan.scan(html.as_text("body"), F.lit(None).cast("string")))
    b = b.select("row_key", "seq", "t.title", "t.text", F.size("t.links").cast("bigint").alias("n_links"))
    return b.select("row_key", "seq", "title", F.md5("text").alias("text_md5"), F.length("text").cast("bigint").alias("text_chars"), "n_links")


def q_inlinks(spark, sf_dir):
    w = gates.writable(_log(spark, sf_dir).records, None, BASE)
    pages = w.select("row_key", "url", html.as_text(response_body("raw_data")).alias("page"))
    return inlinks(pages, w.select("row_key", "url"))


# ---- S2-S7, O1, O2 (physical table) ---------------------------------------------

def _table_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def _new_table(spark, opts: CrawlOptions) -> CrawlTable:
    name = _table_name("crawl")
    return CrawlTable(spark, opts.with_(table=name), scratch_path(spark, f"table-{name}"))


def _reopened(t: CrawlTable, opts: CrawlOptions = BASE) -> CrawlTable:
    """A second table object, opened by name alone."""
    return CrawlTable(t.spark, opts.with_(table=t.name))


def _stored(spark, sf_dir) -> CrawlTable:
    """The default-mode ingest of the log written as two batches (0: first fifth)."""
    log = _log(spark, sf_dir)
    t = _new_table(spark, BASE)
    ingest(log.existing(), t, 0)
    ingest(log.incoming(), _reopened(t), 1)
    return _reopened(t)


def _result(t: CrawlTable, df: DataFrame, *paths: str) -> DataFrame:
    """The result written out; then the table, its files and ``paths`` go."""
    out, _ = write_stage(df, "result")
    t.drop(purge=True)
    for p in paths:
        delete_path(t.spark, p)
    return out


def q_put_rows(spark, sf_dir):
    t = _stored(spark, sf_dir)
    return _result(t, t.scan().select(
        "row_key", "seq", "batch_id", "fetch_ts", "write_ts",
        F.col("curi__url").alias("url"), F.col("curi__ip").alias("ip"),
        F.col("curi__is_seed").alias("is_seed"), F.col("curi__path_from_seed").alias("path_from_seed"),
        F.col("curi__via").alias("via"), F.md5("curi__request").alias("request_md5"),
        F.md5("content__raw_data").alias("raw_md5"),
    ))


def q_table_scan(spark, sf_dir):
    t = _stored(spark, sf_dir)
    return _result(t, t.scan("row_key", "seq", "curi__url", "content__raw_data").select(
        "row_key", "seq", F.col("curi__url").alias("url"),
        F.octet_length("content__raw_data").cast("bigint").alias("raw_bytes"),
    ))


def q_lookup_keys(spark, sf_dir):
    t = _stored(spark, sf_dir)
    wanted = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", row_key("url").alias("row_key"))
    found = t.lookup(wanted).groupBy("row_key").agg(
        F.count(F.lit(1)).alias("n_versions"), F.max("seq").alias("max_seq"))
    return _result(t, wanted.join(found, "row_key", "left").select(
        "page_id", "row_key", F.coalesce("n_versions", F.lit(0)).cast("bigint").alias("n_versions"), "max_seq"))


def q_domain_scan(spark, sf_dir):
    t = _stored(spark, sf_dir)
    return _result(t, t.domain_scan(DOMAIN).select("row_key", "seq", F.col("curi__url").alias("url")))


def q_key_order(spark, sf_dir):
    t = _stored(spark, sf_dir)
    t.compact()
    return _result(t, _reopened(t).scan("row_key", "seq", "batch_id"))


def q_ensure_table(spark, sf_dir):
    log = _log(spark, sf_dir)
    t = _new_table(spark, BASE).ensure()
    ingest(log.records, _reopened(t).ensure(), 0)
    return _result(t, _reopened(t).scan("row_key", "seq", "batch_id"))


def q_evolve_table(spark, sf_dir):
    log = _log(spark, sf_dir)
    t0 = _new_table(spark, BASE)
    ingest(log.existing(), t0, 0)
    t1 = _reopened(t0, BASE.with_(content_hook=title_hook()))
    ingest(log.incoming(), t1, 1)
    return _result(t1, _reopened(t1).scan("row_key", "seq", "batch_id", "parse__title").withColumnRenamed("parse__title", "title"))


def q_hook_side_output(spark, sf_dir):
    log = _log(spark, sf_dir)
    target = scratch_path(spark, "links")
    t = _new_table(spark, BASE.with_(
        content_hook=lambda d: d.withColumn("parse__n_links", F.size(html.extract_links(html.as_text("body")))),
        side_outputs={"links": (lambda p: links(p.withColumn("body", response_body("content__raw_data"))), target)}))
    ingest(log.records, t, 1)
    out = spark.read.parquet(target)
    return _result(t, out.select("row_key", "seq", F.col("position").cast("bigint").alias("position"), "link"), target)


def q_write_new_filtered(spark, sf_dir):
    """Only-new ingest into a stored table: stored keys and unchosen payload are filtered ahead of the shuffles."""
    log = _log(spark, sf_dir)
    t = _new_table(spark, GATED)
    ingest(log.existing(), t, 0)
    ingest(log.incoming(), _reopened(t, GATED.with_(only_write_new=True)), 1)
    return _result(t, _reopened(t).partition(1).select("row_key", "seq", F.md5("content__raw_data").alias("raw_md5")))


def q_table_as_of(spark, sf_dir):
    """The version after the first batch, read by SQL after a second batch and a compaction."""
    t = _stored(spark, sf_dir)
    t.compact()
    name = _table_name("as_of")
    _reopened(t).view(name, version=1)
    out = _result(t, spark.sql(f"SELECT row_key, seq, batch_id, octet_length(content__raw_data) AS raw_bytes FROM {name}").withColumn(
        "raw_bytes", F.col("raw_bytes").cast("bigint")))
    spark.catalog.dropTempView(name)
    return out


def q_table_upkeep(spark, sf_dir):
    """The log stored as four batches, the third one twice, with upkeep after each write."""
    log = _log(spark, sf_dir)
    t = _new_table(spark, BASE)
    for b in (0, 1, 2, 3, 2):
        ingest(log.records.filter(F.floor(F.col("seq") * 4 / log.n_events) == b), _reopened(t) if t.exists() else t, b)
        t.upkeep(fan=2)
    return _result(t, _reopened(t).scan("row_key", "seq", "batch_id"))


def q_domain_time_scan(spark, sf_dir):
    """Pages of one domain stored in ten days, from files laid out by host and time."""
    t = _stored(spark, sf_dir)
    t.compact(32, layout="host_time")
    days = {"since": dt.datetime(2024, 1, 8), "until": dt.datetime(2024, 1, 18)}
    return _result(t, _reopened(t).scan_where("row_key", "seq", F.col("curi__url").alias("url"), domain=DOMAIN, **days))


# ---- T1-T4 ---------------------------------------------------------------------------

# Records per source file of the stream query.
STREAM_FILE_ROWS = 10_000


def q_stream_ingest(spark, sf_dir):
    """Incoming records as files in arrival order, streamed with availableNow
    and one file per trigger into a table that holds the first fifth."""
    log = _log(spark, sf_dir)
    t = _new_table(spark, GATED.with_(only_write_new=True))
    ingest(log.existing(), t, 0, opts=t.opts.with_(only_write_new=False))
    src, state = scratch_path(spark, "stream-src"), scratch_path(spark, "stream-ckpt")
    _write_arrival_files(log.incoming(), src, max(2, -(-log.n_events // STREAM_FILE_ROWS)))
    q = start_ingest(read_record_stream(spark, src, max_files_per_trigger=1), t, state)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    t.index(rest=True)
    return _result(t, _reopened(t, GATED).scan("row_key", "seq"), src, state)


def _write_arrival_files(records: DataFrame, path: str, n: int) -> None:
    """Write records as ``n`` files in arrival order, by one range-partitioned job.

    The file source takes files by modification time, so the files' times are
    then set in their order (part files are named by partition).
    """
    spark = records.sparkSession
    records.repartitionByRange(n, "write_ts", "seq").write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001
    files = sorted((f.getPath().getName(), f) for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-"))
    start = min((f.getModificationTime() for _, f in files), default=0)
    for i, (_, f) in enumerate(files):
        fs.setTimes(f.getPath(), start + 1000 * i, -1)


QUERIES = {
    "crawl_records": q_crawl_records,
    "payload_bytes": q_payload_bytes,
    "response_body": q_response_body,
    "row_key": q_row_key,
    "row_key_md5": q_row_key_md5,
    "resolve_ip": q_resolve_ip,
    "cells": q_cells,
    "cells_renamed": q_cells_renamed,
    "serialize_cells": q_serialize_cells,
    "size_gate": q_size_gate,
    "base_gate": q_base_gate,
    "annotate": q_annotate,
    "write_new": q_write_new,
    "process_new": q_process_new,
    "write_status": q_write_status,
    "existing_records": q_existing_records,
    "total_bytes": q_total_bytes,
    "status_counts": q_status_counts,
    "latest_cells": q_latest_cells,
    "latest_wide": q_latest_wide,
    "byte_budget": q_byte_budget,
    "extract_title": q_extract_title,
    "extract_links": q_extract_links,
    "extract_text": q_extract_text,
    "scan_page": q_scan_page,
    "inlinks": q_inlinks,
    "put_rows": q_put_rows,
    "table_scan": q_table_scan,
    "lookup_keys": q_lookup_keys,
    "domain_scan": q_domain_scan,
    "key_order": q_key_order,
    "ensure_table": q_ensure_table,
    "evolve_table": q_evolve_table,
    "hook_side_output": q_hook_side_output,
    "write_new_filtered": q_write_new_filtered,
    "table_as_of": q_table_as_of,
    "table_upkeep": q_table_upkeep,
    "domain_time_scan": q_domain_time_scan,
    "stream_ingest": q_stream_ingest,
}
