"""Crawl records: the input contract, and the crawl log derived from the driver tables.

A record is one fetch. Schema (``RECORD_COLUMNS``): seq, url, ip, fetch_ts,
write_ts, is_seed, path_from_seed, via, request, raw_data, content_size,
annotations. ``content_size`` lets gate plans run without reading payload.
A missing size is the payload's length and a missing store time the fetch time,
row by row, in batch and stream alike.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("ip", T.StringType()),
        T.StructField("fetch_ts", T.TimestampNTZType()),
        T.StructField("write_ts", T.TimestampNTZType()),
        T.StructField("is_seed", T.BooleanType()),
        T.StructField("path_from_seed", T.StringType()),
        T.StructField("via", T.StringType()),
        T.StructField("request", T.BinaryType()),
        T.StructField("raw_data", T.BinaryType()),
        T.StructField("content_size", T.LongType()),
        T.StructField("annotations", T.ArrayType(T.StringType())),
    ]
)
RECORD_COLUMNS = [f.name for f in RECORD_SCHEMA.fields]
DEFAULTS = {
    "ip": lambda: F.lit(None).cast("string"),
    "is_seed": lambda: F.lit(False),
    "path_from_seed": lambda: F.lit(None).cast("string"),
    "via": lambda: F.lit(None).cast("string"),
    "request": lambda: F.lit(None).cast("binary"),
    "raw_data": lambda: F.lit(b"").cast("binary"),
    "annotations": lambda: F.array().cast("array<string>"),
}


def normalize_records(df: DataFrame) -> DataFrame:
    """Fill optional record columns so every operator sees the full contract."""
    schema = df.schema
    cols, new = set(schema.names), {}
    for name, default in DEFAULTS.items():
        if name not in cols:
            new[name] = default()
    stored = F.col("write_ts") if "write_ts" in cols else F.lit(None).cast("timestamp_ntz")
    new["write_ts"] = F.coalesce(stored, F.col("fetch_ts"))
    if "content_size" not in cols or schema["content_size"].nullable:
        size = F.col("content_size") if "content_size" in cols else F.lit(None)
        payload = new.get("raw_data", F.col("raw_data"))
        new["content_size"] = F.coalesce(size.cast("bigint"), F.octet_length(payload).cast("bigint"), F.lit(0).cast("bigint"))
    return df.withColumns(new).select(*RECORD_COLUMNS, *[c for c in schema.names if c not in RECORD_COLUMNS])


def read_records(spark: SparkSession, path: str, sizes_complete: bool = False) -> DataFrame:
    """Crawl records stored as Parquet (schema enforced, no inference).

    ``sizes_complete`` promises that every record carries ``content_size``, so
    that gate plans need not look at the payload for it; a record that breaks
    the promise fails the job.
    """
    df = spark.read.parquet(path)
    if sizes_complete:
        broken = F.raise_error(F.lit("a record has no content_size")).cast("bigint")
        size = F.when(F.col("content_size").isNotNull(), F.col("content_size")).otherwise(broken)
        df = df.withColumn("content_size", F.coalesce(size, F.lit(0).cast("bigint")))
    return normalize_records(df)


@dataclass(frozen=True)
class CrawlLog:
    """The FIXTURES crawl log over one scale factor and its settings."""

    records: DataFrame
    n_pages: int
    n_events: int

    @property
    def split_seq(self) -> int:
        """Records with seq below this form the pre-existing table."""
        return self.n_events // 5

    @property
    def max_total_bytes(self) -> int:
        """Byte budget of the fixture: 500 bytes per logged fetch."""
        return 500 * self.n_events

    def existing(self) -> DataFrame:
        return self.records.filter(F.col("seq") < self.split_seq)

    def incoming(self) -> DataFrame:
        return self.records.filter(F.col("seq") >= self.split_seq)


# Fixed values of the fixture (FIXTURES.md section 2 and 3).
MAX_CONTENT_BYTES = 9000
RESPONSE_HEAD = "HTTP/1.1 200 OK\r\nX: "
VIA_PREFIX = "  http://via.example.org/"


def crawl_log(spark: SparkSession, sf_dir: str) -> CrawlLog:
    """Derive the crawl log: one fetch per event, page picked by a growing window.

    Payload (``raw_data``) is built only when a plan asks for it: the size is
    computed from a per-page byte count, so gate plans prune ``html`` away.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    n_pages, n_events = pages.count(), events.count()

    eid = F.col("event_id")
    ev = events.select(
        eid.alias("seq"),
        ((eid * 31) % (F.lit(1) + F.expr(f"(event_id * {n_pages}) div {n_events}"))).alias("page_id"),
        F.concat(F.lit("10.0.0."), F.col("user_id").cast("string")).alias("ip"),
        F.col("ts").alias("fetch_ts"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                          F.floor(F.col("value") * 3600).cast("decimal(18,6)"))).alias("write_ts"),
        (F.col("event_type") == "signup").alias("is_seed"),
        F.when((F.col("event_type") == "signup") & (eid % 2 == 0), F.lit(" L "))
        .when(F.col("event_type") == "signup", F.lit(" "))
        .otherwise(F.lit("LL"))
        .alias("path_from_seed"),
        F.when(F.col("event_type") == "click", F.concat(F.lit(VIA_PREFIX), F.col("user_id").cast("string"), F.lit(" ")))
        .when(F.col("event_type") == "view", F.lit("  "))
        .alias("via"),
        (F.col("event_type") == "error").alias("_no_request"),
    )
    pg = pages.select("page_id", "url", "html", F.octet_length("html").cast("bigint").alias("_html_bytes"))
    j = ev.join(pg, "page_id")
    head = F.concat(F.lit(RESPONSE_HEAD), F.col("seq").cast("string"), F.lit("\r\n\r\n"))
    records = j.select(
        "seq",
        "url",
        "ip",
        "fetch_ts",
        "write_ts",
        "is_seed",
        "path_from_seed",
        "via",
        F.when(F.col("_no_request"), F.lit(b"").cast("binary"))
        .otherwise(F.encode(F.concat(F.lit("GET "), F.col("url")), "UTF-8"))
        .alias("request"),
        F.encode(F.concat(head, F.col("html")), "UTF-8").alias("raw_data"),
        F.coalesce((F.lit(len(RESPONSE_HEAD.encode()) + 4) + F.length(F.col("seq").cast("string")) + F.col("_html_bytes"))
                   .cast("bigint"), F.lit(0).cast("bigint")).alias("content_size"),
        F.array().cast("array<string>").alias("annotations"),
    )
    return CrawlLog(records, n_pages, n_events)


def ip_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host -> ip table of the fixture: all distinct hosts of the pages."""
    from cellar.functions.keys import url_host

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    hosts = pages.select(url_host("url").alias("host")).distinct()
    return hosts.select("host", F.concat(F.lit("192.0.2."), (F.length("host") % 250).cast("string")).alias("ip"))
