"""Record -> put row: the conditional cell projection of the write path.

One wide row per write. A cell that the write path would leave out is NULL here,
so "absent" and "empty" stay apart (an empty ``raw_data`` is a present cell).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellar.functions.keys import host_rev, key_reject_reason, nonblank_trimmed, row_key
from cellar.functions.timefn import ms_floor
from cellar.options import CrawlOptions

# Literal of the one-byte boolean true cell value.
TRUE_BYTES = b"\xff"


def with_row_key(records: DataFrame, opts: CrawlOptions) -> DataFrame:
    """Add ``row_key`` (NULL for records that cannot be stored) and ``key_reject``.

    A record is rejected when its URL cannot be keyed or when it has no ip
    (the ip cell is always written, so a put without one cannot be built).
    """
    if "row_key" in records.columns:
        return records
    return records.withColumns(opts.made("key columns", lambda: key_columns(opts)))


def key_columns(opts: CrawlOptions) -> dict[str, Column]:
    reason = F.coalesce(key_reject_reason("url"), F.when(F.col("ip").isNull(), F.lit("missing_ip")))
    return {"key_reject": reason, "row_key": F.when(reason.isNull(), row_key("url", opts.md5_key))}


def logical_cells(opts: CrawlOptions) -> dict[str, Column]:
    """Built-in cell values over the record schema, NULL where the cell is absent."""
    seed = F.coalesce(F.col("is_seed"), F.lit(False))
    return {
        "url": F.col("url"),
        "ip": F.col("ip"),
        "is_seed": F.when(seed, F.lit(True)),
        "path_from_seed": F.when(seed, nonblank_trimmed("path_from_seed")),
        "via": nonblank_trimmed("via"),
        "request": F.when(F.octet_length("request") > 0, F.col("request")),
        "raw_data": F.coalesce(F.col("raw_data"), F.lit(b"").cast("binary")),
    }


def to_bytes(c: Column, kind: str) -> Column:
    """Cell value as bytes: UTF-8 text, 0xFF for true, BINARY unchanged."""
    if kind == "string":
        return F.encode(c, "UTF-8")
    if kind == "boolean":
        return F.when(c, F.lit(TRUE_BYTES))
    return c


CELL_KINDS = {
    "url": "string",
    "ip": "string",
    "is_seed": "boolean",
    "path_from_seed": "string",
    "via": "string",
    "request": "binary",
    "raw_data": "binary",
}


def put_rows(records: DataFrame, opts: CrawlOptions, batch_id: int | Column | None = None) -> DataFrame:
    """Wide put rows: row_key, seq, fetch_ts, write_ts, host_rev, one column per cell, hook
    columns, batch_id. With a serializer every built-in cell is stored as its
    serialized bytes; the content hook sees the response body, not the cells."""
    keyed = with_row_key(records, opts).filter(F.col("row_key").isNotNull())
    bid = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    out = keyed.select(*opts.made("put columns", lambda: put_columns(opts)), bid.cast("bigint").alias("batch_id"))
    if opts.content_hook is not None:
        out = apply_content_hook(out, opts)
    return out


def put_columns(opts: CrawlOptions) -> list[Column]:
    """Columns of a put row over the record schema and ``row_key``, without ``batch_id``."""
    values = logical_cells(opts)
    cells = []
    for fld, _fam, _qual, stored, _clock in opts.cell_specs():
        v = values[fld]
        if opts.serializer is not None:
            v = F.when(v.isNotNull(), opts.serializer(to_bytes(v, CELL_KINDS[fld])))
        cells.append(v.alias(stored))
    return [
        F.col("row_key"),
        F.col("seq"),
        ms_floor("fetch_ts").alias("fetch_ts"),
        ms_floor("write_ts").alias("write_ts"),
        host_rev("url").alias("host_rev"),
        *cells,
        *([F.col("raw_data").alias("__body_src")] if opts.content_hook is not None else []),
    ]


def apply_content_hook(puts: DataFrame, opts: CrawlOptions) -> DataFrame:
    """Run the content hook as a narrow transformation on the put rows.

    The hook gets ``row_key, seq, body`` (response body bytes) plus the put
    columns, and returns the same rows with extra ``family__qualifier`` columns.
    """
    from cellar.functions.body import response_body

    base = puts.withColumn("body", response_body("__body_src")).drop("__body_src")
    before = base.columns
    out = opts.content_hook(base)
    missing = [c for c in before if c not in out.columns]
    if missing:
        raise ValueError(f"content hook dropped columns {missing}")
    extra = [c for c in out.columns if c not in before]
    bad = [c for c in extra if "__" not in c]
    if bad:
        raise ValueError(f"hook columns must be named family__qualifier: {bad}")
    keep = [c for c in before if c not in ("body", "batch_id")]
    return out.select(*keep, *extra, "batch_id")


def hook_columns(puts: DataFrame, opts: CrawlOptions) -> list[str]:
    builtin = {s for _, _, _, s, _ in opts.cell_specs()}
    fixed = {"row_key", "seq", "fetch_ts", "write_ts", "host_rev", "batch_id"}
    return [c for c in puts.columns if c not in builtin and c not in fixed]
