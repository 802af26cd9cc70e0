"""Small builders for hand-written crawl records."""

from __future__ import annotations

import datetime as dt

from cellar.sources.crawl_log import RECORD_SCHEMA

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def ts(ms: int, us: int = 0) -> dt.datetime:
    return T0 + dt.timedelta(milliseconds=ms, microseconds=us)


def rec(seq, url, *, ip="10.0.0.1", fetch=None, write=None, is_seed=False, path=None, via=None,
        request=b"GET x", raw=b"HTTP/1.1 200 OK\r\n\r\nbody", size=None, annotations=None):
    fetch = fetch if fetch is not None else ts(seq)
    write = write if write is not None else fetch
    return (seq, url, ip, fetch, write, is_seed, path, via, request, raw,
            len(raw) if size is None and raw is not None else size, annotations or [])


def records(spark, rows):
    return spark.createDataFrame(rows, RECORD_SCHEMA)
