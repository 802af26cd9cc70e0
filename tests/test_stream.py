import uuid

from pyspark.sql import functions as F

from cellar.options import CrawlOptions
from cellar.plans.ingest import ingest, plan_ingest
from cellar.runtime import scratch_path
from cellar.sources.crawl_log import MAX_CONTENT_BYTES
from cellar.sources.table import CrawlTable
from cellar.streaming.ingest import read_record_stream, run_until_spent, start_ingest
from cellar.plans.queries import _write_arrival_files


def test_stream_equals_batch(spark, log1):
    opts = CrawlOptions(table=f"s_{uuid.uuid4().hex[:8]}", max_content_bytes=MAX_CONTENT_BYTES, only_write_new=True)
    t = CrawlTable(spark, opts, scratch_path(spark, opts.table))
    src = scratch_path(spark, "src")
    _write_arrival_files(log1.records, src, 4)
    q = start_ingest(read_record_stream(spark, src, 1), t, scratch_path(spark, "ckpt"))
    q.awaitTermination()
    assert q.exception() is None
    got = sorted((r.row_key, r.seq) for r in t.scan("row_key", "seq").collect())
    want = sorted((r.row_key, r.seq) for r in plan_ingest(log1.records, opts).puts.select("row_key", "seq").collect())
    assert got == want
    assert sorted({r.batch_id for r in t.scan("batch_id").collect()}) == [0, 1, 2, 3]


def test_stream_budget_stops(spark, log1):
    limit = log1.max_total_bytes // 4
    opts = CrawlOptions(table=f"s_{uuid.uuid4().hex[:8]}", max_content_bytes=MAX_CONTENT_BYTES, max_total_bytes=limit)
    t = CrawlTable(spark, opts, scratch_path(spark, opts.table))
    src = scratch_path(spark, "src")
    _write_arrival_files(log1.records, src, 4)
    q = start_ingest(read_record_stream(spark, src, 1), t, scratch_path(spark, "ckpt"))
    run_until_spent(q)
    got = sorted(r.seq for r in t.scan("seq").collect())
    want = sorted(r.seq for r in plan_ingest(log1.records, opts).puts.select("seq").collect())
    assert got == want


def test_stream_and_batch_agree_on_files_without_sizes_and_times(spark, log1):
    opts = CrawlOptions(table=f"s_{uuid.uuid4().hex[:8]}", max_content_bytes=MAX_CONTENT_BYTES)
    t = CrawlTable(spark, opts, scratch_path(spark, opts.table))
    src = scratch_path(spark, "src")
    bare = log1.records.drop("content_size", "write_ts")
    bare.write.parquet(src)
    q = start_ingest(read_record_stream(spark, src), t, scratch_path(spark, "ckpt"))
    q.awaitTermination()
    assert q.exception() is None
    got = sorted((r.seq, r.write_ts) for r in t.scan("seq", "write_ts").collect())
    want = sorted((r.seq, r.write_ts) for r in plan_ingest(bare, opts).puts.select("seq", "write_ts").collect())
    assert got == want and len(got) < log1.n_events
    t.drop(purge=True)
