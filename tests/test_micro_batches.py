"""Many small batches: few jobs each, keys and zones put together, the same rows as one batch."""

import uuid

from pyspark.sql import functions as F

from cellar.options import CrawlOptions
from cellar.plans import ingest as plans
from cellar.plans.ingest import ingest, plan_ingest
from cellar.plans.queries import _write_arrival_files
from cellar.runtime import scratch_path
from cellar.sources import table as tables
from cellar.sources.crawl_log import MAX_CONTENT_BYTES
from cellar.sources.table import CrawlTable
from cellar.streaming.ingest import read_record_stream, start_ingest
from helpers import rec, records, ts

NEW = CrawlOptions(table="t", max_content_bytes=MAX_CONTENT_BYTES, only_write_new=True)


def _table(spark, opts=NEW):
    opts = opts.with_(table=f"m_{uuid.uuid4().hex[:8]}")
    return CrawlTable(spark, opts, scratch_path(spark, opts.table))


def _stored(t):
    return sorted((r.row_key, r.seq) for r in t.scan("row_key", "seq").collect())


def test_a_micro_batch_has_few_jobs_and_the_key_folders_stay_few(spark, log1, monkeypatch):
    monkeypatch.setattr(tables, "INDEX_FAN", 2)
    t, src, n = _table(spark), scratch_path(spark, "src"), 8
    _write_arrival_files(log1.records, src, n)
    q = start_ingest(read_record_stream(spark, src, 1), t, scratch_path(spark, "ckpt"))
    q.awaitTermination()
    assert q.exception() is None
    runs = t.snapshot().runs
    assert len(runs) == n and len({r.keys for r in runs}) == 1 and {r.sharing for r in runs} == {n}
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(str(q.runId))) < 18 * n  # with the folders put together
    want = sorted((r.row_key, r.seq) for r in plan_ingest(log1.records, t.opts).puts.select("row_key", "seq").collect())
    assert _stored(t) == want
    assert sorted(r.row_key for r in t.keys().collect()) == [k for k, _ in want]
    asked = [want[0][0], want[-1][0]]
    assert sorted(r.row_key for r in t.scan_where("row_key", keys=asked).collect()) == sorted(asked)
    assert {r.path: 1 for r in runs} != {p: len(f) for p, f in t.matching_files(tables.Wanted(keys=asked), runs).items()}
    t.drop(purge=True)


def test_a_batch_of_a_shared_folder_can_be_written_again(spark):
    t = _table(spark)
    for b in range(3):
        ingest(records(spark, [rec(b, f"http://a.b/{b}"), rec(9, "http://a.b/all")]), t, b, micro=True)
    assert t.index(rest=True) == 1 and {r.sharing for r in t.snapshot().runs} == {3}
    ingest(records(spark, [rec(7, "http://a.b/7")]), t, 1, micro=True)
    want = [f"r:http://b.a/{k}" for k in ("0", "2", "7", "all")]
    for _ in range(2):  # the new run without a folder, then with one
        assert sorted(r.row_key for r in t.keys().collect()) == want == [k for k, _ in _stored(t)]
        assert sorted(r.row_key for r in t.keys(exclude_batch=2).collect()) == [want[0], *want[2:]]
        assert [r.row_key for r in t.scan_where("row_key", keys=["r:http://b.a/1"]).collect()] == []
        assert [r.row_key for r in t.scan_where("row_key", keys=[want[2]]).collect()] == [want[2]]
        t.index(rest=True)
    t.drop(purge=True)


def test_few_and_many_keys_decide_alike(spark, monkeypatch):
    """A null number, one record twice, one key often, a record that cannot be keyed; keys broadcast or not."""
    rows = [rec(1, "http://a.b/1"), rec(1, "http://a.b/1"), rec(2, "http://a.b/1"), rec(3, "http://a.b/3"), rec(4, "http://a.b/4", ip=None),
            rec(None, "http://a.b/5", fetch=rec(5, "x")[3]), rec(6, "http://a.b/5"), rec(8, "http://a.b/8", size=MAX_CONTENT_BYTES + 1)]
    got = []
    for few, micro in ((0, False), (plans.FEW_BYTES, True), (-1, True)):
        monkeypatch.setattr(plans, "FEW_BYTES", few)
        t = _table(spark)
        ingest(records(spark, [rec(0, "http://a.b/3")]), t, 0, micro=micro)
        counts = ingest(records(spark, rows), t, 1, micro=micro)
        got.append((sorted(map(tuple, counts.collect())), [k for k, _ in _stored(t)], sorted(map(tuple, t.rejects().collect()))))
        t.drop(purge=True)
    assert all(g == got[0] for g in got) and len(got[0][1]) == 3


def test_a_micro_batch_writes_in_its_second_pass(spark, log1):
    """Facts of the keys, then one pass that decides and writes; no job for the metrics."""
    t, src, n = _table(spark), scratch_path(spark, "src"), 6
    _write_arrival_files(log1.records, src, n)
    q = start_ingest(read_record_stream(spark, src, 1), t, scratch_path(spark, "ckpt"))
    q.awaitTermination()
    assert q.exception() is None
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(str(q.runId))) < 11 * n
    told = t.metrics().groupBy("batch_id").agg(F.sum("records").alias("n")).collect()
    assert len(told) == n and sum(r.n for r in told) == log1.n_events
    t.drop(purge=True)


def test_modes_gates_and_odd_records_decide_as_in_a_batch(spark):
    """A key delivered twice as first, as a later one and for a stored key; missing numbers and times; no record at all."""
    rows = [rec(1, "http://a.b/1"), rec(1, "http://a.b/1"), rec(4, "http://a.b/1"), rec(2, "http://a.b/2", request=b""), rec(3, "http://a.b/2"),
            rec(5, "http://a.b/3"), rec(5, "http://a.b/3"), rec(6, "http://a.b/4", raw=b"x" * (MAX_CONTENT_BYTES + 1)), rec(7, "http://a.b/4"),
            rec(None, "http://a.b/5", fetch=ts(8)), rec(8, "http://a.b/5"), rec(9, "http://c.d/9"), rec(10, None), rec(11, "http://a.b/6", ip=None)]
    gates = {"base_process_gate": ~F.col("url").contains("c.d"), "base_write_gate": F.octet_length("request") > 0}
    once = [rows[0], *rows[2:6], *rows[7:]]
    for opts, some in ((NEW, rows), (NEW, []), (NEW.with_(**gates), once), (NEW.with_(only_write_new=False, only_process_new=True, **gates), once)):
        got = []
        for micro in (False, True):
            t = _table(spark, opts)
            ingest(records(spark, [rec(0, "http://a.b/3")]), t, 0, micro=micro)
            ingest(records(spark, [rec(0, "http://a.b/3"), rec(1, "http://a.b/7")]), t, 1, opts.with_(only_write_new=False, only_process_new=False))
            counts = ingest(records(spark, some), t, 2, micro=micro)
            got.append((sorted(map(tuple, counts.collect())), _stored(t), sorted(map(tuple, t.metrics().collect()))))
            t.drop(purge=True)
        assert got[0] == got[1]


def test_of_records_alike_in_key_time_and_number_only_the_accepted_is_written(spark):
    t = _table(spark)
    alike = [rec(1, "http://a.b/1", raw=b"ok"), rec(1, "http://a.b/1", raw=b"x" * (MAX_CONTENT_BYTES + 1))]
    counts = ingest(records(spark, alike), t, 0, micro=True)
    assert {r.status: r.records for r in counts.collect()} == {"written": 1, "unwritten:size": 1}
    assert [bytes(r[0]) for r in t.scan("content__raw_data").collect()] == [b"ok"]
    t.drop(purge=True)
