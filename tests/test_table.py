import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellar.operators.hooks import links, title_hook
from cellar.options import CrawlOptions
from cellar.plans.ingest import ingest
from cellar.runtime import scratch_path
from cellar.sources.table import CrawlTable
from helpers import rec, records, ts


def _table(spark, **kw):
    name = f"t_{uuid.uuid4().hex[:8]}"
    return CrawlTable(spark, CrawlOptions(table=name, **kw), scratch_path(spark, name))


def test_ensure_and_evolve_case_insensitive(spark):
    t = _table(spark).ensure()
    cols = t.columns()
    assert "curi__url" in cols and "content__raw_data" in cols and cols[-1] == "batch_id"
    added = t.evolve(T.StructType([T.StructField("CURI__URL", T.StringType()), T.StructField("parse__title", T.StringType())]))
    assert added == ["parse__title"]
    assert t.families() == {"curi", "content", "parse"}
    t.ensure()  # idempotent


def test_batches_without_key_files_count_as_stored(spark):
    from cellar.runtime import delete_path

    t = _table(spark, only_write_new=True)
    ingest(records(spark, [rec(1, "http://a.b/1")]), t, 0)
    ingest(records(spark, [rec(2, "http://a.b/2")]), t, 1)
    delete_path(spark, f"{t.location}_keys")  # as stored before there were key files
    ingest(records(spark, [rec(3, "http://a.b/3"), rec(4, "http://a.b/1")]), t, 2)
    ingest(records(spark, [rec(5, "http://a.b/1"), rec(6, "http://a.b/2"), rec(7, "http://a.b/3"), rec(8, "http://a.b/4")]), t, 3)
    assert sorted(r.seq for r in t.scan("seq").collect()) == [1, 2, 3, 8]
    assert sorted(r.row_key[-1] for r in t.keys(exclude_batch=1).collect()) == ["1", "3", "4"]
    t.drop(purge=True)


def test_retry_same_batch_is_idempotent(spark):
    t = _table(spark, only_write_new=True)
    r = records(spark, [rec(1, "http://a.b/1"), rec(2, "http://a.b/2")])
    ingest(r, t, 0)
    ingest(records(spark, [rec(3, "http://a.b/2"), rec(4, "http://a.b/3")]), t, 1)
    first = sorted((x.row_key, x.seq, x.batch_id) for x in t.scan("row_key", "seq", "batch_id").collect())
    ingest(records(spark, [rec(3, "http://a.b/2"), rec(4, "http://a.b/3")]), t, 1)  # replay
    again = sorted((x.row_key, x.seq, x.batch_id) for x in t.scan("row_key", "seq", "batch_id").collect())
    assert first == again == [("r:http://b.a/1", 1, 0), ("r:http://b.a/2", 2, 0), ("r:http://b.a/3", 4, 1)]


def test_lookup_get_domain_compact(spark, tmp_path):
    t = _table(spark)
    rows = [rec(i, u, fetch=ts(i)) for i, u in enumerate(
        ["http://x.example.org/a", "https://example.org/", "http://example.com/", "http://x.example.org/a"])]
    ingest(records(spark, rows), t, 0)
    assert sorted(r.seq for r in t.lookup(["r:http://org.example.x/a"]).collect()) == [0, 3]
    ingest(records(spark, [rec(9, "http://z.example/")]), t, 1)
    ingest(records(spark, []), t, 1)  # a batch that is replaced by an empty one
    g = t.get(spark.createDataFrame([("r:http://org.example.x/a",)], "row_key string")).first()
    assert g.n_versions == 2
    assert sorted(r.seq for r in t.domain_scan("example.org").collect()) == [0, 1, 3]
    c = t.compact(partitions=2)
    assert c.count() == 4 and t.scan().count() == 4
    assert sorted(r.seq for r in t.domain_scan("example.org").collect()) == [0, 1, 3]
    files = sorted({r.f for r in c.select(F.input_file_name().alias("f")).collect()})
    ranges = []
    for f in files:  # each file sorted by (row_key, seq); files hold disjoint ranges
        rows = [(r.row_key, r.seq) for r in spark.read.parquet(f).collect()]
        assert rows == sorted(rows)
        ranges.append((rows[0], rows[-1]))
    ranges.sort()
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_hook_evolves_table_and_side_output(spark, tmp_path):
    t = _table(spark)
    ingest(records(spark, [rec(1, "http://a.b/")]), t, 0)
    raw = b"H\r\n\r\n<title>T</title><a href=\"http://l/1\">x</a>"
    side = str(tmp_path / "links")
    opts = t.opts.with_(content_hook=title_hook(), side_outputs={"links": (lambda p: links(p.withColumn("body", F.col("content__raw_data"))), side)})
    ingest(records(spark, [rec(2, "http://a.b/", raw=raw)]), t, 1, opts=opts)
    got = {r.seq: r.parse__title for r in t.scan("seq", "parse__title").collect()}
    assert got == {1: None, 2: "T"}
    assert [r.link for r in spark.read.parquet(side).collect()] == ["http://l/1"]


def test_rejects_table(spark):
    t = _table(spark)
    ingest(records(spark, [rec(1, "r:http://b.a/"), rec(2, "http://a.b/")]), t, 3)
    got = [(r.seq, r.reason, r.batch_id) for r in t.rejects().collect()]
    assert got == [(1, "already_keyed", 3)]
    assert [r.seq for r in t.scan("seq").collect()] == [2]


def test_payload_files(spark, tmp_path):
    from cellar.sources.payload import read_payload_files

    d = tmp_path / "payloads"
    d.mkdir()
    (d / "a.bin").write_bytes(b"\x00\xffHTTP")
    (d / "b.bin").write_bytes(b"")
    got = {r.path.rsplit("/", 1)[1]: bytes(r.content) for r in read_payload_files(spark, str(d)).collect()}
    assert got == {"a.bin": b"\x00\xffHTTP"}  # zero-length files are not listed by Spark


def test_one_pass_metrics_equal_status_counts(spark, log1):
    from cellar.operators import gates
    from cellar.operators.metrics import status_counts
    from cellar.sources.crawl_log import MAX_CONTENT_BYTES

    opts = CrawlOptions(table=f"t_{uuid.uuid4().hex[:8]}", max_content_bytes=MAX_CONTENT_BYTES,
                        base_write_gate=F.octet_length("request") > 0)
    t = CrawlTable(spark, opts, scratch_path(spark, opts.table))
    got = sorted(tuple(r) for r in ingest(log1.records, t, 0).select("status", "records", "bytes").collect())
    want = sorted(tuple(r) for r in status_counts(gates.write_status(log1.records, None, opts)).collect())
    assert got == want and {g[0] for g in got} == {"written", "unwritten", "unwritten:size"}
    assert t.scan().count() == dict((g[0], g[1]) for g in got)["written"]


def test_ip_resolution_and_missing_ip_rejects(spark):
    hosts = spark.createDataFrame([("a.b", "192.0.2.7")], "host string, ip string")
    t = _table(spark, hosts=hosts)
    ingest(records(spark, [rec(1, "http://a.b/x", ip=None), rec(2, "http://c.d/", ip=None),
                           rec(3, "http://c.d/y", ip="10.0.0.3")]), t, 0)
    got = {r.seq: r.curi__ip for r in t.scan("seq", "curi__ip").collect()}
    assert got == {1: "192.0.2.7", 3: "10.0.0.3"}
    assert [(r.seq, r.reason) for r in t.rejects().collect()] == [(2, "missing_ip")]


def test_resolve_ip(spark):
    from cellar.operators.hooks import resolve_ip

    hosts = spark.createDataFrame([("a.b", "192.0.2.7"), ("c.d", "192.0.2.9"), (None, "192.0.2.1")], "host string, ip string")
    r = records(spark, [rec(1, "http://a.b/x", ip=None), rec(2, "http://e.f/", ip=None), rec(3, "http://c.d/", ip="1.1.1.1"), rec(4, None, ip=None)])
    got = {x.seq: (x.ip, x.ip_status) for x in resolve_ip(r, hosts).collect()}
    assert got == {1: ("192.0.2.7", "resolved"), 2: (None, "missing"), 3: ("1.1.1.1", "given"), 4: (None, "missing")}


def _rows(t):
    return sorted((r.row_key, r.seq, r.batch_id) for r in t.scan("row_key", "seq", "batch_id").collect())


def test_reopen_by_name_uses_the_catalog_location(spark):
    t = _table(spark)
    ingest(records(spark, [rec(1, "http://a.b/1")]), t, 0)
    again = CrawlTable(spark, CrawlOptions(table=t.name))
    assert again.location.rstrip("/").endswith(t.location.rsplit("/", 1)[1])
    ingest(records(spark, [rec(2, "http://a.b/2")]), again, 1)
    assert _rows(t) == _rows(again) == [("r:http://b.a/1", 1, 0), ("r:http://b.a/2", 2, 1)]
    with pytest.raises(ValueError):
        CrawlTable(spark, CrawlOptions(table=t.name), "/somewhere/else")
    with pytest.raises(ValueError):
        CrawlTable(spark, CrawlOptions(table="t_unknown_anywhere")).ensure()


def test_reopen_in_a_fresh_catalog(spark):
    t = _table(spark)
    opts = t.opts.with_(content_hook=title_hook())
    ingest(records(spark, [rec(1, "http://a.b/1", raw=b"\r\n\r\n<title>T</title>"), rec(7, "r:http://x/")]), t, 0, opts=opts)
    place = t.location
    t.drop()  # the catalog forgets the table; the files stay
    again = CrawlTable(spark, t.opts.with_(only_write_new=True), place)
    counts = ingest(records(spark, [rec(2, "http://a.b/1"), rec(3, "http://a.b/3")]), again, 1)
    assert {r.status: r.records for r in counts.collect()} == {"existing": 1, "written": 1}
    assert _rows(again) == [("r:http://b.a/1", 1, 0), ("r:http://b.a/3", 3, 1)]
    assert {r.seq: r.parse__title for r in again.scan("seq", "parse__title").collect()} == {1: "T", 3: None}
    assert [r.seq for r in again.rejects().collect()] == [7] and again.metrics().count() == 4
    again.drop(purge=True)


def test_family_that_differs_in_case_and_a_type_clash(spark):
    t = _table(spark)
    ingest(records(spark, [rec(1, "http://a.b/1")]), t, 0)
    upper = CrawlTable(spark, CrawlOptions(table=t.name, curi_family="CURI"))
    ingest(records(spark, [rec(2, "http://a.b/2")]), upper, 1)
    assert {r.seq: (r.curi__url, r.curi__ip) for r in t.scan("seq", "curi__url", "curi__ip").collect()} == {
        1: ("http://a.b/1", "10.0.0.1"), 2: ("http://a.b/2", "10.0.0.1")}
    from cellar.operators.hooks import base64_serializer

    with pytest.raises(ValueError, match="stored as string"):
        ingest(records(spark, [rec(3, "http://a.b/3")]), t, 2, opts=t.opts.with_(serializer=base64_serializer))
    t.drop(purge=True)


def test_reused_seq_across_batches_returns_the_newest_bytes(spark):
    t = _table(spark)
    ingest(records(spark, [rec(1, "http://a.b/", write=ts(10), raw=b"old")]), t, 0)
    ingest(records(spark, [rec(1, "http://a.b/", write=ts(20), raw=b"new")]), t, 1)
    ingest(records(spark, [rec(1, "http://a.b/", write=ts(20), raw=b"late batch")]), t, 2)
    row = t.latest().first()
    assert bytes(row.content__raw_data) == b"late batch" and row.n_versions == 3


def test_record_delivered_twice_is_written_once_in_only_new_mode(spark):
    t = _table(spark, only_write_new=True)
    twice = [rec(1, "http://a.b/", raw=b"x" * 5), rec(1, "http://a.b/", raw=b"x" * 5), rec(2, "http://c.d/")]
    ingest(records(spark, twice), t, 0)
    assert _rows(t) == [("r:http://b.a/", 1, 0), ("r:http://d.c/", 2, 0)]


def test_missing_sizes_and_times_are_measured(spark):
    from cellar.operators import gates
    from cellar.plans.ingest import plan_ingest

    opts = CrawlOptions(table="t", max_content_bytes=10)
    big, none = list(rec(1, "http://a.b/1", raw=b"x" * 500)), list(rec(2, "http://a.b/2", raw=None))
    big[10] = none[10] = None
    none[4] = None  # no store time: the fetch time stands in
    p = plan_ingest(records(spark, [tuple(big), tuple(none)]), opts)
    got = {r.seq: (r.status, r.content_size, r.write_ts) for r in p.statuses.collect()}
    assert got == {1: ("unwritten:size", 500, ts(1)), 2: ("written", 0, ts(2))}
    assert {r.seq: r.status for r in gates.write_status(records(spark, [tuple(big)]), None, opts).collect()} == {1: "unwritten:size"}


def test_rejects_are_recorded_after_the_budget_and_null_times_count_first(spark):
    t = _table(spark, max_total_bytes=4)
    nulls = list(rec(5, "http://a.b/n", raw=b"xx"))
    nulls[3] = nulls[4] = None
    rows = [rec(1, "http://a.b/1", raw=b"x" * 6), rec(2, "http://a.b/2"), rec(3, "r:http://late/"), tuple(nulls)]
    counts = {r.status: r.records for r in ingest(records(spark, rows), t, 0).collect()}
    assert counts == {"written": 2, "over_budget": 1, "rejected": 1}
    assert [r.seq for r in t.rejects().collect()] == [3] and sorted(r.seq for r in t.scan("seq").collect()) == [1, 5]


def test_domain_scan_covers_user_parts_schemes_case_and_md5_keys(spark):
    urls = ["http://u@x.example.org/a", "ftp://x.example.org/b", "HTTP://Example.ORG/", "https://example.org:8443/", "http://example.orgx/", "http://org.example/",
            "mailto:a@example.org"]
    for md5 in (False, True):
        t = _table(spark, md5_key=md5)
        ingest(records(spark, [rec(i, u) for i, u in enumerate(urls)]), t, 0)
        assert sorted(r.seq for r in t.domain_scan("example.org").collect()) == [0, 1, 2, 3]
        t.drop(purge=True)
    from cellar.sources.table import domain_scan

    with pytest.raises(ValueError):
        domain_scan(spark.createDataFrame([("abc",)], "row_key string"), "example.org")


def test_payload_files_feed_an_ingest(spark, tmp_path):
    from cellar.sources.payload import read_payload_files, with_payload

    d = tmp_path / "payloads"
    d.mkdir()
    (d / "a.bin").write_bytes(b"HTTP/1.1 200 OK\r\n\r\nbody")
    files = read_payload_files(spark, str(d))
    place = files.first().path
    rows = records(spark, [rec(1, "http://a.b/1", raw=None), rec(2, "http://a.b/2", raw=b"own")]).withColumn(
        "payload_path", F.when(F.col("seq") == 1, F.lit(place)).otherwise(F.lit("file:/no/such")))
    t = _table(spark)
    ingest(with_payload(rows, files), t, 0)
    assert {r.seq: bytes(r.content__raw_data) for r in t.scan("seq", "content__raw_data").collect()} == {1: b"HTTP/1.1 200 OK\r\n\r\nbody", 2: b"own"}
    t.drop(purge=True)


def test_no_private_scratch_folder_off_local_mode(spark, monkeypatch):
    from cellar import runtime

    monkeypatch.setattr(runtime, "_conf", lambda s, k: "spark://host:7077" if k == "spark.master" else None)
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        runtime.checkpoint_root(spark)


def test_runs_are_small_and_compacted_by_what_a_task_sorts(spark, monkeypatch):
    """Versions of a page compress across rows, in both layouts; the number of files follows the bytes before compression."""
    import random
    import uuid

    from cellar.options import CrawlOptions
    from cellar.runtime import folder_names, scratch_path
    from cellar.sources import table as tables

    rng = random.Random(3)
    pages = [bytes(rng.choices(range(256), k=100_000)) for _ in range(6)]
    opts = CrawlOptions(table=f"z_{uuid.uuid4().hex[:8]}")
    t = tables.CrawlTable(spark, opts, scratch_path(spark, opts.table)).ensure()
    rows = [(f"r:http://h/{k}", k * 10 + v, "h", pages[k]) for k in range(6) for v in range(10)]
    puts = spark.createDataFrame(rows, "row_key string, seq bigint, host_rev string, content__raw_data binary").coalesce(1)
    t.write_batch(puts, 0)
    run = t.snapshot().runs[0]
    assert run.plain == sum(len(r[0]) + len(r[2]) + len(r[3]) for r in rows)
    assert run.bytes < run.plain // 4
    monkeypatch.setattr(tables, "PLAIN_BYTES", 2 << 20)
    for layout in ("key", "host_time"):
        t.compact(layout=layout)
        new = t.snapshot().runs[0]
        assert new.plain == run.plain and new.bytes < new.plain // 4
        assert len([f for f in folder_names(spark, f"{t.location}/{new.path}") if f.startswith("part-")]) == 3
        assert sorted(r.seq for r in t.scan("seq").collect()) == sorted(r[1] for r in rows)
    t.drop(purge=True)
