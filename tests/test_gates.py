"""Set-based decisions against a one-record-at-a-time loop of the write path."""

import itertools

import pytest
from pyspark.sql import functions as F

from cellar.operators import gates
from cellar.operators.budget import within_cutoff
from cellar.options import CrawlOptions
from cellar.plans.ingest import plan_ingest
from cellar.sources.crawl_log import MAX_CONTENT_BYTES
from helpers import rec, records, ts

BASE = CrawlOptions(table="t", max_content_bytes=MAX_CONTENT_BYTES)


def simulate(rows, stored, opts):
    """The reference's loop: gates, lookup, write, byte check, record by record."""
    table, total, stopped, out = set(stored), 0, False, {}
    for r in sorted(rows, key=lambda r: (r["write_ts"], r["seq"])):
        k = r["row_key"]
        if stopped:
            s = "over_budget"
        elif not r["bp"]:
            s = "not_processed"
        elif opts.only_process_new and k in table:
            s = "not_processed"
        elif not r["bw"]:
            s = "unwritten"
        elif r["content_size"] > opts.max_content_bytes:
            s = "unwritten:size"
        elif opts.only_write_new and k in table:
            s = "existing"
        else:
            table.add(k)
            total += r["content_size"]
            s = "written"
            if opts.max_total_bytes and total > opts.max_total_bytes:
                stopped = True
        out[r["seq"]] = s
    return out


def _run(log, opts):
    existing = plan_ingest(log.existing(), BASE.with_(md5_key=opts.md5_key), batch_id=0).puts
    stored = [r.row_key for r in existing.select("row_key").distinct().collect()]
    ctrl = gates.control_columns(log.incoming(), opts).collect()
    want = simulate([r.asDict() for r in ctrl], stored, opts)
    plan = plan_ingest(log.incoming(), opts, keys=existing, batch_id=1)
    got = {r.seq: r.status for r in plan.statuses.collect()}
    written = {r.seq for r in plan.puts.select("seq").collect()}
    return want, got, written


MODES = list(itertools.product([False, True], [False, True], [False, True]))


@pytest.mark.parametrize("only_write,only_process,md5", MODES)
def test_matches_sequential_loop(log1, only_write, only_process, md5):
    opts = BASE.with_(only_write_new=only_write, only_process_new=only_process, md5_key=md5)
    want, got, written = _run(log1, opts)
    assert got == want
    assert written == {s for s, v in want.items() if v == "written"}


@pytest.mark.parametrize("only_write", [False, True])
def test_budget_matches_sequential_loop(log1, only_write):
    opts = BASE.with_(only_write_new=only_write, max_total_bytes=log1.max_total_bytes // 10,
                      base_write_gate=F.octet_length("request") > 0,
                      base_process_gate=~F.col("url").contains(".example.net"))
    want, got, written = _run(log1, opts)
    assert "over_budget" in want.values()
    assert got == want
    assert written == {s for s, v in want.items() if v == "written"}


def test_size_gate_boundary(spark):
    opts = BASE.with_(max_content_bytes=10)
    rows = [rec(1, "http://a.b/1", raw=b"x" * 10), rec(2, "http://a.b/2", raw=b"x" * 11)]
    st = {r.seq: r.status for r in gates.write_status(records(spark, rows), None, opts).collect()}
    assert st == {1: "written", 2: "unwritten:size"}


def test_oversize_first_does_not_shadow(spark):
    opts = BASE.with_(max_content_bytes=10, only_write_new=True)
    rows = [rec(1, "http://a.b/", raw=b"x" * 50), rec(2, "http://a.b/", raw=b"small")]
    p = plan_ingest(records(spark, rows), opts)
    assert [r.seq for r in p.puts.collect()] == [2]
    assert {r.seq: r.status for r in p.statuses.collect()} == {1: "unwritten:size", 2: "written"}


def test_first_wins_in_arrival_order(spark):
    opts = BASE.with_(only_write_new=True)
    rows = [rec(5, "http://a.b/", write=ts(30)), rec(9, "http://a.b/", write=ts(20)),
            rec(3, "http://a.b/", write=ts(20))]
    assert [r.seq for r in plan_ingest(records(spark, rows), opts).puts.collect()] == [3]


def test_md5_lookup_uses_stored_form(spark):
    opts = BASE.with_(only_write_new=True, md5_key=True)
    first = plan_ingest(records(spark, [rec(1, "http://a.b/")]), opts).puts
    again = plan_ingest(records(spark, [rec(2, "http://a.b/")]), opts, keys=first)
    assert again.puts.count() == 0
    assert again.statuses.first().status == "existing"


def test_rejected_keys(spark):
    rows = [rec(1, "r:http://b/"), rec(2, "http://b/")]
    p = plan_ingest(records(spark, rows), BASE)
    assert {r.seq: r.status for r in p.statuses.collect()} == {1: "rejected", 2: "written"}
    assert [r.seq for r in p.puts.collect()] == [2]


def test_annotate(spark):
    opts = BASE.with_(max_content_bytes=3)
    r = records(spark, [rec(1, "http://a.b/", raw=b"long", annotations=["x"]), rec(2, "http://a.b/", raw=b"ab")])
    out = gates.annotate(r, opts)
    assert out.columns == r.columns
    got = {x.seq: x.annotations for x in out.collect()}
    assert got == {1: ["x", "unwritten:size"], 2: []}


def test_within_cutoff_none_and_all():
    assert str(within_cutoff(None)) == str(F.lit(True))
    assert str(within_cutoff("none")) == str(F.lit(False))


def test_annotate_with_only_process_new(spark):
    opts = BASE.with_(max_content_bytes=3, only_process_new=True)
    r = records(spark, [rec(1, "http://a.b/", raw=b"ab"), rec(2, "http://a.b/", raw=b"long"), rec(3, "http://c.d/", raw=b"long")])
    out = gates.annotate(r, opts, gates.write_status(r, None, opts))
    assert {x.seq: x.annotations for x in out.collect()} == {1: [], 2: [], 3: ["unwritten:size"]}


def test_materialized_puts_equal_direct(log1):
    opts = BASE.with_(only_write_new=True, max_total_bytes=log1.max_total_bytes // 10)
    existing = plan_ingest(log1.existing(), BASE, batch_id=0).puts
    direct = plan_ingest(log1.incoming(), opts, keys=existing, batch_id=1)
    mat = plan_ingest(log1.incoming(), opts, keys=existing, batch_id=1, materialize=True)
    want = sorted(r.seq for r in direct.puts.select("seq").collect())
    assert want and sorted(r.seq for r in mat.puts.select("seq").collect()) == want


@pytest.mark.parametrize("only_write,only_process", [(False, False), (True, False), (False, True)])
def test_hot_key_third_of_rows(spark, only_write, only_process):
    """One URL holds a third of all fetches: results still equal the loop."""
    rows = []
    for i in range(900):
        url = "http://hot.example.org/" if i % 3 == 0 else f"http://h{i % 97}.example.com/p{i % 13}"
        rows.append(rec(i, url, write=ts((i * 7) % 400, i % 1000), raw=b"x" * ((i * 31) % 50)))
    opts = BASE.with_(max_content_bytes=40, only_write_new=only_write, only_process_new=only_process,
                      max_total_bytes=5000)
    recs = records(spark, rows)
    ctrl = [r.asDict() for r in gates.control_columns(recs, opts).collect()]
    want = simulate(ctrl, [], opts)
    plan = plan_ingest(recs, opts)
    assert {r.seq: r.status for r in plan.statuses.collect()} == want
    assert sorted(r.seq for r in plan.puts.select("seq").collect()) == sorted(s for s, v in want.items() if v == "written")


def test_md5_keys_match_plain_keys_one_to_one(log1):
    for mode in ({"only_write_new": True}, {"only_process_new": True}, {}):
        plain = BASE.with_(**mode)
        hashed = BASE.with_(md5_key=True, **mode)
        ex_p = plan_ingest(log1.existing(), BASE, batch_id=0).puts
        ex_h = plan_ingest(log1.existing(), BASE.with_(md5_key=True), batch_id=0).puts
        p = plan_ingest(log1.incoming(), plain, keys=ex_p).puts.select("seq", "row_key").collect()
        h = plan_ingest(log1.incoming(), hashed, keys=ex_h).puts.select("seq", "row_key").collect()
        assert sorted(r.seq for r in p) == sorted(r.seq for r in h)
        import hashlib

        by_seq = {r.seq: r.row_key for r in h}
        assert all(by_seq[r.seq] == hashlib.md5(r.row_key.encode()).hexdigest() for r in p)


def test_write_new_keys_unique(log1):
    existing = plan_ingest(log1.existing(), BASE, batch_id=0).puts
    puts = plan_ingest(log1.incoming(), BASE.with_(only_write_new=True), keys=existing).puts
    keys = [r.row_key for r in puts.select("row_key").collect()]
    assert len(keys) == len(set(keys)) == 37


@pytest.mark.parametrize("budget", [0, 200_000])
def test_observed_counts_equal_recount(log1, budget):
    from cellar.operators.metrics import status_counts

    existing = plan_ingest(log1.existing(), BASE, batch_id=0).puts
    opts = BASE.with_(only_write_new=True, max_total_bytes=budget)
    plan = plan_ingest(log1.incoming(), opts, keys=existing, batch_id=1, materialize=True)
    want = sorted((r.status, r.records, r.bytes) for r in status_counts(plan.statuses).collect())
    assert sorted(plan.counts) == want


def test_a_record_delivered_twice_is_planned_once_with_and_without_stages(spark):
    from helpers import rec, records

    rows = records(spark, [rec(1, "http://a.b/"), rec(1, "http://a.b/"), rec(2, "http://c.d/")])
    for materialize in (False, True):
        assert plan_ingest(rows, BASE.with_(only_write_new=True), materialize=materialize).puts.count() == 2
