"""Property: set-based decisions equal the record-at-a-time loop on random inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cellar.operators import gates
from cellar.options import CrawlOptions
from cellar.plans.ingest import plan_ingest
from helpers import rec, records, ts
from test_gates import simulate

URLS = ["http://a.example.org/", "http://a.example.org/x", "https://b.example.com/", "http://c.example.net/p?q=1"]

row = st.tuples(
    st.sampled_from(URLS),
    st.integers(min_value=0, max_value=5),  # write time in ms: many ties
    st.integers(min_value=0, max_value=999),  # sub-ms micros
    st.integers(min_value=0, max_value=40),  # payload bytes
    st.booleans(),  # empty request
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(row, min_size=1, max_size=14),
    stored=st.lists(st.sampled_from(URLS), max_size=2),
    only_write=st.booleans(),
    only_process=st.booleans(),
    budget=st.sampled_from([0, 25, 60]),
)
def test_statuses_equal_loop(spark, rows, stored, only_write, only_process, budget):
    opts = CrawlOptions(table="p", max_content_bytes=30, only_write_new=only_write,
                        only_process_new=only_process, max_total_bytes=budget)
    recs = records(spark, [
        rec(i, u, write=ts(ms, us), raw=b"x" * n, request=b"" if empty else b"GET")
        for i, (u, ms, us, n, empty) in enumerate(rows)
    ])
    table = None
    if stored:
        table = plan_ingest(records(spark, [rec(100 + i, u) for i, u in enumerate(stored)]), opts.with_(
            only_write_new=False, only_process_new=False, max_total_bytes=0)).puts
    stored_keys = [r.row_key for r in table.select("row_key").collect()] if table is not None else []
    ctrl = [r.asDict() for r in gates.control_columns(recs, opts).collect()]
    want = simulate(ctrl, stored_keys, opts)
    plan = plan_ingest(recs, opts, keys=table)
    assert {r.seq: r.status for r in plan.statuses.collect()} == want
    assert sorted(r.seq for r in plan.puts.select("seq").collect()) == sorted(s for s, v in want.items() if v == "written")
