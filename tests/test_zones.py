"""Scans by key, domain and time open only the files whose zones allow a row, and lose none."""

import pytest
from pyspark.sql import functions as F

from cellar.options import CrawlOptions
from cellar.plans.ingest import ingest
from cellar.runtime import scratch_path
from cellar.sources.table import CrawlTable
from helpers import rec, records, ts

HOSTS = ["a.org", "www.a.org", "b.org", "a-x.org", "c.net", "z.com", "a.org.uk"]


@pytest.fixture(scope="module")
def filled(spark):
    t = CrawlTable(spark, CrawlOptions(table="t_zones"), scratch_path(spark, "zones"))
    rows = [rec(k, f"http://{HOSTS[k % 7]}/{k % 40}", write=ts(1000 * ((k * 37) % 280))) for k in range(280)]
    rows.append(rec(900, "urn:x"))
    for b in range(2):
        ingest(records(spark, rows[b::2]), t, b)
    t.compact(24, layout="host_time")
    ingest(records(spark, rows[1::2][:60]), t, 1)  # batch 1 again, shorter: masked in the merged run
    yield t
    t.drop(purge=True)


CASES = [{"domain": "a.org"}, {"domain": "A.org.", "since": ts(50_000), "until": ts(90_000)}, {"since": ts(270_000)},
         {"until": ts(0)}, {"keys": ["r:http://org.a/0", "r:http://net.c/4", "none"]}, {"keys": []}, {"domain": "no.such"}, {}]


@pytest.mark.parametrize("case", CASES)
def test_rows_equal_the_full_scan(filled, case):
    def fits(r):
        dom = case.get("domain", "").lower().strip(".")
        host = ".".join(reversed(r.host_rev.split(".")))
        return (("domain" not in case or host == dom or host.endswith("." + dom))
                and ("since" not in case or r.write_ts >= case["since"]) and ("until" not in case or r.write_ts < case["until"])
                and ("keys" not in case or r.row_key in case["keys"]))

    want = sorted((r.row_key, r.seq) for r in filled.scan().collect() if fits(r))
    assert sorted((r.row_key, r.seq) for r in filled.scan_where("row_key", "seq", **case).collect()) == want


def test_only_matching_files_are_opened(filled):
    case = {"domain": "a.org", "since": ts(50_000), "until": ts(90_000)}
    opened = set(filled.scan_where(**case).inputFiles())
    every = set(filled.scan().inputFiles())
    hold = {r.f for r in filled.scan().filter(F.col("write_ts").between(ts(50_000), ts(89_999))).filter("host_rev = 'org.a' OR host_rev LIKE 'org.a.%'")
            .select(F.input_file_name().alias("f")).collect()}
    assert {p.split("/")[-1] for p in hold} <= {p.split("/")[-1] for p in opened} and len(opened) < len(every) / 2


def test_an_unknown_layout(filled):
    with pytest.raises(ValueError):
        filled.compact(layout="other")
