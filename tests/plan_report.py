"""Write PLANS.md: physical operator trees of the main plans (explain formatted).

Usage: python tests/plan_report.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    text = buf.getvalue()
    head = text.split("\n\n\n", 1)[0]
    scans = re.findall(r"\((\d+)\) Scan parquet[^\n]*\n(?:[^\n]+\n)*?ReadSchema: ([^\n]+)", text)
    pushed = re.findall(r"PushedFilters: (\[[^\n]*\])", text)
    extra = [f"scan ({n}) ReadSchema: {s}" for n, s in scans] + [f"PushedFilters: {p}" for p in pushed if p != "[]"]
    return head.strip() + ("\n\n" + "\n".join(extra) if extra else "")


def main(sf_dir: str) -> None:
    from compare import session

    from cellar.operators import gates
    from cellar.operators.cells import latest_wide
    from cellar.operators.project import put_rows
    from cellar.plans import queries as Q
    from cellar.plans.ingest import plan_ingest
    from cellar.runtime import scratch_path
    from cellar.sources.crawl_log import read_records
    from cellar.sources.table import domain_scan

    spark = session()
    log = Q._log(spark, sf_dir)
    path = scratch_path(spark, "plan-records")
    log.records.write.parquet(path)
    rec = read_records(spark, path, sizes_complete=True)  # stored crawl records, as an ingest job sees them
    table = put_rows(rec, Q.BASE, 0)
    tpath = scratch_path(spark, "plan-table")
    table.write.parquet(tpath)
    stored = spark.read.parquet(tpath)
    wopts = Q.BASE.with_(only_write_new=True)
    sections = [
        ("Only-write-new statuses (narrow; no payload in any scan)", gates.write_status(rec, stored, wopts).drop("bytes")),
        ("Only-write-new put rows (decided on narrow columns, then one join with the payload)",
         plan_ingest(rec, wopts, keys=stored).puts),
        ("Default mode put rows (filter only)", plan_ingest(rec, Q.BASE).puts),
        ("Byte budget put rows (cutoff applied as a filter)",
         plan_ingest(rec, Q.BASE.with_(max_total_bytes=log.max_total_bytes)).puts),
        ("Per-cell latest, wide (payload fetched for winners only)", latest_wide(stored, Q.BASE)),
        ("Domain scan (prefix filters pushed to Parquet)", domain_scan(stored, "example.org")),
    ]
    out = ["# PLANS", "",
           f"Physical plans from `explain(\"formatted\")` on local[8], input `{os.path.basename(sf_dir)}` "
           "written as Parquet records (regenerate with `python tests/plan_report.py`).", ""]
    for title, df in sections:
        out += [f"## {title}", "", "```", tree(df), "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    print("wrote PLANS.md")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
