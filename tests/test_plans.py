"""Plan shape: what reaches the scan, where shuffles and Python nodes appear."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from cellar.operators import gates
from cellar.options import CrawlOptions
from cellar.plans.ingest import plan_ingest
from cellar.runtime import scratch_path
from cellar.sources.crawl_log import MAX_CONTENT_BYTES, read_records
from cellar.sources.table import domain_scan

OPTS = CrawlOptions(table="t", max_content_bytes=MAX_CONTENT_BYTES)


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def stored(spark, log1):
    path = scratch_path(spark, "records")
    log1.records.write.parquet(path)
    return read_records(spark, path, sizes_complete=True)


def _read_schemas(p: str) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^\n]*>)", p)


def _keys(stored):
    from cellar.operators.project import put_rows

    return put_rows(stored, OPTS, 0)


def test_gate_plan_reads_no_payload(stored):
    p = plan(gates.write_status(stored, _keys(stored), OPTS.with_(only_write_new=True)).drop("bytes"))
    schemas = _read_schemas(p)
    assert schemas and all("raw_data" not in s and "request" not in s for s in schemas), schemas


def test_payload_moves_only_into_the_last_join(stored):
    """In the put plan no Exchange carries payload except those right under the one join with the chosen records."""
    df = plan_ingest(stored, OPTS.with_(only_write_new=True), keys=_keys(stored)).puts
    p = plan(df)
    assert "PythonUDF" not in p and "ArrowEvalPython" not in p and "BatchEvalPython" not in p
    physical = df._jdf.queryExecution().sparkPlan()
    joins = []

    def walk(node):
        kids = [node.children().apply(i) for i in range(node.children().size())]
        outs = [str(node.output().apply(i)) for i in range(node.output().size())]
        carries = any("raw_data" in o for o in outs)
        if "Join" in node.nodeName() or "Aggregate" in node.nodeName() or "Window" in node.nodeName() or "Sort" == node.nodeName():
            joins.append((node.nodeName(), carries))
        for k in kids:
            walk(k)

    walk(physical)
    assert sum(c for _, c in joins) == 1 and joins[0][1], joins  # the top-most, a semi join; decisions below it are narrow


def test_same_rows_with_and_without_broadcasts(spark, log1):
    opts = OPTS.with_(only_write_new=True)
    got = []
    for size in ("10485760", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
        try:
            puts = plan_ingest(log1.incoming(), opts, keys=plan_ingest(log1.existing(), OPTS, batch_id=0).puts, materialize=True).puts
            got.append(sorted((r.row_key, r.seq, bytes(r.content__raw_data)) for r in puts.collect()))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got[0] == got[1] and len(got[0]) == 37


def test_hot_key_is_split(spark):
    """Half of the rows on one URL, and as many without a key: the join deals both to many tasks."""
    from cellar.operators.joins import salted_join

    left = spark.range(40_000).select(F.col("id").alias("seq"), F.when(F.col("id") % 2 == 0, F.lit("hot")).when(F.col("id") % 4 == 1, F.concat(F.lit("k"), "id")).alias("row_key"))
    right = left.filter("row_key is not null").select("row_key", F.lit(1).alias("x")).distinct()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        out = salted_join(left, right, "row_key", "seq")
        sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
        assert out.count() == 40_000 and out.filter("x is null").count() == 10_000
    finally:
        for k in ("autoBroadcastJoinThreshold", "adaptive.coalescePartitions.enabled"):
            spark.conf.unset(f"spark.sql.{k}")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sizes[-1] < 0.3 * 40_000


def test_default_mode_has_no_shuffle(stored):
    p = plan(plan_ingest(stored, OPTS).puts)
    assert "Exchange" not in p


def test_budget_applies_as_filter(stored):
    pl = plan_ingest(stored, OPTS.with_(max_total_bytes=200_000))
    p = plan(pl.puts)
    assert pl.cutoff is not None and "Window" not in p and "Exchange" not in p


def test_domain_scan_pushes_prefix(spark, stored):
    from cellar.operators.project import put_rows

    path = scratch_path(spark, "puts")
    put_rows(stored, OPTS, 0).write.parquet(path)
    p = plan(domain_scan(spark.read.parquet(path), "example.org"))
    assert "StringStartsWith(host_rev,org.example.)" in p


def test_latest_fetches_only_winning_payload(stored):
    from cellar.operators.cells import latest_wide
    from cellar.operators.project import put_rows

    p = plan(latest_wide(put_rows(stored, OPTS, 0), OPTS))
    # payload cells are never ordered by an aggregate: only the winning version is fetched
    assert "max_by(content__raw_data" not in p and "max_by(curi__request" not in p
    assert "<=>" in p  # versions meet null-safely


def _exchanged_under_filter(p, column):
    """Whether every shuffle that carries ``column`` lies above the look-up in a filter's words (formatted plan text)."""
    parts = p.split("\n\n")
    moved = [x for x in parts if "Exchange" in x.split("\n")[0] and "hashpartitioning" in x and column in x]
    return moved, [x for x in parts if "BroadcastHashJoin" in x.split("\n")[0] and "__word" in x]


def test_only_chosen_payload_is_shuffled_without_broadcasts(spark, log1, monkeypatch):
    from cellar.operators import bloom
    from cellar.operators.cells import latest_wide
    from cellar.operators.project import put_rows

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        existing = plan_ingest(log1.existing(), OPTS, batch_id=0).puts
        opts = OPTS.with_(only_write_new=True)
        kinds = {"write": lambda: plan_ingest(log1.incoming(), opts, keys=existing, materialize=True).puts.select("row_key", "seq", F.md5("content__raw_data").alias("m")),
                 "latest": lambda: latest_wide(put_rows(log1.records, OPTS, 0), OPTS).select("row_key", "n_versions", F.md5("content__raw_data").alias("m"))}
        for kind, build in kinds.items():
            df = build()
            moved, looked_up = _exchanged_under_filter(plan(df), "raw_data")
            assert looked_up, kind
            with_filter = sorted(map(tuple, df.collect()))
            assert with_filter
            monkeypatch.setattr(bloom, "may_hold", lambda rows, columns, words: rows)
            for module in ("cellar.operators.gates", "cellar.operators.cells"):
                monkeypatch.setattr(f"{module}.may_hold", lambda rows, columns, words: rows)
            assert sorted(map(tuple, build().collect())) == with_filter, kind  # a filter that says yes to all
            monkeypatch.undo()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_filter_lets_every_partner_through_and_few_others(spark):
    from cellar.operators.bloom import key_filter, may_hold

    keys = spark.range(0, 4000, 2).select(F.concat(F.lit("k"), "id").alias("row_key")).union(spark.createDataFrame([(None,)], "row_key string"))
    rows = spark.range(20000).select(F.concat(F.lit("k"), "id").alias("row_key"), "id").union(spark.createDataFrame([(None, -1)], "row_key string, id long"))
    words = key_filter(keys, ["row_key"])
    got = {r.id for r in may_hold(rows, ["row_key"], words).collect()}
    assert {-1, *range(0, 4000, 2)} <= got and len(got) < 2050
    assert words.count() <= 2001
    assert may_hold(rows, ["row_key"], key_filter(keys.limit(0), ["row_key"])).count() == 0
