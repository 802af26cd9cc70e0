from pyspark.sql import Window
from pyspark.sql import functions as F

from cellar.operators.budget import byte_budget, cutoff_key
from helpers import ts


def brute(rows, limit, already=0):
    kept, total = [], already
    for t, s, b in sorted(rows):
        if total > limit:
            break
        kept.append(s)
        total += b
    return kept


def _df(spark, rows):
    return spark.createDataFrame(rows, "write_ts timestamp_ntz, seq bigint, bytes bigint")


def test_budget_vs_brute_force(spark):
    rows = [(ts((i * 7919) % 1000), i, 100 + (i * 37) % 900) for i in range(3000)]
    df = _df(spark, rows)
    for limit in (1, 500, 100_000, 10**6, 10**9):
        got = sorted(r.seq for r in byte_budget(df, limit).collect())
        assert got == sorted(brute(rows, limit)), limit


def test_budget_hot_instant(spark):
    """A third of the rows at one instant: the range split still balances on seq."""
    rows = [(ts(5), i, 10) for i in range(3000)] + [(ts(i % 50), 10_000 + i, 10) for i in range(6000)]
    df = _df(spark, rows)
    got = sorted(r.seq for r in byte_budget(df, 40_000).collect())
    assert got == sorted(brute(rows, 40_000))
    ranged = df.repartitionByRange(8, "write_ts", "seq").groupBy(F.spark_partition_id().alias("p")).count()
    assert max(r["count"] for r in ranged.collect()) < 0.25 * len(rows)


def test_budget_unlimited_and_spent(spark):
    rows = [(ts(i), i, 10) for i in range(20)]
    df = _df(spark, rows)
    assert byte_budget(df, 0).count() == 20
    assert cutoff_key(df, 1000) is None
    assert byte_budget(df, 50, already=60).count() == 0
    assert sorted(r.seq for r in byte_budget(df, 50, already=20).collect()) == brute(rows, 50, 20)


def test_budget_splits_a_large_crossing_partition_again(spark, monkeypatch):
    from cellar.operators import budget

    monkeypatch.setattr(budget, "WINDOW_ROWS", 20)
    rows = [(ts((i * 7919) % 1000), i, 100) for i in range(2000)]
    got = sorted(r.seq for r in byte_budget(_df(spark, rows), 77_777).collect())
    assert got == sorted(brute(rows, 77_777))


def test_missing_times_come_first(spark):
    rows = [(None, 1, 10), (None, 2, 10), (ts(1), 3, 10), (ts(2), 4, 10)]
    df = _df(spark, rows)
    assert sorted(r.seq for r in byte_budget(df, 15).collect()) == [1, 2]
    assert sorted(r.seq for r in byte_budget(df, 25).collect()) == [1, 2, 3]


def test_ties_are_told_apart_by_row_key_and_never_share_a_window(spark, monkeypatch):
    from cellar.operators import budget

    monkeypatch.setattr(budget, "WINDOW_ROWS", 5)
    rows = [(ts(1), 1, 10, f"k{i:03d}") for i in range(60)] + [(ts(0), i, 1, "a") for i in range(30)]
    df = spark.createDataFrame(rows, "write_ts timestamp_ntz, seq bigint, bytes bigint, row_key string")
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        for limit in (5, 29, 30, 45, 333, 10_000):
            kept, total = [], 0
            for r in sorted(rows):
                if total > limit:
                    break
                kept.append(r)
                total += r[2]
            assert sorted(map(tuple, byte_budget(df, limit, key="row_key").collect())) == kept, (n, limit)
    same = spark.createDataFrame([(ts(1), 1, 10, "k")] * 50, df.schema)  # one key throughout: they pass or fall together
    assert cutoff_key(same, 15, key="row_key") == (ts(1), 1, "k")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
