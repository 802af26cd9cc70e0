"""Byte budget: stop writing once the written bytes pass a limit (0 = none).

A record is written while the bytes written before it are <= limit; the write
that passes the limit is the last one. Sizes are >= 0, so the kept rows are a
prefix of the arrival order and the whole operator reduces to one cutoff key
``(write_ts, seq, row_key)``, applied as a plain filter (no payload shuffle). The
row key tells records of one instant and number apart.

The cutoff is found without a single-partition window over all rows:
1. range-partition the narrow (ts, seq, bytes) rows; Spark samples the
   composite key, so partitions are balanced even if one instant or one host
   holds a third of the rows;
2. write them with their partition number (fixes membership; deleted at the end);
3. per-partition byte totals: at most ``spark.sql.shuffle.partitions`` rows;
4. offsets over that small table find the one partition where the running
   total passes the limit;
5. while that partition is large it is split the same way again, into more parts
   if one of them took all; a running sum inside the last, small one gives the
   cutoff row. Rows that share one key cannot be split and need not be: their
   key is the cutoff.

A missing time sorts before all others, here and in the filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellar.runtime import delete_path, write_stage

# A crossing partition of more rows is split again before the running sum.
WINDOW_ROWS = 200_000


def cutoff_key(
    written: DataFrame,
    limit: int,
    already: int = 0,
    ts: str = "write_ts",
    seq: str = "seq",
    size: str = "bytes",
    partitions: int | None = None,
    key: str | None = None,
):
    """(ts, seq, key) of the last row written, or None if the budget is never passed.

    ``key``: a column that orders rows of one (ts, seq); without it they pass or fall together.

    ``already``: bytes written before this input (streaming batches).
    Returns the string "none" if nothing may be written at all.
    """
    if limit <= 0:
        return None
    if already > limit:
        return "none"
    spark = written.sparkSession
    n = max(2, partitions or int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = written.select(F.col(ts).alias("ts"), F.col(seq).alias("seq"), (F.col(key) if key else F.lit("")).alias("key"),
                          F.col(size).cast("bigint").alias("b"))
    order = ["ts", "seq", "key"]
    start, paths = already, []
    try:
        while True:
            ranged, path = write_stage(rows.repartitionByRange(n, *order).withColumn("pid", F.spark_partition_id()), "budget")
            paths.append(path)
            at = F.struct(*order)
            totals = ranged.groupBy("pid").agg(F.sum("b").alias("bytes"), F.count(F.lit(1)).alias("n"), F.min(at).alias("lo"),
                                               F.max(at).alias("hi")).orderBy("pid").collect()  # n rows
            whole = sum(t["n"] for t in totals)
            for t in totals:
                if start + (t["bytes"] or 0) > limit:
                    break
                start += t["bytes"] or 0
            else:
                return None
            if t["lo"] == t["hi"]:
                return tuple(t["lo"])
            rows = ranged.filter(F.col("pid") == t["pid"]).drop("pid")
            if t["n"] <= WINDOW_ROWS:
                break
            n = n * 4 if t["n"] == whole else n
        w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        run = rows.withColumn("run", F.lit(start) + F.sum("b").over(w))
        return tuple(run.filter(F.col("run") > F.lit(limit)).orderBy(*order).select(*order).first())
    finally:
        for p in paths:
            delete_path(spark, p)


def ntz_literal(value) -> Column:
    """A TIMESTAMP_NTZ literal from a naive datetime, via its text form, so no
    session or process time zone takes part."""
    return F.lit(value.isoformat(sep=" ", timespec="microseconds")).cast("timestamp_ntz")


def within_cutoff(cutoff, ts: str = "write_ts", seq: str = "seq", key: str | None = None) -> Column:
    """Predicate for rows at or before the cutoff in arrival order (missing values first); ``key`` as in ``cutoff_key``."""
    if cutoff is None:
        return F.lit(True)
    if cutoff == "none":
        return F.lit(False)
    c_ts, c_seq, c_key = cutoff
    last = F.coalesce(F.col(key) <= F.lit(c_key), F.lit(True)) if key and c_key is not None else F.lit(True)
    c_seq = F.lit(c_seq).cast("bigint")
    in_time = F.when(F.col(seq).isNull(), F.lit(True) if not key else F.when(c_seq.isNull(), last).otherwise(F.lit(True))).when(
        c_seq.isNull(), F.lit(False)).otherwise((F.col(seq) < c_seq) | ((F.col(seq) == c_seq) & last))
    if c_ts is None:
        return F.col(ts).isNull() & in_time
    t = ntz_literal(c_ts)
    return F.col(ts).isNull() | F.coalesce((F.col(ts) < t) | ((F.col(ts) == t) & in_time), F.lit(False))


def byte_budget(written: DataFrame, limit: int, already: int = 0, ts: str = "write_ts",
                seq: str = "seq", size: str = "bytes", key: str | None = None) -> DataFrame:
    """Rows of ``written`` that the budget lets through."""
    cut = cutoff_key(written, limit, already, ts, seq, size, key=key)
    return written.filter(within_cutoff(cut, ts, seq, key))
