"""Write gates as set operations.

The reference decides record by record: base process gate, only-process-new
lookup, base write gate, size limit, only-write-new lookup, write, byte budget.
Here the same decisions are taken for a whole batch at once. Arrival order is
``(write_ts, seq)`` (store time in ms, then sequence), a total order, so "the
first record of a key that got written" is well defined and equals the record
a one-at-a-time loop would have written.

All status plans run on narrow control columns (key, time, size, flags). Only
the records that were chosen are joined with their payload, once, at the end.
``(row_key, write_ts, seq)`` identifies a record of an input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellar.functions.timefn import ms_floor
from cellar.operators.bloom import key_filter, may_hold
from cellar.operators.joins import salted_join
from cellar.operators.project import with_row_key
from cellar.options import UNWRITTEN_SIZE, CrawlOptions

NOT_PROCESSED = "not_processed"
UNWRITTEN = "unwritten"
EXISTING = "existing"
WRITTEN = "written"
OVER_BUDGET = "over_budget"
REJECTED = "rejected"

def _gate(c: Column | None) -> Column:
    return F.lit(True) if c is None else F.coalesce(c, F.lit(False))


def size_ok(opts: CrawlOptions) -> Column:
    """Strict '>' keeps a record out; a record of exactly the limit is written."""
    return F.coalesce(F.col("content_size"), F.lit(0)) <= F.lit(opts.max_content_bytes)


def control_columns(records: DataFrame, opts: CrawlOptions) -> DataFrame:
    """Narrow per-record columns every decision needs. ``bytes`` is what a write
    would store (the payload's length); plans that do not ask for it read no
    payload when the records carry ``content_size``."""
    flagged = with_status_flags(records, opts)
    return flagged.select(
        "seq", "row_key", "key_reject", ms_floor("write_ts").alias("write_ts"), "content_size",
        F.coalesce(F.octet_length("raw_data"), F.lit(0)).cast("bigint").alias("bytes"), "bp", "bw", "sz"
    )


def table_keys(table: DataFrame) -> DataFrame:
    """Distinct stored keys (partial aggregation dedups versions map-side)."""
    return table.select("row_key").distinct()


def new_records(records: DataFrame, keys: DataFrame) -> DataFrame:
    """Records whose key has no cell in the table (left anti join)."""
    return records.join(keys.select("row_key"), "row_key", "left_anti")


def existing_records(records: DataFrame, keys: DataFrame) -> DataFrame:
    """Records whose key is already stored (left semi join)."""
    return records.join(keys.select("row_key"), "row_key", "left_semi")


def key_facts(ctrl: DataFrame, keys: DataFrame | None) -> DataFrame:
    """One row per key of the batch: ``first_write`` (the first eligible arrival,
    the record a loop would write) and ``in_table``. Batch rows and stored keys
    go through one aggregation, which is partial before its shuffle."""
    eligible = F.col("bp") & F.col("bw") & F.col("sz")
    rows = ctrl.filter(F.col("row_key").isNotNull()).select(
        "row_key", F.when(eligible, F.struct("write_ts", "seq")).alias("w"), F.lit(True).alias("here"), F.lit(False).alias("stored"))
    if keys is not None:
        none = F.lit(None).cast(rows.schema["w"].dataType)
        rows = rows.unionByName(keys.select("row_key", none.alias("w"), F.lit(False).alias("here"), F.lit(True).alias("stored")))
    facts = rows.groupBy("row_key").agg(F.min("w").alias("first_write"), F.max("here").alias("here"), F.max("stored").alias("in_table"))
    return facts.filter("here").drop("here")


def batch_facts(flagged: DataFrame, opts: CrawlOptions) -> DataFrame:
    """One row per key of a batch with its gate flags: ``first_write`` as in ``key_facts``, and ``twice``: whether several
    records are first. Numbers of the rows tell them apart: those of one place have the same least and largest number."""
    def rows() -> list[Column]:
        w = F.struct(ms_floor("write_ts").alias("write_ts"), "seq")
        return [F.col("row_key"), F.when(F.col("bp") & F.col("bw") & F.col("sz"), w).alias("w"), F.monotonically_increasing_id().alias("at")]

    def facts() -> list[Column]:
        one, other = (F.min(F.when(F.col("w").isNotNull(), F.struct("w", n.alias("at"))))["at"] for n in (F.col("at"), -F.col("at")))
        return [F.min("w").alias("first_write"), F.coalesce(one != -other, F.lit(False)).alias("twice")]

    keyed = flagged.select(*opts.made("fact rows", rows)).filter("row_key IS NOT NULL")
    return keyed.groupBy("row_key").agg(*opts.made("facts", facts))


def decided(flagged: DataFrame, facts: DataFrame, stored: DataFrame, opts: CrawlOptions) -> DataFrame:
    """The records of a batch with their ``status``, by few ``facts`` of their keys (``batch_facts``) and those of the keys that are
    ``stored``; both are known to be few enough for every executor, so that payload stays where it is."""
    facts = F.broadcast(facts.selectExpr("row_key AS __k", "first_write AS __first"))  # sent once for both joins
    rows = flagged.join(facts, opts.made("of a fact", lambda: F.col("row_key") == F.col("__k")), "left")
    mine = stored.selectExpr("row_key AS __stored").join(facts, opts.made("of a stored fact", lambda: F.col("__stored") == F.col("__k")))
    mine = F.broadcast(mine.select("__stored", "__first").distinct().select("__stored"))
    rows = rows.join(mine, opts.made("stored", lambda: F.col("row_key") == F.col("__stored")), "left")

    def status() -> Column:
        first = F.col("__first").isNotNull() & (F.struct(ms_floor("write_ts").alias("write_ts"), "seq") > F.col("__first"))
        return status_expr(opts, F.col("__stored").isNotNull() | first)

    return rows.withColumn("status", opts.made("status", status)).drop("__k", "__first", "__stored")


def write_status(records: DataFrame, keys: DataFrame | None, opts: CrawlOptions) -> DataFrame:
    """Status of every record before the byte budget:
    rejected | not_processed | unwritten | unwritten:size | existing | written.

    ``keys``: stored put rows (any DataFrame with ``row_key``) or None for an
    empty table. Columns out: seq, row_key, write_ts, content_size, bytes, status.
    The one join is salted, so a hot URL's records meet in several tasks, and
    records without a key are spread apart.
    """
    return status_of(control_columns(records, opts), keys, opts)


def status_of(ctrl: DataFrame, keys: DataFrame | None, opts: CrawlOptions, filtered: bool = False, few: bool = False) -> DataFrame:
    """``write_status`` of control columns. ``filtered``: stored keys that no record can have are left out ahead of the
    shuffle, by a filter of the records' keys; a pass over ``ctrl``, so for one that is written. ``few``: the keys of
    ``ctrl`` are known to be few enough for every executor, so its records stay where they are."""
    if opts.only_new:
        if filtered and keys is not None:
            keys = may_hold(keys.select("row_key"), ["row_key"], key_filter(ctrl, ["row_key"]))
        facts = key_facts(ctrl, keys)
        ctrl = ctrl.join(F.broadcast(facts), "row_key", "left") if few else salted_join(ctrl, facts, "row_key", "seq")
        in_table = F.coalesce(F.col("in_table"), F.lit(False))
        after_first = F.col("first_write").isNotNull() & (F.struct("write_ts", "seq") > F.col("first_write"))
        known = in_table | after_first
    else:
        known = F.lit(False)
    status = status_expr(opts, known)
    return ctrl.select("seq", "row_key", "write_ts", "content_size", "bytes", status.alias("status"))


STATUSES = (REJECTED, NOT_PROCESSED, UNWRITTEN, UNWRITTEN_SIZE, EXISTING, WRITTEN, OVER_BUDGET)


def status_expr(opts: CrawlOptions, known: Column | None = None) -> Column:
    """The decision chain over control columns (``row_key, bp, bw, sz``).
    ``known``: key stored or written earlier in this input (only-new modes)."""
    known = F.lit(False) if known is None else known
    return (
        F.when(F.col("row_key").isNull(), F.lit(REJECTED))
        .when(~F.col("bp"), F.lit(NOT_PROCESSED))
        .when(F.lit(opts.only_process_new) & known, F.lit(NOT_PROCESSED))
        .when(~F.col("bw"), F.lit(UNWRITTEN))
        .when(~F.col("sz"), F.lit(UNWRITTEN_SIZE))
        .when(F.lit(opts.only_write_new) & known, F.lit(EXISTING))
        .otherwise(F.lit(WRITTEN))
    )


def with_status_flags(records: DataFrame, opts: CrawlOptions) -> DataFrame:
    """Records plus row_key, key_reject and the gate flags bp, bw, sz. A record
    that may lack its size is measured, so that no limit is passed unseen."""
    if records.schema["content_size"].nullable:
        measured = F.coalesce("content_size", F.octet_length("raw_data").cast("bigint"), F.lit(0).cast("bigint"))
        records = records.withColumn("content_size", measured)
    return with_row_key(records, opts).withColumns(opts.made("flags", lambda: {
        "bp": _gate(opts.base_process_gate), "bw": _gate(opts.base_write_gate), "sz": size_ok(opts)}))


def annotate(records: DataFrame, opts: CrawlOptions, statuses: DataFrame | None = None) -> DataFrame:
    """Append the size annotation to the records the size gate kept out.

    The decision is an expression over the record itself. Only with
    ``only_process_new`` does it depend on other records; then ``statuses`` (of
    the same records) says which were not processed at all.
    """
    flagged = with_status_flags(records, opts)
    gated = status_expr(opts.with_(only_process_new=False, only_write_new=False)) == UNWRITTEN_SIZE
    if opts.only_process_new:
        if statuses is None:
            raise ValueError("only_process_new needs the statuses of the records")
        dropped = statuses.filter(F.col("status") == UNWRITTEN_SIZE)
        flagged = _mark(flagged, dropped, "__gated")
        gated = F.col("__gated")
    hit = F.array_append(F.coalesce("annotations", F.array().cast("array<string>")), F.lit(UNWRITTEN_SIZE))
    out = flagged.withColumn("annotations", F.when(gated, hit).otherwise(F.col("annotations")))
    return out.select(*records.columns)


def _same_record(keyed: DataFrame, chosen: DataFrame, once: bool = True) -> tuple[DataFrame, Column]:
    """``chosen`` renamed, each ``once``, and the null-safe condition that a record is one of it."""
    c = chosen.select(F.col("row_key").alias("__k"), F.col("write_ts").alias("__t"), F.col("seq").alias("__s"))
    return c.distinct() if once else c, ((F.col("row_key") == F.col("__k")) & ms_floor("write_ts").eqNullSafe(F.col("__t")) & F.col("seq").eqNullSafe(F.col("__s")))


def _mark(keyed: DataFrame, chosen: DataFrame, name: str) -> DataFrame:
    c, same = _same_record(keyed, chosen)
    return keyed.join(c.withColumn(name, F.lit(True)), same, "left").withColumn(name, F.coalesce(name, F.lit(False))).drop("__k", "__t", "__s")


def pick(records: DataFrame, chosen: DataFrame, opts: CrawlOptions, filtered: bool = False, few: bool = False) -> DataFrame:
    """The records, with payload, that ``chosen`` (row_key, write_ts in ms, seq) names.

    The join is on all three, so the records of one hot URL are dealt apart. How
    ``chosen`` travels is left to the planner's byte sizes. ``filtered``: payload that is not chosen
    stays out of the join's shuffle, by a filter of ``chosen`` (a pass over it, so for one that is written).
    ``few``: ``chosen`` is known to be small enough for every executor, so payload stays where it is.
    """
    keyed = with_row_key(records, opts).filter(F.col("row_key").isNotNull())
    if filtered:
        named = key_filter(chosen.select("row_key", F.col("write_ts").alias("__ms"), "seq"), ["row_key", "__ms", "seq"])
        keyed = may_hold(keyed.withColumn("__ms", ms_floor("write_ts")), ["row_key", "__ms", "seq"], named).drop("__ms")
    if few:
        c, same = _same_record(keyed, chosen, once=False)
        return keyed.join(F.broadcast(c), same, "left_semi")
    c, same = _same_record(keyed, chosen)
    return keyed.join(c, same, "left_semi")


def writable(records: DataFrame, keys: DataFrame | None, opts: CrawlOptions) -> DataFrame:
    """Records to write, with payload, before the byte budget.

    Default mode: a filter, no shuffle. Only-new modes: statuses first, on
    narrow columns, then the payload of the written records.
    """
    if opts.only_new:
        return pick(records, write_status(records, keys, opts).filter(F.col("status") == WRITTEN), opts)
    keyed = with_row_key(records, opts).filter(F.col("row_key").isNotNull())
    return keyed.filter(_gate(opts.base_process_gate) & _gate(opts.base_write_gate) & size_ok(opts))
