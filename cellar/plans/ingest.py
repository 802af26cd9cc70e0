"""Batch ingest: records -> decisions -> put rows -> crawl table.

Default mode (no existence check, no budget): one job. Statuses are per-row
expressions, counted with ``observe`` while the filtered put rows are written.

Only-new modes or a byte budget, the same way at every size:
  control columns (key, ms time, size, gate flags) -> statuses (one narrow join),
      written once to the shared folder and deleted after the batch
  budget cutoff over the written control rows      -> one (ts, seq) scalar
  records joined to the written (row_key, write_ts, seq) -> put rows -> write
Payload moves, if the planner needs it to, only in that last join.

Micro-batches of a stream in an only-new mode without a budget take the same decisions
with few jobs (``plan_micro_batch``): what a job costs apart from its rows is paid once a batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cellar.operators import budget, gates
from cellar.operators.metrics import status_counts
from cellar.operators.project import put_rows, with_row_key
from cellar.options import CrawlOptions
from cellar.runtime import beside, configured, delete_path, write_stage
from cellar.sources.crawl_log import normalize_records
from cellar.sources.table import CrawlTable


# Keys of a micro-batch of more bytes are not broadcast; bytes counted for a key beside its text.
FEW_BYTES = 8 << 20
KEY_BYTES = 64


@dataclass
class IngestPlan:
    statuses: DataFrame  # seq, row_key, write_ts, content_size, bytes, status (of a micro-batch: the records with their status)
    puts: DataFrame  # put rows to store
    cutoff: object  # budget cutoff (ts, seq, row_key), "none", or None
    counts: list | None = None  # (status, records, bytes) when materialised
    stages: list[str] = field(default_factory=list)  # paths to delete once nothing reads the plan
    stored: Observation | None = None  # payload bytes of the put rows, known after their write
    seen: Observation | None = None  # records and bytes of each status, known after the write
    held: list[DataFrame] = field(default_factory=list)  # cached frames to release once nothing reads the plan
    few: Callable[[], bool] | None = None  # whether the plan holds, known after its first pass
    instead: Callable[[], IngestPlan] | None = None  # the plan if it does not


def plan_ingest(
    records: DataFrame,
    opts: CrawlOptions,
    keys: DataFrame | None = None,
    batch_id: int | None = None,
    already_bytes: int = 0,
    materialize: bool = False,
) -> IngestPlan:
    """Decide every record and build the put rows, without writing.

    ``keys``: stored rows (anything with ``row_key``) the only-new modes check
    against; None means an empty table. ``already_bytes``: bytes written
    before this input, for the byte budget. ``materialize``: write the narrow
    statuses once, so the budget, the metrics and the puts all reuse them
    instead of repeating the existence check.
    """
    records = prepare_records(records, opts)
    stages: list[str] = []
    # the budget reads the join-based statuses a second time: write them once
    measured = opts.max_total_bytes > 0  # else the payload is measured when it is written
    if materialize or (opts.only_new and measured):
        ctrl = gates.control_columns(records, opts)
        ctrl = ctrl if measured else ctrl.withColumn("bytes", F.col("content_size"))
        if opts.only_new and keys is not None:
            ctrl, path = write_stage(ctrl, "control")
            stages.append(path)
        statuses, path = write_stage(gates.status_of(ctrl, keys, opts, filtered=True), "statuses")
        stages.append(path)
    else:
        statuses = gates.write_status(records, keys, opts)
    cutoff = None
    if opts.max_total_bytes > 0:
        written = statuses.filter(F.col("status") == gates.WRITTEN)
        cutoff = budget.cutoff_key(written, opts.max_total_bytes, already_bytes, key="row_key")
        statuses = statuses.withColumn("status", _after_budget(F.col("status"), cutoff))
    counts, stored = None, None
    if stages:
        counts = [(r["status"], int(r["records"]), int(r["bytes"])) for r in status_counts(statuses).collect()]  # <= 7 rows
    chosen = statuses.filter(F.col("status") == gates.WRITTEN)
    if opts.only_new:
        picked = gates.pick(records, chosen, opts, filtered=bool(stages))
        twice = True  # a record delivered twice in one input is one write; whether there are such is known from written statuses
        if stages:
            n = sum(c for st, c, _ in counts if st == gates.WRITTEN)
            twice = chosen.select("row_key").distinct().count() < n
        picked = picked.dropDuplicates(["row_key"]) if twice else picked
        if stages and not measured:
            stored = Observation(f"cellar_stored_{uuid.uuid4().hex[:12]}")
            picked = picked.observe(stored, F.sum(F.coalesce(F.octet_length("raw_data"), F.lit(0))).alias("bytes"))
        puts = put_rows(picked, opts, batch_id)
    else:
        puts = put_rows(gates.writable(records, None, opts), opts, batch_id)
        puts = puts.filter(budget.within_cutoff(cutoff, key="row_key")) if cutoff is not None else puts
    return IngestPlan(statuses, puts, cutoff, counts, stages, stored)


def plan_micro_batch(records: DataFrame, opts: CrawlOptions, keys: Callable[[], DataFrame], batch_id: int | None = None) -> IngestPlan:
    """``plan_ingest`` for a micro-batch in an only-new mode without a byte budget; ``keys()`` gives the stored rows.

    One narrow pass makes the facts of the batch's keys, which stay in the executors' cache for the time of the batch, and
    counts their bytes. Few of them are broadcast: of the stored keys only those of the batch are shuffled, and the
    pass that writes the payload decides each record as it comes and counts the statuses on its way, so it is the
    only other one. That plan is made while the first pass runs, and holds if ``few`` says so. More keys, or a
    record delivered twice, which is one write, go by way of kept statuses (``instead``).
    """
    flagged = gates.with_status_flags(prepare_records(records, opts), opts)
    with configured(records.sparkSession, spark__sql__optimizer__canChangeCachedPlanOutputPartitioning="true"):
        facts = gates.batch_facts(flagged, opts).persist()  # in as few parts as they fill
    sized = opts.made("sized", lambda: [F.coalesce(F.sum(F.octet_length("row_key") + F.lit(KEY_BYTES)), F.lit(0)).alias("bytes"),
                                        F.max("twice").alias("twice")])
    told = beside(records.sparkSession, facts.agg(*sized).first)
    stored = keys()
    decided = gates.decided(flagged, facts, stored, opts)
    seen = Observation(f"cellar_seen_{uuid.uuid4().hex[:12]}")
    observed = decided.observe(seen, *opts.made("seen", lambda: _status_metrics("status", _kept_bytes(), _possible(opts))))
    puts = put_rows(observed.filter(f"status = '{gates.WRITTEN}'"), opts, batch_id)
    return IngestPlan(decided, puts, None, seen=seen, held=[facts], few=lambda: told.result()["bytes"] <= FEW_BYTES and not told.result()["twice"],
                      instead=lambda: _plan_many(flagged, opts, stored, batch_id, told.result()["bytes"] <= FEW_BYTES))


def _kept_bytes() -> Column:
    """Payload bytes of a record that is written, else its size."""
    return F.when(F.col("status") == F.lit(gates.WRITTEN), F.coalesce(F.octet_length("raw_data"), F.lit(0))).otherwise(F.col("content_size"))


def _plan_many(records: DataFrame, opts: CrawlOptions, keys: DataFrame | None, batch_id: int | None, few: bool) -> IngestPlan:
    """``plan_micro_batch`` by statuses that stay in the executors' cache (beyond its memory, on their disks) for the time of
    the batch. ``few`` keys are broadcast; more go through hash filters as in ``plan_ingest``."""
    ctrl = gates.control_columns(records, opts).withColumn("bytes", F.col("content_size")).persist()
    if few and keys is not None:
        keys = keys.join(F.broadcast(ctrl.select("row_key")), "row_key", "left_semi")
    statuses = gates.status_of(ctrl, keys, opts, filtered=not few, few=few).persist()
    by_key = statuses.groupBy("status", F.when(F.col("status") == gates.WRITTEN, F.col("row_key")).alias("row_key")).agg(
        F.count(F.lit(1)).alias("records"), F.sum("bytes").alias("bytes"))
    found = by_key.groupBy("status").agg(
        F.sum("records").alias("records"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.max("records").alias("most")).collect()  # <= 7 rows
    counts = [(r["status"], int(r["records"]), int(r["bytes"])) for r in found]
    chosen = statuses.filter(F.col("status") == gates.WRITTEN)
    picked = gates.pick(records, chosen, opts, filtered=not few, few=few)
    if any(r["most"] > 1 for r in found if r["status"] == gates.WRITTEN):  # a record delivered twice is one write
        picked = picked.dropDuplicates(["row_key"])
    stored = Observation(f"cellar_stored_{uuid.uuid4().hex[:12]}")
    picked = picked.observe(stored, F.sum(F.coalesce(F.octet_length("raw_data"), F.lit(0))).alias("bytes"))
    return IngestPlan(statuses, put_rows(picked, opts, batch_id), None, counts, stored=stored, held=[ctrl, statuses])


def _after_budget(status: Column, cutoff) -> Column:
    """Records after the cutoff are over budget; a URL that cannot be keyed is rejected wherever it falls."""
    return F.when((status != gates.REJECTED) & ~budget.within_cutoff(cutoff, key="row_key"), F.lit(gates.OVER_BUDGET)).otherwise(status)


def prepare_records(records: DataFrame, opts: CrawlOptions) -> DataFrame:
    """Full record contract; ips resolved from ``opts.hosts`` where missing."""
    records = normalize_records(records)
    if opts.hosts is not None:
        from cellar.operators.hooks import resolve_ip

        records = resolve_ip(records, opts.hosts).drop("host", "ip_status")
    return records


def ingest(
    records: DataFrame,
    table: CrawlTable,
    batch_id: int,
    opts: CrawlOptions | None = None,
    already_bytes: int | None = None,
    micro: bool = False,
) -> DataFrame:
    """Write one batch into ``table`` and return its status counts.

    Retrying the same ``batch_id`` with the same input gives the same table:
    the existence check ignores the batch's own rows and the write replaces
    them. Side outputs are computed from the stored rows of the batch. ``micro``: one
    of many small batches; their keys and zones are left to ``CrawlTable.index``.
    """
    opts = opts or table.opts
    table.ensure()
    if not opts.only_new and opts.max_total_bytes <= 0:
        counts = _ingest_one_pass(records, table, batch_id, opts, micro)
    else:
        counts = _ingest_decided(records, table, batch_id, opts, already_bytes, micro)
    for fn, target in opts.side_outputs.values():
        rows = fn(table.partition(batch_id))
        rows.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("batch_id").parquet(target)
    if any(st == gates.REJECTED and n > 0 for st, n, _ in counts):
        write_rejects(table, records, opts, batch_id)
    rows = ", ".join(f"('{st}', {n}L, {b}L, {int(batch_id)}L)" for st, n, b in counts) or "(NULL, NULL, NULL, NULL)"
    out = table.spark.sql(f"SELECT CAST(status AS STRING) AS status, CAST(records AS BIGINT) AS records, CAST(bytes AS BIGINT) AS bytes, "
                          f"CAST(batch_id AS BIGINT) AS batch_id FROM VALUES {rows} AS t(status, records, bytes, batch_id) WHERE status IS NOT NULL")
    if micro:
        table.write_counts(counts, batch_id)
    else:
        record_metrics(table, out, batch_id)
    return out


def _ingest_decided(records, table: CrawlTable, batch_id: int, opts: CrawlOptions, already_bytes: int | None, micro: bool = False) -> list:
    """Statuses first, then the payload of what is written; returns (status, records, bytes)."""
    def keys() -> DataFrame | None:
        return table.keys(exclude_batch=batch_id) if opts.only_new else None

    if already_bytes is None:
        already_bytes = written_bytes_before(table, batch_id) if opts.max_total_bytes > 0 else 0
    if micro and opts.max_total_bytes <= 0:
        plan = plan_micro_batch(records, opts, keys, batch_id)
    else:
        plan = plan_ingest(records, opts, keys(), batch_id, already_bytes, materialize=True)
    plans = [plan]
    try:
        rows = table.shaped(plan.puts)
        if plan.few is not None and not plan.few():
            plan = plan.instead()
            plans.append(plan)
            rows = table.shaped(plan.puts)
        table.write_rows(rows, batch_id, indexed=not micro)
    finally:
        for p in plans:
            for df in p.held:
                df.unpersist()
            for path in p.stages:
                delete_path(table.spark, path)
    if plan.seen is not None:
        return _parse_metrics(plan.seen.get)
    if plan.stored is None:
        return plan.counts
    size = int(plan.stored.get["bytes"] or 0)
    return [(st, n, size if st == gates.WRITTEN else b) for st, n, b in plan.counts]


def _ingest_one_pass(records: DataFrame, table: CrawlTable, batch_id: int, opts: CrawlOptions, micro: bool = False) -> list:
    """Default mode (no existence check, no budget): every status is a per-row
    expression, so the write job itself computes the status counts through
    ``observe``; the input is read once. Rejects are collected only when the
    observed count says there are any."""
    flagged = gates.with_status_flags(prepare_records(records, opts), opts)
    flagged = flagged.withColumn("__status", gates.status_expr(opts))
    obs = Observation(f"cellar_ingest_{uuid.uuid4().hex[:12]}")
    observed = flagged.observe(obs, *_status_metrics("__status"))
    puts = put_rows(observed.filter(F.col("__status") == F.lit(gates.WRITTEN)), opts, batch_id)
    table.write_batch(puts, batch_id, indexed=not micro)
    return _parse_metrics(obs.get)


def _possible(opts: CrawlOptions) -> list[str]:
    """The statuses that a record may have without a byte budget."""
    never = {gates.OVER_BUDGET}
    never |= {gates.NOT_PROCESSED} if opts.base_process_gate is None and not opts.only_process_new else set()
    never |= {gates.UNWRITTEN} if opts.base_write_gate is None else set()
    return [st for st in gates.STATUSES if st not in never]


def _status_metrics(status: str, size: Column | None = None, statuses: list[str] | None = None) -> list:
    """Per-status record and byte counts as ``observe`` aggregates; of the payload's bytes unless ``size`` is given."""
    size = F.coalesce(F.octet_length("raw_data"), F.lit(0)) if size is None else size
    out = []
    for st in gates.STATUSES if statuses is None else statuses:
        hit = F.col(status) == F.lit(st)
        out.append(F.sum(F.when(hit, 1).otherwise(0)).cast("bigint").alias(f"n|{st}"))
        out.append(F.sum(F.when(hit, size).otherwise(0)).cast("bigint").alias(f"b|{st}"))
    return out


def _parse_metrics(got: dict) -> list[tuple[str, int, int]]:
    """(status, records, bytes) for every status that occurred."""
    return [(st, int(got[f"n|{st}"] or 0), int(got[f"b|{st}"] or 0))
            for st in gates.STATUSES if (got.get(f"n|{st}") or 0) > 0]


def write_rejects(table: CrawlTable, records: DataFrame, opts: CrawlOptions, batch_id: int) -> None:
    """Records whose URL cannot become a row key, with the reason."""
    bad = (
        with_row_key(prepare_records(records, opts), opts)
        .filter(F.col("key_reject").isNotNull())
        .select("seq", "url", F.col("key_reject").alias("reason"))
    )
    table.write_rejects(bad, batch_id)


def record_metrics(table: CrawlTable, counts: DataFrame, batch_id: int) -> None:
    """Per-batch status counts, stored next to the table (one partition per batch)."""
    table.write_metrics(counts, batch_id)


def written_bytes_before(table: CrawlTable, batch_id: int) -> int:
    """Bytes written by batches before ``batch_id`` (from the metrics rows)."""
    table.ensure()
    row = (
        table.metrics()
        .filter((F.col("batch_id") < F.lit(int(batch_id))) & (F.col("status") == gates.WRITTEN))
        .agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("b"))
        .first()
    )
    return int(row["b"])
