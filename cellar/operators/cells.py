"""Cells view (put row -> sparse long cells) and the per-cell latest reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellar.operators.bloom import key_filter, may_hold
from cellar.operators.project import CELL_KINDS, hook_columns, to_bytes
from cellar.options import CrawlOptions


def _clock_col(clock: str) -> str:
    return "fetch_ts" if clock == "fetch" else "write_ts"


def _cell_sources(puts: DataFrame, opts: CrawlOptions) -> list[tuple[str, str, str, str, str]]:
    """(family, qualifier, stored column, clock column, kind) for every cell column."""
    types = dict(puts.dtypes)
    out = []
    for fld, fam, qual, stored, clock in opts.cell_specs():
        if stored in types:
            kind = "binary" if types[stored] == "binary" else CELL_KINDS[fld]
            out.append((fam, qual, stored, _clock_col(clock), kind))
    for c in hook_columns(puts, opts):
        fam, qual = c.split("__", 1)
        kind = {"string": "string", "boolean": "boolean", "binary": "binary"}.get(types[c], "string")
        out.append((fam, qual, c, "write_ts", kind))
    return out


def _value_bytes(col: str, kind: str, dtype: str) -> Column:
    c = F.col(col)
    if kind in ("string", "boolean", "binary") and dtype in ("string", "boolean", "binary"):
        return to_bytes(c, kind if dtype != "binary" else "binary")
    return F.encode(c.cast("string"), "UTF-8")


def cells(puts: DataFrame, opts: CrawlOptions) -> DataFrame:
    """One row per present cell: row_key, seq, family, qualifier, ts, value (BINARY)."""
    types = dict(puts.dtypes)
    structs = [
        F.struct(
            F.lit(fam).alias("family"),
            F.lit(qual).alias("qualifier"),
            F.col(clock).alias("ts"),
            _value_bytes(col, kind, types[col]).alias("value"),
        )
        for fam, qual, col, clock, kind in _cell_sources(puts, opts)
    ]
    # explode + a plain Filter node (no higher-order lambda), so it stays in codegen
    return (
        puts.select("row_key", "seq", F.explode(F.array(*structs)).alias("c"))
        .select("row_key", "seq", "c.family", "c.qualifier", "c.ts", "c.value")
        .filter(F.col("value").isNotNull())
    )


def _with_batch(puts: DataFrame) -> DataFrame:
    return puts if "batch_id" in puts.columns else puts.withColumn("batch_id", F.lit(None).cast("bigint"))


def latest_wide(puts: DataFrame, opts: CrawlOptions, with_versions: bool = False) -> DataFrame:
    """One row per key with the newest non-NULL value of each cell column.

    A version is (clock, seq, batch_id), newest first in that order, so a second
    crawl that counts ``seq`` from the start again still wins by its time, and
    at the same time by its batch. Each column is resolved with its own clock
    and ignores writes that did not carry the cell, so a later write without
    ``via`` keeps the stored ``via``.

    Small cells are resolved by ``max_by`` on narrow rows. BINARY cells (request,
    raw_data, binary hook cells) only get their winning version picked there;
    the bytes are fetched for the winners alone, by a null-safe join on the
    version's own (row_key, write_ts, seq, batch_id), which also deals the
    versions of a hot key apart. ``raw_data`` is always written, so the narrow
    pass never reads it. ``with_versions`` adds ``<column>__ver`` =
    struct(ts, seq, batch_id, write_ts) of each cell's winning version.
    """
    puts = _with_batch(puts)
    types = dict(puts.dtypes)
    sources = _cell_sources(puts, opts)
    small = [(c, clock) for _f, _q, c, clock, _k in sources if types[c] != "binary"]
    big = [(c, clock) for _f, _q, c, clock, _k in sources if types[c] == "binary"]
    always = {opts.stored("raw_data")} if opts.serializer is None else set()

    def ver(present, clock):
        return F.when(present, F.struct(F.col(clock).alias("ts"), "seq", "batch_id", "write_ts"))

    aggs = []
    for col, clock in small:
        v = ver(F.col(col).isNotNull(), clock)
        aggs.append(F.max_by(F.col(col), v).alias(col))
        aggs.append(F.max(v).alias(f"{col}__ver"))
    for col, clock in big:
        aggs.append(F.max(ver(F.col(f"__has_{col}"), clock)).alias(f"{col}__ver"))
    aggs += [F.max("fetch_ts").alias("fetch_ts"), F.max("write_ts").alias("write_ts"), F.count(F.lit(1)).alias("n_versions")]
    narrow = puts.select(
        "row_key", "seq", "batch_id", "fetch_ts", "write_ts", *[c for c, _ in small],
        *[(F.lit(True) if c in always else F.col(c).isNotNull()).alias(f"__has_{c}") for c, _ in big],
    )
    agg = narrow.groupBy("row_key").agg(*aggs)
    vers = [f"{c}__ver" for c, _ in small + big] if with_versions else []
    order = ["row_key", *[c for c, _ in small], *[c for c, _ in big], "fetch_ts", "write_ts", "n_versions", *vers]
    if not big:
        return agg.select(*order)
    picks = agg.select("row_key", F.explode(F.array(*[
        F.struct(F.lit(c).alias("cell"), F.col(f"{c}__ver.write_ts").alias("t"), F.col(f"{c}__ver.seq").alias("s"),
                 F.col(f"{c}__ver.batch_id").alias("b"), F.col(f"{c}__ver").isNotNull().alias("some")) for c, _ in big])).alias("p"))
    picks = picks.filter("p.some").groupBy(F.col("row_key").alias("__k"), F.col("p.t").alias("__t"), F.col("p.s").alias("__s"),
                                           F.col("p.b").alias("__b")).agg(F.collect_set("p.cell").alias("__cells"))
    same = ((F.col("row_key") == F.col("__k")) & F.col("write_ts").eqNullSafe(F.col("__t")) & F.col("seq").eqNullSafe(F.col("__s"))
            & F.col("batch_id").eqNullSafe(F.col("__b")))
    version = ["row_key", "write_ts", "seq", "batch_id"]
    named = key_filter(picks.select(*[F.col(a).alias(b) for a, b in zip(("__k", "__t", "__s", "__b"), version)]), version)
    # versions that did not win stay out of the join's shuffle
    won = may_hold(puts.select(*version, *[c for c, _ in big]), version, named).join(picks, same)
    # one row per winner; a record delivered twice is one version, of which the greater bytes are shown
    payload = won.groupBy("row_key").agg(*[F.max(F.when(F.array_contains("__cells", c), F.col(c))).alias(c) for c, _ in big])
    return agg.join(payload, "row_key", "left").select(*order)


def latest_cells(puts: DataFrame, opts: CrawlOptions) -> DataFrame:
    """What a get returns, as cells: row_key, family, qualifier, ts, seq, value of
    the newest version of every present cell."""
    wide = latest_wide(puts, opts, with_versions=True)
    types = dict(puts.dtypes)
    structs = [
        F.struct(
            F.lit(fam).alias("family"),
            F.lit(qual).alias("qualifier"),
            F.col(f"{col}__ver.ts").alias("ts"),
            F.col(f"{col}__ver.seq").alias("seq"),
            _value_bytes(col, kind, types[col]).alias("value"),
        )
        for fam, qual, col, _clock, kind in _cell_sources(puts, opts)
    ]
    return (
        wide.select("row_key", F.explode(F.array(*structs)).alias("c"))
        .select("row_key", "c.family", "c.qualifier", "c.ts", "c.seq", "c.value")
        .filter(F.col("value").isNotNull())
    )
