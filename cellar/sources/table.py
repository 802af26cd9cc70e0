"""The crawl table: put rows in Parquet files, made visible by snapshots.

Create-if-missing, schema evolution by column addition (case-insensitive
family check), idempotent batch writes (a batch's rows take the place of its
older ones), scans of the newest or an older version, key lookups, domain scans
and key-ordered compaction that runs beside ingests.

Files never change and are never deleted while a kept version names them
(``cellar.sources.snapshots``), so no step of a write or compaction that fails
hides or loses a row. The catalog entry holds the columns and the location;
rows are read through ``scan`` and its kin. A catalog that does not know the
table (a new session) takes the columns from the newest version.
"""

from __future__ import annotations

import datetime as dt
import io
import json
import math
import re
import uuid
from dataclasses import replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellar.functions.keys import host_under_domain
from cellar.operators.bloom import key_filter, may_hold
from cellar.operators.cells import latest_wide
from cellar.options import CrawlOptions
from cellar.runtime import delete_path, folder_names, matching_paths, path_bytes, path_exists, write_bytes
from cellar.sources.snapshots import Run, Snapshot, SnapshotLog, merged, replaced
from cellar.sources.zones import Wanted, file_zones, z_ordered

_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?$")

FIXED_FIELDS = [
    T.StructField("row_key", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("fetch_ts", T.TimestampNTZType()),
    T.StructField("write_ts", T.TimestampNTZType()),
    T.StructField("host_rev", T.StringType()),
]
CELL_TYPES = {
    "url": T.StringType(),
    "ip": T.StringType(),
    "is_seed": T.BooleanType(),
    "path_from_seed": T.StringType(),
    "via": T.StringType(),
    "request": T.BinaryType(),
    "raw_data": T.BinaryType(),
}


# Side tables kept next to the crawl table (one partition per batch).
METRICS_DDL = "status STRING, records BIGINT, bytes BIGINT"
REJECTS_DDL = "seq BIGINT, url STRING, reason STRING"
_ZONES_DDL = ("file STRING, rows BIGINT, row_key_min STRING, row_key_max STRING, host_rev_min STRING, host_rev_max STRING, "
              "write_ts_min TIMESTAMP_NTZ, write_ts_max TIMESTAMP_NTZ, run STRING")
_KEYS_DDL = "row_key STRING, batch_id BIGINT"
# Bytes of a compacted file, of its values before compression (what a task sorts), and how many times larger runs of the
# next size class are.
FILE_BYTES = 128 << 20
PLAIN_BYTES = 512 << 20
CLASS_FACTOR = 4
# Runs without keys and zones of their own, and then folders of one level, that ``index`` puts together.
INDEX_FAN = 8
# Versions of a page lie close together in a run; zstd finds a page again over a whole Parquet page, snappy within 64 KB.
COMPRESSION = "zstd"


def _plain(path: str) -> str:
    """A location without the local scheme and a closing slash, for comparison."""
    return re.sub(r"^file:/+", "/", path).rstrip("/")


def put_schema(opts: CrawlOptions, extra: T.StructType | None = None) -> T.StructType:
    """Schema of stored put rows (without the ``batch_id`` partition column)."""
    fields = list(FIXED_FIELDS)
    for fld, _fam, _qual, stored, _clock in opts.cell_specs():
        typ = T.BinaryType() if opts.serializer is not None else CELL_TYPES[fld]
        fields.append(T.StructField(stored, typ))
    for f in extra.fields if extra else []:
        if f.name not in {x.name for x in fields} and f.name != "batch_id":
            fields.append(f)
    return T.StructType(fields)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


class CrawlTable:
    """A named crawl table.

    ``location`` is needed to create it, or to open it where the catalog does
    not know it; a location that disagrees with the catalog is an error.
    """

    def __init__(self, spark: SparkSession, opts: CrawlOptions, location: str | None = None):
        if not _NAME.match(opts.table or ""):
            raise ValueError(f"invalid table name {opts.table!r}")
        self.spark = spark
        self.opts = opts
        self.name = opts.table
        self._log: SnapshotLog | None = None
        known = self._catalog_location()
        if known and location and _plain(known) != _plain(location):
            raise ValueError(f"table {self.name} is stored at {known}, not at {location}")
        self._location = known or (location.rstrip("/") if location else None)

    @property
    def location(self) -> str:
        if not self._location:
            raise ValueError(f"table {self.name} does not exist: name a location on storage that all executors share")
        return self._location

    def _catalog_location(self) -> str | None:
        if not self.exists():
            return None
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").filter("col_name = 'Location'").collect()
        return rows[0]["data_type"].rstrip("/") if rows else None

    # ---- S5 / S6 ----------------------------------------------------------
    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    @property
    def metrics_table(self) -> str:
        return f"{self.name}__metrics"

    @property
    def rejects_table(self) -> str:
        return f"{self.name}__rejects"

    def ensure(self, extra: T.StructType | None = None) -> CrawlTable:
        """Create the table with both families if missing, else add what is
        missing; also its per-batch metrics and rejects tables."""
        if not self.exists():
            schema = put_schema(self.opts, extra)
            if path_exists(self.spark, self.location):
                schema = self._stored_schema(schema)
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({_ddl(schema)}, batch_id BIGINT) "
                           f"USING parquet PARTITIONED BY (batch_id) LOCATION '{self.location}'")
        else:
            self.evolve(put_schema(self.opts, extra))
        for name, ddl, suffix in (
            (self.metrics_table, METRICS_DDL, "_metrics"),
            (self.rejects_table, REJECTS_DDL, "_rejects"),
        ):
            if not self.spark.catalog.tableExists(name):
                self._create(name, ddl, f"{self.location}{suffix}")
        return self

    def _create(self, name: str, ddl: str, location: str) -> None:
        """Create a catalog entry; data that is already at the location becomes its partitions."""
        stored = path_exists(self.spark, location)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}, batch_id BIGINT) "
                       f"USING parquet PARTITIONED BY (batch_id) LOCATION '{location}'")
        if stored:
            self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")

    def _stored_schema(self, wanted: T.StructType) -> T.StructType:
        """Columns of the newest version, then the wanted ones they lack (any case)."""
        told = self.snapshot().schema
        try:
            found = (T.StructType.fromJson(json.loads(told)) if told
                     else self.spark.read.option("mergeSchema", "true").parquet(self.location).schema)
        except AnalysisException:  # a folder without data files
            return wanted
        fields = [f for f in found.fields if f.name != "batch_id"]
        have = {f.name.lower() for f in fields}
        return T.StructType(fields + [f for f in wanted.fields if f.name.lower() not in have])

    def drop(self, purge: bool = False) -> None:
        """Remove the catalog entries, and with ``purge`` the files."""
        places = [self.location, f"{self.location}_metrics", f"{self.location}_rejects", f"{self.location}_keys", f"{self.location}_zones"]
        self._log = None
        for name in (self.name, self.metrics_table, self.rejects_table):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        if purge:
            for p in places:
                delete_path(self.spark, p)

    def _overwrite_partition(self, table: str, location: str, rows: DataFrame, batch_id: int) -> None:
        """Replace partition ``batch_id`` of ``table`` with ``rows``.

        The partition directory is written by path (so the same job may read
        the table's other partitions) and then registered in the catalog.
        """
        rows.write.mode("overwrite").parquet(f"{location}/batch_id={int(batch_id)}")
        self._show_partition(table, location, int(batch_id))

    def _show_partition(self, table: str, location: str, bid: int) -> None:
        self.spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (batch_id = {bid}) LOCATION '{location}/batch_id={bid}'")
        self.spark.catalog.refreshTable(table)

    def write_metrics(self, counts: DataFrame, batch_id: int) -> None:
        """Per-batch status counts: ``status, records, bytes``."""
        rows = counts.select(F.col("status").cast("string"), F.col("records").cast("bigint"), F.col("bytes").cast("bigint"))
        self._overwrite_partition(self.metrics_table, f"{self.location}_metrics", rows.coalesce(1), batch_id)

    def write_counts(self, counts: list[tuple[str, int, int]], batch_id: int) -> None:
        """``write_metrics`` for a micro-batch: its handful of rows is written by the driver, without a job."""
        import pyarrow as pa
        import pyarrow.parquet as pq

        schema = pa.schema([("status", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
        held = io.BytesIO()
        pq.write_table(pa.Table.from_pylist([dict(zip(schema.names, c)) for c in counts], schema), held)
        folder = f"{self.location}_metrics/batch_id={int(batch_id)}"
        delete_path(self.spark, folder)
        write_bytes(self.spark, f"{folder}/part-{uuid.uuid4()}.parquet", held.getvalue())
        self._show_partition(self.metrics_table, f"{self.location}_metrics", int(batch_id))

    def write_rejects(self, rejects: DataFrame, batch_id: int) -> None:
        """Records that could not be keyed: ``seq, url, reason``."""
        rows = rejects.select(F.col("seq").cast("bigint"), F.col("url").cast("string"), F.col("reason").cast("string"))
        self._overwrite_partition(self.rejects_table, f"{self.location}_rejects", rows, batch_id)

    def metrics(self) -> DataFrame:
        return self.spark.table(self.metrics_table)

    def last_batch(self) -> int | None:
        """Highest batch id that was written (from the metrics rows), None for an empty table."""
        return self.metrics().agg(F.max("batch_id")).first()[0]

    def rejects(self) -> DataFrame:
        return self.spark.table(self.rejects_table)

    def get_property(self, key: str) -> str | None:
        props = {r[0]: r[1] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()}
        return props.get(key)

    def set_property(self, key: str, value: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.name} SET TBLPROPERTIES ('{key}' = '{value}')")

    def evolve(self, wanted: T.StructType) -> list[str]:
        """Add wanted columns the table lacks; names compare case-insensitively,
        as the family check does. Returns the added column names."""
        return self._evolved(wanted)[1]

    def _evolved(self, wanted: T.StructType) -> tuple[T.StructType, list[str]]:
        """The table's schema after ``evolve``, and the added column names."""
        schema = self.spark.table(self.name).schema
        have = {f.name.lower() for f in schema.fields}
        add = [f for f in wanted.fields if f.name.lower() not in have and f.name != "batch_id"]
        if add:
            self.spark.sql(f"ALTER TABLE {self.name} ADD COLUMNS ({_ddl(T.StructType(add))})")
            schema = self.spark.table(self.name).schema
        return schema, [f.name for f in add]

    def families(self) -> set[str]:
        return {c.split("__", 1)[0].lower() for c in self.columns() if "__" in c}

    def columns(self) -> list[str]:
        return self.spark.table(self.name).columns

    # ---- snapshots ----------------------------------------------------------
    @property
    def log(self) -> SnapshotLog:
        if self._log is None or self._log.folder != f"{self.location}/_versions":
            self._log = SnapshotLog(self.spark, self.location)
        return self._log

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The newest version, or an older one that is kept."""
        return self.log.read(version) or self._adopted()

    def _adopted(self) -> Snapshot:
        """A table that was stored before there were versions: one run for each folder of a batch."""
        filed = {p.split("/")[-2] for p in matching_paths(self.spark, f"{self.location}_keys/batch_id=*/_SUCCESS")}
        names = [n for n in folder_names(self.spark, self.location) if n.startswith("batch_id=")]
        return Snapshot(0, tuple(Run(n, (int(n.split("=")[1]),), keys=n if n in filed else None,
                                     bytes=path_bytes(self.spark, f"{self.location}/{n}")) for n in names), adopted=True)

    def _stored(self, runs: list[Run] | tuple[Run, ...], schema: T.StructType,
                files: dict[str, list[str]] | None = None) -> DataFrame:
        """The rows of ``runs`` that count; of the runs named in ``files`` only those files are opened."""
        files = files or {}
        runs = [r for r in runs if files.get(r.path) != []]

        def paths(r: Run) -> list[str]:
            place = f"{self.location}/{r.path}"
            return [f"{place}/{f}" for f in files[r.path]] if r.path in files else [place]

        old = [r for r in runs if "=" in r.path]  # the batch is part of the folder's name, not of the rows
        whole = [r for r in runs if not r.without and r not in old]
        parts = []
        if old:
            reader = self.spark.read.schema(schema).option("basePath", self.location)
            parts.append(reader.parquet(*[f"{self.location}/{r.path}" for r in old]))
        if whole:
            parts.append(self.spark.read.schema(schema).parquet(*[p for r in whole for p in paths(r)]))
        for r in runs:
            if r.without and r not in old:
                df = self.spark.read.schema(schema).parquet(*paths(r))
                parts.append(df.filter(~F.col("batch_id").isin(list(r.without))))
        if not parts:
            return self.spark.createDataFrame([], schema)
        return reduce(DataFrame.unionByName, [df.select(*schema.names) for df in parts])

    def _bare_run(self, rows: DataFrame, batches: tuple[int, ...]) -> Run:
        """Write the rows of a new run; ``index`` writes the keys and zones of several such runs at once. Rows without a
        batch are of the only one; its number comes last, so that the code made for all before is that of other batches."""
        name = f"run-{uuid.uuid4().hex[:16]}"
        measured = Observation(f"cellar_run_{uuid.uuid4().hex[:12]}")
        rows = rows.observe(measured, F.sum(_plain_bytes(rows.schema)).alias("plain"))
        if "batch_id" not in rows.columns:
            rows = rows.withColumn("batch_id", F.lit(batches[0]).cast("bigint"))
        rows.write.option("compression", COMPRESSION).parquet(f"{self.location}/{name}")
        return Run(name, batches, bytes=path_bytes(self.spark, f"{self.location}/{name}"), plain=int(measured.get["plain"] or 0))

    def _run(self, rows: DataFrame, batches: tuple[int, ...]) -> Run:
        """Write a new run, its key file and its zone map. Nothing sees them before a commit."""
        run = self._bare_run(rows, batches)
        name = run.path
        stored = self.spark.read.schema("row_key string, batch_id bigint").parquet(f"{self.location}/{name}").distinct()
        stored.write.parquet(f"{self.location}_keys/{name}")
        whole = self.spark.read.schema(self.spark.table(self.name).schema).parquet(f"{self.location}/{name}")
        file_zones(whole).coalesce(1).write.parquet(f"{self.location}_zones/{name}")
        return replace(run, keys=name, zones=name)

    def _commit(self, change) -> Snapshot:
        schema = self.spark.table(self.name).schema.json()
        new = self.log.commit(lambda now: replace(now, runs=change(now.runs), schema=schema), base=self._adopted)
        self.spark.catalog.refreshTable(self.name)
        return new

    def expire(self, keep: int = 1) -> int:
        """Forget all but the newest ``keep`` versions and delete the runs that no kept version names; returns how many.

        Run it while no ingest, compaction or reader of an older version is under way: a run that is
        written but not committed yet is one that no version names.
        """
        self.log.forget(keep)
        named: set[str] = set()
        for v in self.log.versions():
            for r in self.log.read(v).runs:
                named |= {r.path, r.keys, r.zones}
        if not named:
            return 0
        gone = 0
        for place in (self.location, f"{self.location}_keys", f"{self.location}_zones"):
            for name in folder_names(self.spark, place):
                if name not in named and name.startswith(("run-", "batch_id=")):
                    delete_path(self.spark, f"{place}/{name}")
                    gone += 1
        return gone

    # ---- S4 ---------------------------------------------------------------
    def write_batch(self, puts: DataFrame, batch_id: int, indexed: bool = True) -> Snapshot:
        """Store ``puts`` as the rows of batch ``batch_id``, in place of its older ones; returns the new version.

        The rows are written under a new name and shown by one commit: a batch that fails, or is retried, never takes
        rows away and never doubles them. The job may read the table meanwhile (the existence check does). With
        ``indexed`` off the keys and zones are left to ``index``; until then the rows themselves tell them.
        """
        return self.write_rows(self.shaped(puts), batch_id, indexed)

    def shaped(self, puts: DataFrame) -> DataFrame:
        """``puts`` in the columns of the table, which gets those that it lacks; without ``batch_id``."""
        fields = puts.schema.fields
        given = {f.name.lower(): f for f in fields}
        schema, _ = self._evolved(T.StructType([f for f in fields if f.name.lower() != "batch_id"]))
        sel = []
        for f in schema.fields:
            if f.name == "batch_id":
                continue
            own = given.get(f.name.lower())
            if own is not None and own.dataType != f.dataType and not isinstance(own.dataType, T.NullType):
                raise ValueError(f"column {f.name} is stored as {f.dataType.simpleString()}, not {own.dataType.simpleString()}")
            same = own is not None and own.dataType == f.dataType
            col = F.col(f"`{own.name}`") if own is not None else F.lit(None)
            sel.append(f"`{f.name}`" if same and own.name == f.name else col.alias(f.name) if same else col.cast(f.dataType).alias(f.name))
        return puts.select(*sel)

    def write_rows(self, rows: DataFrame, batch_id: int, indexed: bool = True) -> Snapshot:
        """``write_batch`` of rows that are ``shaped``."""
        bid = int(batch_id)
        run = self._run(rows.withColumn("batch_id", F.lit(bid).cast("bigint")), (bid,)) if indexed else self._bare_run(rows, (bid,))
        return self._commit(lambda runs: replaced(runs, run))

    def partition(self, batch_id: int) -> DataFrame:
        """The stored rows of one batch; only its run is opened."""
        bid = int(batch_id)
        runs = [r for r in self.snapshot().runs if bid in r.live()]
        return self._stored(runs, self.spark.table(self.name).schema).filter(F.col("batch_id") == F.lit(bid))

    # ---- S2 / S3 / O2 / A4 ------------------------------------------------
    def scan(self, *columns: str, version: int | None = None) -> DataFrame:
        """Full scan of the newest or an older version; Parquet reads only the named columns."""
        df = self._stored(self.snapshot(version).runs, self.spark.table(self.name).schema)
        return df.select(*columns) if columns else df

    def matching_files(self, wanted: Wanted, runs: tuple[Run, ...]) -> dict[str, list[str]]:
        """Files of each run that may hold a wanted row, from the zone maps; runs without one are left out.

        What reaches the driver is the list of files to open, as for any scan.
        """
        mapped = [r for r in runs if r.zones]
        out: dict[str, list[str]] = {r.path: [] for r in mapped}
        if mapped:
            by_zones = {r.zones: r.path for r in mapped}
            found = self.spark.read.schema(_ZONES_DDL).parquet(*[f"{self.location}_zones/{z}" for z in by_zones])
            place = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
            for row in found.filter(wanted.files()).select(place.alias("zones"), "run", "file").collect():
                path = row["run"] or by_zones[row["zones"]]
                if path in out:  # else a run that is no longer part of the table
                    out[path].append(row["file"])
        return out

    def scan_where(self, *columns: str, keys: list[str] | None = None, domain: str | None = None,
                   since: dt.datetime | None = None, until: dt.datetime | None = None, version: int | None = None) -> DataFrame:
        """Rows with any of ``keys``, of hosts under ``domain``, with ``since <= write_ts < until``; only files whose
        zones allow such rows are opened. A row without a write time is in no time range."""
        wanted = Wanted(keys, domain, since, until)
        runs = self.snapshot(version).runs
        df = self._stored(runs, self.spark.table(self.name).schema, self.matching_files(wanted, runs)).filter(wanted.rows())
        return df.select(*columns) if columns else df

    def view(self, name: str, version: int | None = None) -> None:
        """Make a version's rows known to SQL under ``name``, for this session."""
        self.scan(version=version).createOrReplaceTempView(name)

    def keys(self, exclude_batch: int | None = None) -> DataFrame:
        """Stored row keys (one for each run and batch), from the key files. ``exclude_batch`` leaves a batch out.
        Runs whose key files are not there (stored before there were any, or not yet) are read themselves."""
        runs = self.snapshot().runs
        out = self._key_rows(runs, exclude_batch)
        if out is None:
            out = self.spark.createDataFrame([], _KEYS_DDL)
        if exclude_batch is not None and any(exclude_batch in r.live() for r in runs):
            out = out.filter(F.col("batch_id") != F.lit(int(exclude_batch)))
        return out.select("row_key")

    def _key_rows(self, runs: tuple[Run, ...] | list[Run], exclude_batch: int | None = None) -> DataFrame | None:
        """Key and batch of the rows of ``runs``; those with nothing but ``exclude_batch`` are left out. A folder that
        several runs share is read as a whole if all of them are asked for, else by their batches.
        """
        filed = set(folder_names(self.spark, f"{self.location}_keys"))
        out = None
        shared: dict[str, list[Run]] = {}
        for r in runs:
            if r.sharing > 1 and r.keys in filed:
                shared.setdefault(r.keys, []).append(r)
        runs = [r for r in runs if r.keys not in shared]
        reader, place = self.spark.read.schema(_KEYS_DDL), f"{self.location}_keys"
        whole = [f"{place}/{k}" for k, rs in shared.items() if len(rs) == rs[0].sharing]
        for k, rs in shared.items():
            if f"{place}/{k}" not in whole:
                df = reader.parquet(f"{place}/{k}").filter(F.col("batch_id").isin(sorted({b for r in rs for b in r.live()})))
                out = df if out is None else out.unionByName(df)
        for has, place in ((True, f"{self.location}_keys"), (False, self.location)):
            for masked in (False, True):
                some = [r for r in runs if (r.keys in filed) == has and bool(r.without) == masked and set(r.live()) - {exclude_batch}]
                if not some:
                    continue
                if has:
                    old = [r for r in some if "=" in r.path]
                    new = [r for r in some if r not in old]
                    paths = ([f"{place}/{r.keys}" for r in old], [f"{place}/{r.keys}" for r in new] + ([] if masked else whole))
                    parts = [self.spark.read.schema(_KEYS_DDL).option("basePath", place).parquet(*g) for g in paths if g]
                    whole = whole if masked else []
                else:
                    parts = [self._stored(some, self._key_schema())]
                for df in parts:
                    for r in some if masked and has else []:
                        df = df.filter(~F.col("batch_id").isin(list(r.without)) | ~_of_run(r))
                    df = df.select("row_key", "batch_id")
                    out = df if out is None else out.unionByName(df)
        if whole:
            df = reader.parquet(*whole)
            out = df if out is None else out.unionByName(df)
        return out

    def _key_schema(self) -> T.StructType:
        return T.StructType([T.StructField("row_key", T.StringType()), T.StructField("batch_id", T.LongType())])

    def index(self, fan: int | None = None, rest: bool = False) -> int:
        """Write the keys and zones of runs that were written without, ``fan`` runs to one folder, and put the folders
        of one level together wherever ``fan`` have gathered; returns the number of folders written.

        A key is copied once a level, and the folders that an existence check reads stay below ``fan`` a level,
        whatever the number of batches. ``fan`` is ``INDEX_FAN`` unless given; with ``rest`` fewer runs get a folder, too.
        """
        fan, done = fan or INDEX_FAN, 0
        while True:
            runs = self.snapshot().runs
            bare = [r for r in runs if r.keys is None and r.zones is None and len(r.batches) == 1 and "=" not in r.path]
            levels: dict[int, dict[str, list[Run]]] = {}
            for r in runs:
                if r.sharing > 1:
                    levels.setdefault(int(math.log(r.sharing, fan) + 1e-9), {}).setdefault(r.keys, []).append(r)
            full = [[r for rs in of.values() for r in rs] for _, of in sorted(levels.items()) if len(of) >= fan]
            if len(bare) >= fan or (rest and bare):
                some = bare
            elif full:
                some = full[0]
            else:
                return done
            self._index(some)
            done += 1

    def _index(self, some: list[Run]) -> None:
        """One folder with the keys, and one with the zones, of the runs ``some``, which all have such folders or all have none."""
        name, names = f"run-{uuid.uuid4().hex[:16]}", [r.path for r in some]
        self._key_rows(some).distinct().write.parquet(f"{self.location}_keys/{name}")
        if some[0].zones:
            mapped = self.spark.read.schema(_ZONES_DDL).parquet(*sorted({f"{self.location}_zones/{r.zones}" for r in some}))
            mapped = mapped.filter(F.col("run").isin(names))
        else:
            rows = self.spark.read.schema(self.spark.table(self.name).schema).parquet(*[f"{self.location}/{p}" for p in names])
            mapped = file_zones(rows, "run")
        mapped.coalesce(1).write.parquet(f"{self.location}_zones/{name}")
        self._commit(lambda now: tuple(replace(r, keys=name, zones=name, sharing=len(some)) if r.path in names else r for r in now))

    def lookup(self, keys: DataFrame | list[str]) -> DataFrame:
        """Put rows of the given keys. A list becomes a pushed ``IN`` filter on the files whose zones hold one;
        a DataFrame of keys a semi join, ahead of which a filter of the keys keeps other rows' payload where it is."""
        if isinstance(keys, list):
            return self.scan_where(keys=keys)
        df = self.scan()
        keys = keys.select("row_key").distinct()
        return may_hold(df, ["row_key"], key_filter(keys, ["row_key"])).join(keys, "row_key", "left_semi")

    def get(self, keys: DataFrame | list[str]) -> DataFrame:
        """Newest value of every cell for the given keys."""
        return latest_wide(self.lookup(keys), self.opts)

    def domain_scan(self, domain: str) -> DataFrame:
        return self.scan_where(domain=domain)

    def latest(self) -> DataFrame:
        return latest_wide(self.scan(), self.opts)

    # ---- O1 ---------------------------------------------------------------
    def compact(self, partitions: int | None = None, runs: tuple[Run, ...] | None = None, layout: str = "key") -> DataFrame:
        """Merge all runs (or ``runs``) into one of key-ordered files.

        Range partitions by (row_key, seq), sorted within, so each file holds one key range and Parquet min/max stats
        prune key and domain scans. One commit puts the new run in place of the old ones; older versions stay readable
        until ``expire``. With ``layout="host_time"`` files follow a Z-order curve over (host_rev, write_ts) instead, for
        scans by domain and time. Ingests may write meanwhile: a batch that is written again during the merger wins.
        """
        if layout not in ("key", "host_time"):
            raise ValueError(f"unknown layout {layout!r}")
        arrange = key_ordered if layout == "key" else z_ordered
        runs = self.snapshot().runs if runs is None else runs
        n = partitions or max(1, math.ceil(sum(r.bytes for r in runs) / FILE_BYTES), math.ceil(sum(r.plain for r in runs) / PLAIN_BYTES))
        batches = tuple(sorted({b for r in runs for b in r.live()}))
        if runs:
            new = self._run(arrange(self._stored(runs, self.spark.table(self.name).schema), n), batches)
            self._commit(lambda now: merged(now, tuple(runs), new))
        return self.scan()

    def upkeep(self, fan: int = 8) -> int:
        """Merge runs of one size class wherever ``fan`` of them have gathered; returns the number of mergers.

        A class holds runs of up to ``CLASS_FACTOR`` times the size of the one below, so a row is rewritten about
        once for each class it rises through, and the number of runs stays below ``fan`` for each class.
        """
        done = 0
        while True:
            classes: dict[int, list[Run]] = {}
            for r in self.snapshot().runs:
                classes.setdefault(int(math.log(max(r.bytes, 1 << 16), CLASS_FACTOR)), []).append(r)
            full = [c for c, rs in sorted(classes.items()) if len(rs) >= fan]
            if not full:
                return done
            self.compact(runs=tuple(classes[full[0]]))
            done += 1


def _plain_bytes(schema: T.StructType) -> Column:
    """Bytes of a row's texts and payload."""
    sized = [F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)).cast("bigint") for f in schema.fields if f.dataType in (T.StringType(), T.BinaryType())]
    return reduce(Column.__add__, sized, F.lit(0).cast("bigint"))


def _of_run(run: Run) -> Column:
    return F.col("_metadata.file_path").contains(f"/{run.keys}/")


def key_ordered(df: DataFrame, partitions: int, *first: str) -> DataFrame:
    """Range-partition by (row_key, seq), after ``first``, and sort within partitions."""
    order = [*first, "row_key", "seq"]
    return df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)


def domain_scan(df: DataFrame, domain: str) -> DataFrame:
    """Rows whose host is ``domain`` or a subdomain of it: any scheme, user part, port or key form."""
    if "host_rev" not in df.columns:
        raise ValueError("a domain scan needs the stored host_rev column")
    return df.filter(host_under_domain("host_rev", domain))


__all__ = ["CrawlTable", "put_schema", "key_ordered", "domain_scan"]
