"""Table storage (K1, K2, K3, K6, K7): versioned Parquet tables under
``<root>/<schema>/<table>``, one commit point for the whole warehouse.

* Write, audit, publish. ``with warehouse.transaction():`` pins the newest
  version. Writes inside go to new folders, which only this warehouse object
  reads; leaving the block publishes all of them as the next version in one
  step, an exception publishes nothing. A write outside of such a block is a
  transaction of its own.
* Files are never changed, so a plan may read the table it writes, a lost task is
  run again from the same input, and readers of the version before go on.
* Rows are range-partitioned and sorted on (month, clustering columns, key); the
  manifest holds each file's first and last day. ``read`` with dates opens only
  the files whose days meet them. A hot month is spread over several files,
  because the range partitioner samples on all of these columns.
* A merge reads the key column, then rewrites only the files that hold a replaced
  row, once, together with the new rows; small files of the months written are
  folded in, so that nights don't pile them up.
* A table may be stored in a form: the columns that its others are functions of.
  ``read`` makes the rest, so hashed keys are neither shuffled nor written.
* Superseded versions go at the next publication but one.
"""

from __future__ import annotations

import datetime as _dt
import os
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..operators.joins import rows_with, rows_without
from ..session import cut_lineage, remove_folder, shared_path
from . import facts
from .versions import File, Versions, manifest_rows, read_json, write_json

MONTH = "_month"

# Clustering columns declared per model, and the date key that
# defines each fact's month partition.
CLUSTER_BY = {
    "dim_category": ["category_key"], "dim_geography": ["geography_key"],
    "dim_session": ["session_key"], "dim_pro": ["sp_id"], "dim_service_request": ["sr_id"],
    "dim_date": ["date_key"],
    "fct_booking_events": ["event_date"], "fct_session_events": ["event_date_key"],
    "fct_booking_funnel": ["created_at_date_key", "category_key"],
    "fct_revenue": ["payment_date_key", "category_key"],
}
MONTH_OF = {
    "fct_booking_events": "event_date", "fct_session_events": "event_date_key",
    "fct_booking_funnel": "created_at_date_key", "fct_revenue": "payment_date_key",
    # a dimension that grows with activity: partitioned by an immutable time
    "dim_session": "started_at",
    # type-2 dimensions: current versions in a part of their own, others by closing month
    "dim_service_request": "valid_from", "dim_pro": "valid_from",
}
TYPE_2, CURRENT = {"dim_service_request", "dim_pro"}, "current"
# Tables without month folders that a time column orders: spans of keys, by their
# beginning, and landed sources.
ORDERED_BY = {"idx_session_days": "first_ts", "idx_payment_days": "first_ts",
              "raw_events": "event_ts", "raw_sessions": "updated_at", "service_requests": "updated_at",
              "raw_pro_profiles": "updated_at", "raw_payments": "updated_at"}
KEY_OF = {
    "fct_booking_events": "booking_event_key", "fct_session_events": "event_key",
    "fct_booking_funnel": "booking_key", "fct_revenue": "revenue_key",
    "dim_session": "session_key", "dim_service_request": "service_request_key", "dim_pro": "pro_key",
    "idx_session_days": "session_id", "idx_payment_days": "sr_id",
    "raw_events": "event_id", "raw_sessions": "session_id", "service_requests": "sr_id",
    "raw_pro_profiles": "sp_id", "raw_payments": "payment_id",
}
# Forms in which tables are stored: what makes the table of them, and the column that
# orders their files in place of the hashed key.
FORMS = {"revenue": (facts.revenue_fact, "payment_id")}
TEXT_DATE_KEYS = {"fct_booking_events", "fct_booking_funnel", "fct_revenue"}


SMALL_FILE_BYTES = 32 << 20
KEPT_VERSIONS = 2
WRITE = {"compression": "zstd"}  # hex keys have 4 bits a character, which snappy leaves as they are


def schema_of(table: str) -> str:
    kind = table.split("_")[0]
    return {"fct": "fact", "idx": "index", "raw": "raw", "service": "raw"}.get(kind, "dimension")


def month_expr(table: str) -> Column:
    if table in TYPE_2:
        return F.when(F.col("is_current"), CURRENT).otherwise(F.date_format("valid_to", "yyyyMM"))
    c = F.col(MONTH_OF[table])
    if table in TEXT_DATE_KEYS:  # YYYYMMDD text
        return F.substring(c, 1, 6)
    return F.date_format(c, "yyyyMM")  # DATE or TIMESTAMP_NTZ


def day_expr(table: str) -> Column:
    """The day that places a row in time, as YYYYMMDD text."""
    if table not in MONTH_OF and table not in ORDERED_BY:
        return F.lit(None).cast("string")
    c = F.col(MONTH_OF.get(table) or ORDERED_BY[table])
    return c if table in TEXT_DATE_KEYS else F.date_format(c, "yyyyMMdd")


class Run:
    """An open transaction: the version it began from, its view of the tables
    and the folders it has written."""

    def __init__(self, version: dict):
        self.base, self.before = version["version"], version["tables"]
        self.tables, self.folders = dict(self.before), []


class Warehouse:
    def __init__(self, spark: SparkSession, root: str | None = None, small_file_bytes: int = SMALL_FILE_BYTES,
                 kept_versions: int = KEPT_VERSIONS):
        self.spark = spark
        self.root = root or spark.conf.get("spark.starweave.warehouse", None) or os.path.join(
            spark.conf.get("spark.sql.warehouse.dir"), "starweave")
        self.versions = Versions(spark, self.root)
        self.small_file_bytes, self.kept_versions = small_file_bytes, kept_versions
        self._run: Run | None = None
        self._manifests: dict[str, list[File]] = {}

    def path(self, table: str) -> str:
        return os.path.join(self.root, schema_of(table), table)

    # ------------------------------------------------------------- commit point

    @contextmanager
    def transaction(self):
        """Publish all writes of the block together, or none."""
        if self._run is not None:
            yield self
            return
        run = self._run = Run(self.versions.load())
        try:
            yield self
            if run.tables != run.before:
                self.versions.publish(run.base, run.tables)
        except BaseException:
            for folder in run.folders:
                remove_folder(self.spark, folder)
            raise
        finally:
            self._run = None
        self._expire()

    def _tables(self) -> dict:
        return self._run.tables if self._run is not None else self.versions.load()["tables"]

    def exists(self, table: str) -> bool:
        return table in self._tables()

    def _expire(self) -> None:
        """Remove versions before the kept ones, and files that only these name."""
        numbers = self.versions.numbers()
        old, kept = numbers[:-self.kept_versions], numbers[-self.kept_versions:]
        if not old:
            return
        live: dict[str, set] = {}
        manifests = set()
        for n in kept:
            for table, entry in self.versions.load(n)["tables"].items():
                manifests.add((table, entry["manifest"]))
                live.setdefault(table, set()).update(f.file for f in self._files_of(table, entry))
        gone = {(t, e["manifest"]): e for n in old for t, e in self.versions.load(n)["tables"].items()}
        for (table, manifest), entry in gone.items():
            if (table, manifest) in manifests:
                continue
            files, alive = self._files_of(table, entry), live.get(table, set())
            writes = {f.split("/")[0] for f in alive}
            for folder in {f.file.split("/")[0] for f in files} - writes:
                remove_folder(self.spark, f"{self.path(table)}/data/{folder}")
            for f in files:  # of writes that live on in part
                if f.file not in alive and f.file.split("/")[0] in writes:
                    remove_folder(self.spark, f"{self.path(table)}/data/{f.file}")
            remove_folder(self.spark, f"{self.path(table)}/_manifests/{manifest}")
        for n in old:
            self.versions.forget(n)

    def clean(self) -> None:
        """Remove what runs that died have left. Only while no run is open."""
        named: dict[str, set] = {}
        for n in self.versions.numbers():
            for table, entry in self.versions.load(n)["tables"].items():
                keep = named.setdefault(self.path(table), set())
                keep.add(entry["manifest"])
                keep.update(f.file.split("/")[0] for f in self._files_of(table, entry))
        for schema in self._names(self.root):
            for table in self._names(f"{self.root}/{schema}") if not schema.startswith("_") else ():
                folder = f"{self.root}/{schema}/{table}"
                for part in ("data", "_manifests"):
                    for name in self._names(f"{folder}/{part}"):
                        if name not in named.get(folder, ()):
                            remove_folder(self.spark, f"{folder}/{part}/{name}")

    def _names(self, folder: str) -> list[str]:
        system, path = shared_path(self.spark, folder)
        return [str(s.getPath().getName()) for s in system.listStatus(path)] if system.exists(path) else []

    # ------------------------------------------------------------------ reading

    def _files_of(self, table: str, entry: dict) -> list[File]:
        """The files of a table version: names and figures, no rows."""
        key = entry["manifest"]
        if key not in self._manifests:
            self._manifests[key] = [File(*f) for f in read_json(self.spark, f"{self.path(table)}/_manifests/{key}")]
        return self._manifests[key]

    def files(self, table: str, since: _dt.date | None = None, until: _dt.date | None = None,
              current: bool = False) -> list[File]:
        """The files that hold rows of the days from ``since`` to ``until``, or
        current versions of a type-2 dimension."""
        low = since.strftime("%Y%m%d") if since else ""
        high = until.strftime("%Y%m%d") if until else "9"
        files = self._files_of(table, self._tables()[table])
        if current:
            files = [f for f in files if f.month == CURRENT]
        if since is None and until is None:
            return files
        return [f for f in files if f.last_day is not None and f.last_day >= low and f.first_day <= high]

    def _scan(self, table: str, files: list[File]) -> DataFrame:
        """Rows of the files as stored, with their month and file name."""
        entry = self._tables()[table]
        schema = StructType.fromJson(entry["schema"])
        if table in MONTH_OF:
            schema = StructType(schema.fields).add(MONTH, StringType())
        if not files:
            return self.spark.createDataFrame([], StructType(schema.fields).add("_file", StringType()))
        data = f"{self.path(table)}/data"
        rows = self.spark.read.schema(schema).option("basePath", data).parquet(*[f"{data}/{f.file}" for f in files])
        name = F.concat(F.lit("_write="), F.substring_index(F.col("_metadata.file_path"), "/_write=", -1))
        return rows.drop("_write").withColumn("_file", name)

    def read(self, table: str, keep_month: bool = False, since: _dt.date | None = None,
             until: _dt.date | None = None, current: bool = False) -> DataFrame:
        """The rows of a table, or those of the days from ``since`` to
        ``until`` (both included; rows without a day are in neither), or the
        current versions of a type-2 dimension."""
        rows = self._scan(table, self.files(table, since, until, current)).drop("_file")
        day = day_expr(table)
        if since is not None:
            rows = rows.filter(day >= since.strftime("%Y%m%d"))
        if until is not None:
            rows = rows.filter(day <= until.strftime("%Y%m%d"))
        form, month = self._form(table), rows.columns if MONTH in rows.columns else []
        if form is not None and keep_month and month:
            return FORMS[form][0](rows).withColumn(MONTH, month_expr(table))
        if form is not None:
            return FORMS[form][0](rows)
        return rows if keep_month or not month else rows.drop(MONTH)

    def _form(self, table: str) -> str | None:
        return self._tables()[table].get("form")

    # ------------------------------------------------------------------ writing

    def _stage(self, table: str, df: DataFrame, carried: list[File] = (), form: str | None = None) -> None:
        """Write rows, of the given form, as a new folder; with the carried files they
        are the table."""
        with self.transaction():
            write, schema = "w" + uuid.uuid4().hex, df.drop(MONTH).schema
            folder, manifest = f"{self.path(table)}/data/_write={write}", f"{self.path(table)}/_manifests/{write}"
            self._run.folders += [folder, manifest]
            cluster = CLUSTER_BY.get(table, [])
            if table in MONTH_OF:
                order = [*cluster, FORMS[form][1] if form else KEY_OF[table]]
                df = df.drop(MONTH).repartitionByRange(month_expr(table), *order).withColumn(MONTH, month_expr(table))
                df.sortWithinPartitions(MONTH, *order).write.options(**WRITE).partitionBy(MONTH).parquet(folder)
                schema_read = StructType(schema.fields).add(MONTH, StringType())
            elif table in ORDERED_BY:
                order = [ORDERED_BY[table], KEY_OF[table]]
                df.repartitionByRange(*order).sortWithinPartitions(*order).write.options(**WRITE).parquet(folder)
                schema_read = schema
            else:
                (df.sortWithinPartitions(*cluster) if cluster else df).write.options(**WRITE).parquet(folder)
                schema_read = schema
            found = manifest_rows(self.spark.read.schema(schema_read).parquet(folder), write, day_expr(table)).collect()
            files = [*carried, *[File(*r) for r in found]]
            write_json(self.spark, manifest, files)
            self._manifests[write] = files
            self._run.tables[table] = {"manifest": write, "schema": schema.jsonValue(), **({"form": form} if form else {})}

    def write_full(self, table: str, df: DataFrame, form: str | None = None) -> None:
        """Full rebuild (K1, idempotent: K6), of rows of a form. The plan may read the table."""
        self._stage(table, df, form=form)

    def append(self, table: str, rows: DataFrame) -> None:
        """Insert-only members (K4): new files, the others stay; small files are
        folded together when they get many."""
        with self.transaction():
            files = self.files(table)
            small = [f for f in files if f.bytes < self.small_file_bytes]
            if len(small) < 8:
                return self._stage(table, rows, files)
            names = {f.file for f in small}
            both = self._scan(table, small).drop("_file", MONTH).unionByName(rows)
            self._stage(table, both, [f for f in files if f.file not in names])

    def apply(self, table: str, change) -> DataFrame | None:
        """Write an incremental ``Change`` the cheapest correct way; returns the
        change's ``track`` columns of all replaced and new rows."""
        if change.insert_only:
            return self.append(table, change.fresh)
        return self.merge_partitions(table, change.fresh, change.on, change.unique, change.scope, change.track,
                                     change.null_group, change.among_current, change.form)

    def merge_partitions(self, table: str, fresh: DataFrame, on: str, check_unique: bool,
                         scope: DataFrame | None = None, track: tuple = (),
                         null_group: bool = False, among_current: bool = False, form: str | None = None) -> DataFrame:
        """Replace rows whose ``on`` value occurs in ``fresh``, wherever they
        stand, and insert the rest, rewriting only the files involved. Rows whose
        ``on`` value occurs only in ``scope`` go. With ``null_group`` rows with a
        null ``on`` value are replaced as one group. With ``among_current`` only
        current versions are asked for replaced rows. ``fresh`` is of the ``form``;
        a table stored without one gets its rows finished. Returns the ``track``
        columns of the replaced and the new rows."""
        with self.transaction():
            stored = self._form(table)
            if form is not None and stored is None:
                fresh, form = FORMS[form][0](fresh), None
            if form != stored:
                raise ValueError(f"{table} is stored in the form {stored!r}: it takes rows of that form")
            fresh = cut_lineage(fresh)
            if check_unique:
                odd = fresh.groupBy(on).agg(F.count(F.lit(1)).alias("_n")).filter((F.col("_n") > 1) | F.col(on).isNull())
                if not odd.isEmpty():
                    raise ValueError(f"{table}: merge batch keys on {on} must be unique and non-null")
            keys = fresh.select(on) if scope is None else fresh.select(on).union(scope.select(on)).distinct()
            if scope is None and not check_unique:
                keys = keys.distinct()
            files = self.files(table)
            asked = [f for f in files if f.month == CURRENT] if among_current else files
            seen = self._scan(table, asked).select(*dict.fromkeys([on, *track]), "_file")
            gone = rows_with(seen, keys, on) if null_group else seen.join(keys, on, "left_semi")
            if track:  # asked for again when the files are written
                gone = cut_lineage(gone)
            hit = {r[0] for r in gone.select("_file").distinct().collect()}  # file names
            months = {r[0] for r in fresh.select(month_expr(table)).distinct().collect()} if table in MONTH_OF else {None}
            hit |= {f.file for f in files if f.bytes < self.small_file_bytes and f.month in months}
            touched = [f for f in files if f.file in hit]
            cur = self._scan(table, touched).drop("_file", MONTH)
            kept = rows_without(cur, keys, on) if null_group else cur.join(keys, on, "left_anti")
            self._stage(table, kept.select(*cur.columns).unionByName(fresh.select(*cur.columns)),
                        [f for f in files if f.file not in hit], form)
            return fresh.select(*track).union(gone.select(*track))
