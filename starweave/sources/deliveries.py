"""Landing of source deliveries: checked before they are published (DQ1-DQ5 on sources).

A delivery is a batch of rows of one raw source. Its declared checks run on the
batch alone: not-null columns and accepted values on its rows, keys within it and,
where the source only ever gains rows, against the stored keys of the rows that
landed before (a semi join that reads the key column, nothing else). A batch with a
failed check of severity error is held back whole, with a report; others become the
next version of the landed table. Mutable sources take a batch as an upsert by key.

Defined cases: an event that comes again unchanged is no failure, it is dropped;
keys that are null are found by the not-null checks; an empty batch lands nothing.
"""

from __future__ import annotations

import datetime as _dt
import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.quality import SOURCE_CHECKS, run_checks
from ..plans.warehouse import Warehouse
from ..schemas import RAW_SCHEMAS
from ..session import cut_lineage, released_cuts
from .raw import RawSources

# The key of each source, and the sources that only gain rows.
SOURCE_KEY = {"raw_events": "event_id", "raw_sessions": "session_id", "service_requests": "sr_id",
              "raw_payments": "payment_id"}
GROWING = ("raw_events", "raw_pro_profiles")
REPORT = "delivery string, test_name string, severity string, n_failed long, rows long, held boolean"


def _columns(source: str) -> list[str]:
    return [f.name for f in RAW_SCHEMAS[source].fields]


def _stored_clashes(store: Warehouse, source: str, batch: DataFrame) -> tuple[DataFrame, int]:
    """The batch without rows that have landed as they are, and the number of
    its keys that have landed with other content."""
    key = SOURCE_KEY.get(source)
    if source not in GROWING or key is None or not store.exists(source):
        return batch, 0
    content = [c for c in _columns(source) if c not in ("_loaded_at", "_source_file")]
    known = batch.select(key).filter(F.col(key).isNotNull()).distinct()
    stored = cut_lineage(store.read(source).select(*content).join(known, key, "left_semi"))
    if stored.isEmpty():
        return batch, 0
    same = F.lit(True)
    for c in content:
        same = same & batch[c].eqNullSafe(stored[c])
    rest = cut_lineage(batch.join(stored, same, "left_anti"))
    return rest, rest.join(stored.select(key).distinct(), key, "left_semi").select(key).distinct().count()


def land_delivery(store: Warehouse, source: str, batch: DataFrame, name: str | None = None) -> DataFrame:
    """Check a batch, then land or hold it. Returns the report (``REPORT``): a row
    per declared check, and one for the stored keys of a growing source."""
    spark, name = batch.sparkSession, name or uuid.uuid4().hex
    checks = [c for c in SOURCE_CHECKS if c.model == source]
    with released_cuts(spark):
        rows = cut_lineage(batch.select(*_columns(source)))
        rest, clashes = _stored_clashes(store, source, rows)
        found = [(r.test_name, r.severity, r.n_failed) for r in run_checks({source: rest}, checks=checks).collect()]
        if source in GROWING and source in SOURCE_KEY:
            found.append((f"{source}__{SOURCE_KEY[source]}__landed", "error", clashes))
        held = any(severity == "error" and n for _, severity, n in found)
        if held:
            rows.write.parquet(os.path.join(store.root, "_held", source, name))
        elif source in GROWING or not store.exists(source):
            if store.exists(source):
                store.append(source, rest)
            else:
                store.write_full(source, rest)
        else:
            store.merge_partitions(source, rest, SOURCE_KEY[source], True)
        n = rest.count()
    return spark.createDataFrame([(name, *f, n, held) for f in found], REPORT)


def held_deliveries(store: Warehouse, source: str) -> list[str]:
    """The folders of batches that were held back, for their owner to mend."""
    return [os.path.join(store.root, "_held", source, n) for n in sorted(store._names(os.path.join(store.root, "_held", source)))]


def landed_sources(store: Warehouse) -> RawSources:
    """The published rows of all sources."""
    spark = store.spark
    return RawSources(lambda n: store.read(n) if store.exists(n) else spark.createDataFrame([], RAW_SCHEMAS[n]))


def deliveries_of(rows: DataFrame, time: str, bounds: list[_dt.date]) -> list[DataFrame]:
    """Rows cut into consecutive deliveries at the given days; rows without a time
    come with the first."""
    from ..functions.time import ntz_literal
    edges = [None, *bounds, None]
    out = []
    for low, high in zip(edges, edges[1:]):
        part = F.lit(True)
        if low is not None:
            part = part & (F.col(time) >= ntz_literal(low))
        if high is not None:
            part = part & (F.col(time) < ntz_literal(high))
        out.append(rows.filter(part | F.col(time).isNull() if low is None else part))
    return out
