"""Streaming ingestion of raw events.

The reference is a nightly batch with a lookback for late events; here the
same merge runs per micro-batch: ``readStream`` over the landing folder, the
stream's own keyed state drops events whose id has come before, and
``foreachBatch``

1. drops events that the landed day partitions hold already. In the stream these
   can only be rows of a micro-batch that failed between its writes, so the
   batch's own days are asked; a call outside of it asks all days,
2. appends the new ones to the landed ``raw_events`` table, partitioned by event
   day, and their sessions' time spans to an index,
3. recomputes the session-event fact rows of every session the batch touched
   (whole sessions, read from the days that the index gives; events without a
   session are one group) and replaces those sessions' rows in their month
   partitions. The checks declared on the fact run on these rows; what they
   find is written next to the tables.

Null is no id: events without one are all kept, and those of a batch that comes
again are told by their whole content. Events without a timestamp have a day and a
month partition of their own.

Each write is a dynamic partition overwrite of only the touched partitions (the
index gains rows; spans that come twice change nothing), computed from inputs
materialised in the checkpoint folder, so re-running a micro-batch after a
failure rewrites the same partitions with the same content (idempotent).
``trigger(availableNow=True)`` drains the backlog and stops, which is how a
scheduled job uses it; a continuous trigger works the same way.
"""

from __future__ import annotations

import os
import uuid
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import first_per_group
from ..operators.joins import rows_with, rows_without
from ..operators.spans import covered_days, key_spans
from ..plans import facts
from ..plans.quality import FACT_CHECKS, run_checks
from ..plans.warehouse import MONTH, month_expr
from ..session import cut_lineage, ensure_checkpoint_dir, released_cuts, shared_path

DAY = "_day"
SPANS = "_spans"  # the index's folder: the landed table's name and this
FACT = "fct_session_events"
FOUND = "test_name string, severity string, n_failed long, batch_id long"


def _exists(spark: SparkSession, path: str) -> bool:
    """The table directory exists. (A dynamic partition overwrite commits its
    ``_SUCCESS`` marker in a staging folder, so the marker is no test.)"""
    system, p = shared_path(spark, path)
    return system.exists(p)


def _overwrite_partitions(df: DataFrame, path: str, part: str, order: list[str]) -> None:
    """Replace the partitions present in ``df``; the first write creates the
    table (static), later ones are dynamic partition overwrites."""
    mode = "dynamic" if _exists(df.sparkSession, path) else "static"
    cols = [part, *order]
    (df.repartitionByRange(*cols).sortWithinPartitions(*cols)
     .write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(part).parquet(path))


def _values_in(column: str, values: list) -> Column:
    """``isin`` for which null is a value."""
    found = F.col(column).cast("string").isin([v for v in values if v is not None])
    return found | F.col(column).isNull() if None in values else found


def _not_landed(fresh: DataFrame, landed: DataFrame) -> DataFrame:
    """Events whose id has not landed; of those without an id, the rows that
    landed less often than they come here."""
    known = fresh.filter(F.col("event_id").isNotNull())
    new = known.join(landed.select("event_id"), "event_id", "left_anti").select(*fresh.columns)
    nameless = fresh.filter(F.col("event_id").isNull())
    return new.unionByName(nameless.exceptAll(landed.filter(F.col("event_id").isNull()).select(
        *[F.col(c).cast(nameless.schema[c].dataType).alias(c) for c in fresh.columns])))


def merge_events_batch(batch: DataFrame, landed_path: str, facts_path: str,
                       dim_session: DataFrame, run_ts, all_days: bool = True) -> DataFrame | None:
    """Land a batch and renew its sessions' facts; returns what the fact's
    declared checks found on the renewed rows. ``all_days``: ids may have landed
    under another day."""
    spark = batch.sparkSession
    known = first_per_group(batch.filter(F.col("event_id").isNotNull()), ["event_id"], ["_loaded_at"]).select(*batch.columns)
    fresh = known.unionByName(batch.filter(F.col("event_id").isNull()))
    fresh = cut_lineage(fresh.withColumn(DAY, F.date_format("event_ts", "yyyyMMdd")))
    days = [r[0] for r in fresh.select(DAY).distinct().collect()]  # bounded: days in a batch
    if not days:
        return None
    if _exists(spark, landed_path):
        landed = spark.read.parquet(landed_path)
        same_days = landed.filter(_values_in(DAY, days))
        new_events = _not_landed(fresh, landed if all_days else same_days)
        day_rows = cut_lineage(same_days.unionByName(new_events))
    else:
        day_rows = fresh
    # Sessions of all delivered events, landed before or not: a delivery that is
    # replayed after a failure between the two writes recomputes their facts.
    touched = cut_lineage(fresh.select("session_id").distinct())
    _overwrite_partitions(day_rows, landed_path, DAY, ["session_id", "event_id"])
    index = landed_path.rstrip("/") + SPANS
    key_spans(fresh, "session_id", "event_ts").write.mode("append").parquet(index)

    # whole sessions touched by this batch, from the days of their spans
    spans = rows_with(spark.read.parquet(index), touched, "session_id")
    day = F.col(DAY).cast("string")
    within = day.isNull()
    for low, high in covered_days(spans):
        within = within | day.between(low.strftime("%Y%m%d"), high.strftime("%Y%m%d"))
    landed = spark.read.parquet(landed_path).filter(within).drop(DAY)
    whole = rows_with(landed, touched, "session_id")
    rows = facts.fct_session_events(whole, dim_session, run_ts).withColumn(
        MONTH, month_expr("fct_session_events"))
    rows = cut_lineage(rows)
    found = cut_lineage(run_checks({FACT: rows}, checks=[c for c in FACT_CHECKS if c.model == FACT]))
    if _exists(spark, facts_path):
        months = [r[0] for r in rows.select(MONTH).distinct().collect()]
        cur = spark.read.parquet(facts_path).filter(_values_in(MONTH, months))
        gone = rows.select("session_key").distinct()
        rows = cut_lineage(rows_without(cur, gone, "session_key").unionByName(rows))
    _overwrite_partitions(rows, facts_path, MONTH, ["event_date_key", "event_key"])
    return found


def found_by_checks(spark: SparkSession, base: str) -> DataFrame:
    """(batch_id, test_name, severity, n_failed) of a stream's batches."""
    return spark.read.schema(FOUND).parquet(os.path.join(base, "checks"))


def session_events_stream(spark: SparkSession, source_dir: str, dim_session: DataFrame,
                          to_raw_events: Callable[[DataFrame], DataFrame], run_ts,
                          glob: str = "*.parquet", base: str | None = None,
                          max_files_per_trigger: int = 16, source_schema=None):
    """Start an availableNow stream; returns (query, landed_path, facts_path)."""
    base = base or os.path.join(ensure_checkpoint_dir(spark), f"stream-{uuid.uuid4().hex}")
    landed, fct = os.path.join(base, "raw_events"), os.path.join(base, "fct_session_events")
    schema = source_schema or spark.read.option("pathGlobFilter", glob).parquet(source_dir).schema
    src = (spark.readStream.schema(schema).option("pathGlobFilter", glob)
           .option("recursiveFileLookup", "true")
           .option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_dir))
    events = to_raw_events(src)
    # ids that have come before leave by keyed state; rows without an id are no copies of each other
    named, nameless = F.col("event_id").isNotNull(), F.col("event_id").isNull()
    events = events.filter(named).dropDuplicates(["event_id"]).unionByName(events.filter(nameless))
    progress = os.path.join(base, "_checkpoint")
    lost_state = _exists(spark, landed) and not _exists(spark, progress)

    def per_batch(df: DataFrame, batch_id: int) -> None:
        with released_cuts(spark):
            found = merge_events_batch(df, landed, fct, dim_session, run_ts, all_days=lost_state)
            if found is not None:
                (found.filter("n_failed > 0").select("test_name", "severity", "n_failed")
                 .write.mode("overwrite").parquet(os.path.join(base, "checks", f"batch_id={batch_id}")))

    q = (events.writeStream.foreachBatch(per_batch)
         .option("checkpointLocation", progress)
         .trigger(availableNow=True).start())
    return q, landed, fct


def run_to_completion(spark: SparkSession, sf_dir: str, dim_session: DataFrame, run_ts) -> DataFrame:
    """Drain the driver's ``events`` table through the stream and return the
    resulting session-event fact."""
    from ..sources.testdata import raw_events
    q, _, fct = session_events_stream(spark, sf_dir, dim_session, raw_events, run_ts,
                                      glob="events.parquet")
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return spark.read.parquet(fct).drop(MONTH)
