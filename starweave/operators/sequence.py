"""Ordered numbering inside a group, with group totals and looked-up columns
(W3/W4, J10/J11).

A window over the group key puts a whole group in one task, so a session with
a third of the events, or the events without a session, would serialise the
job. All groups therefore take one path that never gathers a group:

1. rows are range-partitioned on (key, order...): the sampled bounds cut the
   rows into contiguous slices of like size, through groups where needed. The
   slices are written once to the shared ``spark.checkpoint.dir``, so that
   both readers below see one slice assignment and retries start from files;
2. one partial aggregation gives a row per group and slice. On these rows, at
   most one per group and one more per slice, windows over the group give each
   slice its offset, the value before it and the group's totals, and the
   lookup table is joined;
3. rows are numbered by a window over (key, slice) and meet the rows of step 2
   on (key, slice), with the partitioning of that window.

Null is a group like any other in the numbering and the totals, and finds no
row in the lookup table.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

SLICE_BYTES, MAX_SLICES = 256 << 20, 1_000_000
_MERGE = {"sum": F.sum, "min": F.min, "max": F.max}


def slices_for(df: DataFrame) -> int:
    """``spark.sql.shuffle.partitions``, or more where the planner's estimate of
    the rows' bytes would make slices above ``SLICE_BYTES``."""
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, min(MAX_SLICES, -(-estimate // SLICE_BYTES)))


def sequence_within_group(df: DataFrame, key: str, order: Sequence[str], seq_col: str,
                          lag_col: str, totals: dict[str, tuple[str, Column]] | None = None,
                          lookup: DataFrame | None = None, slices: int | None = None) -> DataFrame:
    """Add ``seq_col`` (1-based position by ``order``) and ``lag_col`` (the
    previous row's first order column) within each ``key`` group, one column
    per entry of ``totals`` (``sum``, ``min`` or ``max`` of an expression over
    the group), and the columns of ``lookup`` (unique on ``key``).

    ``order`` must make rows unique within a group (ties would be numbered
    arbitrarily). ``slices`` defaults to ``slices_for`` the rows."""
    totals = totals or {}
    lead = order[0]
    slices = slices or slices_for(df)
    # a key that is never null, so that joins on it are plain equalities
    group = F.when(F.col(key).isNull(), "n").otherwise(F.concat(F.lit("v"), F.col(key).cast("string")))
    cut = cut_lineage(df.repartitionByRange(slices, key, *order)
                      .withColumns({"_group": group, "_slice": F.spark_partition_id()}))

    own = [_MERGE[how](expr).alias(name) for name, (how, expr) in totals.items()]
    parts = cut.groupBy("_group", "_slice").agg(
        F.first(key).alias(key), F.count(F.lit(1)).alias("_rows"), F.max(lead).alias("_last"), *own)
    whole = Window.partitionBy("_group")
    before = whole.orderBy("_slice")
    parts = parts.select(
        "_group", "_slice", F.col(key).alias("_key"),
        F.coalesce(F.sum("_rows").over(before.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_offset"),
        F.lag("_last").over(before).alias("_before"),
        *[_MERGE[how](name).over(whole).alias(name) for name, (how, _) in totals.items()])
    found = []
    if lookup is not None:
        found = [c for c in lookup.columns if c != key]
        parts = parts.join(lookup.withColumnRenamed(key, "_key"), "_key", "left")

    rows = Window.partitionBy("_group", "_slice").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    local = cut.select("*", F.row_number().over(rows).alias("_n"), F.lag(lead).over(rows).alias("_lag"))
    return local.join(parts, ["_group", "_slice"]).select(
        *df.columns,
        (F.col("_n") + F.col("_offset")).cast("int").alias(seq_col),
        F.when(F.col("_n") == 1, F.col("_before")).otherwise(F.col("_lag")).alias(lag_col),
        *totals, *found)
