"""Keyed upsert (K2) and insert-only members (K4) as DataFrame plans.

Parquet tables cannot be updated in place, so a merge is expressed as
"target rows whose key is not in the batch" + "the batch": one anti join and
a union. AQE measures the batch's keys and broadcasts them only if they are
small; otherwise the anti join is a shuffled join that it splits where keys are
skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .joins import duplicate_keys


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def check_merge_batch(updates: DataFrame, key) -> None:
    """A merge batch must have non-null, unique keys (a second match for one
    target row is an error in warehouse MERGE semantics). One aggregation job:
    per-key counts reduced map-side, then their maximum and the null-key rows."""
    keys = _keys(key)
    null_any = F.lit(False)
    for k in keys:
        null_any = null_any | F.col(k).isNull()
    r = (updates.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(null_any).alias("_null"))
         .agg(F.max("_n").alias("max_n"), F.count_if("_null").alias("null_keys")).first())
    if r["null_keys"]:
        raise ValueError(f"merge batch has a null key in {keys}")
    if r["max_n"] and r["max_n"] > 1:
        dup = duplicate_keys(updates, keys).limit(1).collect()
        raise ValueError(f"merge batch has duplicate key {dup[0].asDict() if dup else keys}")


def upsert(target: DataFrame, updates: DataFrame, key, check: bool = True) -> DataFrame:
    """Matched rows are replaced by the batch row, unmatched batch rows are
    inserted, nothing is deleted.

    No broadcast hint on the batch keys: AQE measures the materialised key
    shuffle and broadcasts it only when it is small, else keeps a shuffled
    anti join (split if skewed)."""
    keys = _keys(key)
    merged = updates.select(*keys)
    if check:  # the check and the join read the keys as written
        merged = cut_lineage(merged)
        check_merge_batch(merged, keys)
    kept = target.join(merged, on=keys, how="left_anti")
    return kept.select(*target.columns).unionByName(updates.select(*target.columns))


def new_members(target: DataFrame, incoming: DataFrame, key) -> DataFrame:
    """Incoming rows whose key is absent from target.

    ``left_anti`` rather than ``NOT IN``: a null among the target members must
    not hide new members, and the anti join needs no broadcast.
    """
    keys = _keys(key)
    new = incoming.join(target.select(*keys).distinct(), on=keys, how="left_anti")
    return new.select(*target.columns)


def insert_new_members(target: DataFrame, incoming: DataFrame, key) -> DataFrame:
    """Append incoming rows whose key is absent from target."""
    return target.unionByName(new_members(target, incoming, key))
