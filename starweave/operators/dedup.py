"""Top-1 per group (T1/T2) as aggregations, not windows.

``min``/``max`` over a struct whose leading fields are the ordering keys picks
the same row as ``row_number() = 1`` over that ordering, but runs as a hash
aggregate with a map-side partial step: a group holding a third of all rows is
reduced on every mapper before the shuffle instead of landing in one task.
Struct ordering puts nulls first, so ``max`` is "descending, nulls last" and
``min`` is "ascending, nulls first" on every field.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], agg) -> DataFrame:
    keys, order = list(keys), list(order)
    payload = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + payload]).alias("_top")
    out = df.groupBy(*keys).agg(agg(packed).alias("_top"))
    return out.select(*keys, *[F.col(f"_top.{c}").alias(c) for c in order + payload])


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Row with the smallest ``order`` tuple per ``keys`` (ascending)."""
    return _pick(df, keys, order, F.min)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Row with the largest ``order`` tuple per ``keys`` (descending, nulls last)."""
    return _pick(df, keys, order, F.max)
