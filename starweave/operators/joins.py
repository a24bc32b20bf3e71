"""Lookup joins with a size check before any broadcast, and fan-out guards.

A broadcast is only requested where the row count is bounded by construction (the
calendar). Every other join is left to AQE, which converts a shuffled join to a
broadcast only after measuring the materialised shuffle, and splits skewed
partitions of the large side. ``sized_broadcast`` is there for callers who know a
bound of their own.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_ROWS = 2_000_000


def sized_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                    known_rows: int | None = None) -> DataFrame:
    """Broadcast hint only if the table has at most ``max_rows`` rows.

    ``known_rows`` states a bound known by construction and skips the probe.
    """
    if known_rows is not None:
        n = known_rows
    else:
        n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def lookup_join(fact: DataFrame, dim: DataFrame, on: Sequence[str] | str, how: str = "left",
                broadcast_rows: int | None = None) -> DataFrame:
    """Join a lookup table whose key is unique.

    ``broadcast_rows`` is a proven row bound of ``dim``; when given and small the
    dim is broadcast, else the join is planned by AQE from runtime sizes.
    """
    on = [on] if isinstance(on, str) else list(on)
    if broadcast_rows is not None and broadcast_rows <= DEFAULT_MAX_BROADCAST_ROWS:
        dim = F.broadcast(dim)
    return fact.join(dim, on=on, how=how)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys (non-null) that occur more than once, with their counts."""
    keys = list(keys)
    nn = df
    for k in keys:
        nn = nn.filter(F.col(k).isNotNull())
    return nn.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def may_repeat(df: DataFrame, key: str) -> bool:
    """Whether a (non-null) key can occur more than once. Equal keys have equal hashes,
    so where no hash repeats no key does: 8 bytes of each row are shuffled, whatever
    the key's length. Where one repeats, by chance too, the keys must be compared."""
    hashes = df.filter(F.col(key).isNotNull()).select(F.xxhash64(key).alias("hash"))
    return duplicate_keys(hashes, ["hash"]).agg(F.count(F.lit(1))).first()[0] > 0


def assert_unique_keys(df: DataFrame, keys: Sequence[str], what: str = "lookup") -> None:
    """Raise if a lookup side is not unique on its join key (fan-out guard)."""
    dup = duplicate_keys(df, keys).limit(1).collect()
    if dup:
        raise ValueError(f"{what}: join key {list(keys)} not unique, e.g. {dup[0].asDict()}")


def _has_null(keys: DataFrame, on: str) -> bool:
    return not keys.filter(F.col(on).isNull()).isEmpty()


def rows_with(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose ``on`` value is among ``keys``, null being a value like any
    other. Null rows are picked by a filter, so that no join gathers them in
    one task. ``keys`` should be materialised: it is asked for a null."""
    found = df.join(keys, on, "left_semi")
    return found.unionByName(df.filter(F.col(on).isNull())) if _has_null(keys, on) else found


def rows_without(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """The other rows: those that ``rows_with`` leaves."""
    rest = df.filter(F.col(on).isNotNull()).join(keys, on, "left_anti")
    return rest if _has_null(keys, on) else rest.unionByName(df.filter(F.col(on).isNull()))


def materialized_keys(df: DataFrame) -> DataFrame:
    """The distinct keys touched by one batch, written once. Joins with them
    are planned from the bytes of the written table, without a hint."""
    from ..session import cut_lineage
    return cut_lineage(df.distinct())
